"""Operator 3: URL filter by rules and link-graph propagation (DataFrame
functions only).

Rules name a host with a path start and decide a page directly. Every other
page gets the verdict of its host from the link graph: trust is a
personalised PageRank from the hosts of allowed pages along the links,
distrust one from the hosts of blocked pages against them (who links to a bad
host is suspect). Seeds are weighted by the number of their pages, links by
how often they occur. A host is blocked where its share of all distrust
exceeds ``ratio`` times its share of all trust.

Both ranks are summed as series, wave by wave: the first wave is the seeds,
each next one what passes over the edges, damped. Of a wave's mass m, at most
m x damping / (1 - damping) is passed on in all later waves together; the
waves end when that is no more than ``tolerance`` (1e-12, the least difference
that blocks a host) of what was summed, for trust and for distrust. That takes
up to 170 waves where links run in circles. Mass that reaches a host
without links ends there; as shares are taken of the total, this gives the
same as returning it to the seeds. Links are summed by host pair before
anything is joined, so a hub costs a row for each neighbour, and the joins
are plain equi-joins that AQE can split.

Defined results: null url, or one without ``://``: host and path are empty,
no rule, allowed. Null html has no links. Links within a host don't count.
Every input row gives one row, repeated ones included. An empty table gives
an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..session import new_path
from .common import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""
EPS = 1e-12


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased. Path: from there up to ``?``, ``#`` or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits; of equally long ones
    a block, then the smaller text. Null where none fits."""
    rule = verdict = F.lit(None).cast("string")
    for v, r in sorted(rules, key=lambda x: (len(x[1]), x[0] == "block", [-ord(c) for c in x[1]])):
        h, slash, p = r.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, w): links between different hosts, summed by host pair.
    ``pages`` has host and html."""
    link = F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1)))
    url = F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link")).otherwise(F.col("link"))
    found = (pages.select("host", link.alias("link")).select("host", url.alias("url"))
             .select(F.col("host").alias("src"), host_and_path(F.col("url"))[0].alias("dst")))
    return (found.where("src <> '' AND dst <> '' AND src <> dst")
            .groupBy("src", "dst").agg(F.count("*").cast("double").alias("w")))


def propagate(seeds: DataFrame, links: DataFrame, damping: float = 0.85, tolerance: float = EPS) -> DataFrame:
    """(kind, host, rank) from seeds (kind, host, mass): kind 'trust' goes
    along the links, 'distrust' against them. Each wave is written to the
    shared folder, all below one path that is read at the end; they go on until
    what is left to pass on is no more than ``tolerance`` of a kind's sum."""
    if not (0 <= damping < 1 and tolerance > 0):
        raise ValueError("damping must be at least 0 and below 1, tolerance above 0")
    spark = seeds.sparkSession
    out = links.groupBy("src").agg(F.sum("w").alias("total"))
    into = links.groupBy("dst").agg(F.sum("w").alias("total"))
    edges = staged(
        links.join(out, "src").select(F.lit("trust").alias("kind"), F.col("src").alias("host"),
                                      F.col("dst").alias("to"), (F.col("w") / F.col("total")).alias("p"))
        .unionByName(links.join(into, "dst").select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"),
                                                    F.col("src").alias("to"), (F.col("w") / F.col("total")).alias("p"))),
        "host-edges")
    top = new_path(spark, "trust-waves")
    step = seeds.select("kind", "host", (F.col("mass") * (1 - damping)).alias("mass"))
    passed: dict[str, float] = {}
    for k in itertools.count():
        step.write.option("compression", "zstd").parquet(f"{top}/wave={k}")
        wave = spark.read.schema(step.schema).parquet(f"{top}/wave={k}")
        mass = {r["kind"]: r["mass"] for r in
                wave.groupBy("kind").agg(F.sum("mass").alias("mass")).collect()}       # two rows at most
        for kind, m in mass.items():
            passed[kind] = passed.get(kind, 0.0) + m
        if all(m * damping <= tolerance * (1 - damping) * passed[kind] for kind, m in mass.items()):
            break
        step = (wave.join(edges, ["kind", "host"])
                .groupBy("kind", F.col("to").alias("host"))
                .agg(F.sum(F.col("mass") * F.col("p") * damping).alias("mass")))
    return (spark.read.schema(step.schema).parquet(top)
            .groupBy("kind", "host").agg(F.sum("mass").alias("rank")))


def blocked_hosts(ranks: DataFrame, ratio: float = 1.0) -> DataFrame:
    """The hosts whose share of all distrust exceeds ``ratio`` x trust's."""
    total = {r["kind"]: r["total"] for r in
             ranks.groupBy("kind").agg(F.sum("rank").alias("total")).collect()}  # two rows at most
    share = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("rank") / total.get(kind, 1.0)).otherwise(0.0))
    return (ranks.groupBy("host").agg(share("trust").alias("trust"), share("distrust").alias("distrust"))
            .where(F.col("distrust") - ratio * F.col("trust") > EPS).select("host"))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], damping: float = 0.85, tolerance: float = EPS,
               ratio: float = 1.0, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html") -> DataFrame:
    """page_id, host, path, rule, verdict for each row of ``pages``."""
    own = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"), pages[html_col].alias("html"))
    host, path = host_and_path(F.col("url"))
    parsed = own.select("page_id", host.alias("host"), path.alias("path"), "html")
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    judged = parsed.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("by_rule"))
    kind = F.when(F.col("by_rule") == "allow", "trust").otherwise("distrust")
    seeds = (judged.where("by_rule IS NOT NULL").groupBy(kind.alias("kind"), "host")
             .agg(F.count("*").cast("double").alias("mass")))
    total = {r["kind"]: r["n"] for r in seeds.groupBy("kind").agg(F.sum("mass").alias("n")).collect()}
    whole = F.when(F.col("kind") == "trust", total.get("trust", 1.0)).otherwise(total.get("distrust", 1.0))
    ranks = propagate(seeds.withColumn("mass", F.col("mass") / whole),
                      staged(host_links(parsed), "host-links"), damping, tolerance)
    bad = staged(blocked_hosts(ranks, ratio), "blocked-hosts").withColumn("bad", F.lit(True))
    return (judged.join(bad, "host", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("by_rule", F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict")))


def oracle(rules: Sequence[tuple[str, str]], damping: float = 0.85, waves: int = 12, ratio: float = 1.0) -> str:
    """The same in DuckDB SQL, the waves written out one by one: the first 12
    only, so it holds where no link path is longer."""
    cases = []
    for v, r in sorted(rules, key=lambda x: (-len(x[1]), x[0] != "block", x[1])):
        h, slash, p = r.partition("/")
        cases.append(f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{slash}{p}') THEN '{v} {r}'")
    split = ("translate(regexp_extract({0}, '://([^/?#]*)', 1), '" + UPPER + "', '" + LOWER + "')")
    flows = []
    for k in range(1, waves + 1):
        flows.append(f"""wave{k} AS MATERIALIZED (SELECT kind, dst AS host, sum(mass * p * {damping}) AS mass
            FROM wave{k - 1} JOIN edges USING (kind, host) GROUP BY kind, dst)""")
    waves_sql = " UNION ALL ".join(f"SELECT * FROM wave{k}" for k in range(waves + 1))
    link = LINK.replace("'", "''")
    return f"""
WITH parsed AS MATERIALIZED (
  SELECT page_id, html, coalesce({split.format("substr(url, instr(url, '://'))")}, '') AS host,
         coalesce(regexp_extract(substr(url, instr(url, '://')), '^://[^/?#]*([^?#]*)', 1), '') AS path
  FROM (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN url ELSE '' END AS url FROM pages)),
judged AS MATERIALIZED (
  SELECT page_id, host, path, CASE {' '.join(cases)} END AS hit FROM parsed),
links AS MATERIALIZED (
  SELECT src, dst, count(*)::DOUBLE AS w FROM (
    SELECT host AS src, {split.format("CASE WHEN starts_with(link, '//') THEN 'http:' || link WHEN instr(link, '://') > 0 THEN substr(link, instr(link, '://')) ELSE '' END")} AS dst
    FROM (SELECT host, unnest(regexp_extract_all(html, '{link}', 1)) AS link FROM parsed))
  WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst),
edges AS MATERIALIZED (
  SELECT 'trust' AS kind, src AS host, dst, w / sum(w) OVER (PARTITION BY src) AS p FROM links
  UNION ALL SELECT 'distrust', dst, src, w / sum(w) OVER (PARTITION BY dst) FROM links),
wave0 AS MATERIALIZED (
  SELECT kind, host, n / sum(n) OVER (PARTITION BY kind) * {1 - damping} AS mass FROM (
    SELECT CASE WHEN hit LIKE 'allow%' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*)::DOUBLE AS n
    FROM judged WHERE hit IS NOT NULL GROUP BY ALL)),
{', '.join(flows)},
shares AS (SELECT kind, host, mass / sum(mass) OVER (PARTITION BY kind) AS share FROM ({waves_sql})),
bad AS (SELECT host FROM shares GROUP BY host
  HAVING sum(CASE kind WHEN 'distrust' THEN share ELSE 0 END) - {ratio} * sum(CASE kind WHEN 'trust' THEN share ELSE 0 END) > {EPS})
SELECT page_id, host, path, substr(hit, instr(hit, ' ') + 1) AS rule,
  CASE WHEN hit IS NOT NULL THEN split_part(hit, ' ', 1) WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END AS verdict
FROM judged"""
