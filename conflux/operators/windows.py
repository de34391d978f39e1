"""Order-dependent numbering and caps.

Spark's ``row_number().over(partitionBy(k))`` puts every row of a key into
one task; if one key holds a third of all rows that task holds a third of
the data. The helpers here number rows exactly without that:

* numbering (:func:`number_rows`): a partial aggregate finds the hot keys;
  other keys take the plain window; a hot key is range-partitioned on its
  order, and a row's number is the rows of its key in earlier range
  partitions (a running sum over a small count table) plus its rank inside
  its own partition. A caller that has order-following *buckets* (e.g.
  ``offset div 65536``) can use those instead of the range partitioning.
* caps (:func:`cap_rows`, first ``n`` rows per key): rows are cut into
  order-following buckets; per-bucket counts (partial aggregation) and a
  running sum give each bucket's starting number; buckets wholly inside
  the cap pass through a semi-join, buckets wholly past it are dropped, and
  only the single boundary bucket of a key is numbered at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import new_path

_B = "_bucket"


def _bucket_cols(buckets: Sequence[Column]) -> list[Column]:
    return [b.alias(f"{_B}{i}") for i, b in enumerate(buckets)]


def _join_on(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str) -> DataFrame:
    """Null-safe equi-join on ``cols`` (a null key or bucket is a value
    here, as it is a group for ``row_number``); ``right`` keeps only the
    join columns plus its payload, renamed apart and dropped after."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") for c in cols],
                     *[c for c in right.columns if c not in cols])
    cond = None
    for c in cols:
        e = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        cond = e if cond is None else cond & e
    out = left.join(r, cond, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"_r_{c}" for c in cols])


def _bucket_starts(df: DataFrame, keys: Sequence[str], nb: int) -> DataFrame:
    bnames = [f"{_B}{i}" for i in range(nb)]
    counts = df.groupBy(*keys, *bnames).agg(F.count(F.lit(1)).alias("_n"))
    w = (Window.partitionBy(*keys).orderBy(*bnames)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return counts.withColumn("_start", F.sum("_n").over(w) - F.col("_n"))


# A key with more rows than this is numbered through the range/bucket path.
HOT_KEY_ROWS = 1_000_000


def _number_bucketed(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                     buckets: Sequence[Column], out: str) -> DataFrame:
    nb = len(buckets)
    bnames = [f"{_B}{i}" for i in range(nb)]
    b = df.select("*", *_bucket_cols(buckets))
    starts = _bucket_starts(b, keys, nb).select(*keys, *bnames, "_start")
    w = Window.partitionBy(*keys, *bnames).orderBy(*order)
    return (_join_on(b, starts, [*keys, *bnames], "inner")
             .withColumn(out, (F.col("_start") + F.row_number().over(w)).cast("bigint"))
             .drop("_start", *bnames))


def _number_ranged(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                   out: str) -> DataFrame:
    """Exact numbering of (hot) keys by range partitioning on
    ``keys + order``: a key's rows land in consecutive range partitions in
    order, so its number is the rows in its earlier partitions (a running
    sum over a count table of partitions x keys) plus the rank inside its
    own partition. With a total order, ties cannot pile up in one
    partition, so every task holds about ``rows / partitions``.

    The rows are written with their partition number to the staging folder,
    and both the counts and the ranks read that: a partitioning computed
    twice samples other bounds for other columns, and a retried task could
    move rows too."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(k) for k in keys] + [F.col(o) if isinstance(o, str) else o for o in order]
    stage = new_path(spark, "hot-keys")
    df.repartitionByRange(parts, *by).withColumn("_pid", F.spark_partition_id()).write.parquet(stage)
    r = spark.read.parquet(stage)
    counts = r.groupBy(*keys, "_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = (Window.partitionBy(*keys).orderBy("_pid")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    starts = counts.withColumn("_start", F.sum("_n").over(w) - F.col("_n")).select(*keys, "_pid", "_start")
    w2 = Window.partitionBy(*keys, "_pid").orderBy(*order)
    return (_join_on(r, starts, [*keys, "_pid"], "inner")
            .withColumn(out, (F.col("_start") + F.row_number().over(w2)).cast("bigint"))
            .drop("_start", "_pid"))


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                buckets: Sequence[Column] | None = None, out: str = "rn",
                hot_key_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Exact ``row_number() over (partition by keys order by order)``.

    Per-key counts (a partial aggregate) find the hot keys; their list is
    written once to the staging folder. Without any, the plain window is the
    whole plan. Else ordinary keys take the plain window and hot keys are
    numbered through ``buckets`` when given (they must be non-decreasing
    along ``order``, e.g. ``offset div width``), else by range partitioning
    on the order (:func:`_number_ranged`). How the list is joined is left to
    AQE: it grows with the data."""
    spark = df.sparkSession
    hk = [f"_hot_{i}" for i in range(len(keys))]
    stage = new_path(spark, "hot-list")
    (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_kn")).filter(F.col("_kn") > hot_key_rows)
     .select(*[F.col(k).alias(h) for k, h in zip(keys, hk)]).write.parquet(stage))
    hot = spark.read.parquet(stage)
    w = Window.partitionBy(*keys).orderBy(*order)
    if hot.isEmpty():
        return df.withColumn(out, F.row_number().over(w).cast("bigint"))
    cond = None
    for k, h in zip(keys, hk):
        c = F.col(k).eqNullSafe(F.col(h))
        cond = c if cond is None else cond & c
    plain = (df.join(hot, cond, "left_anti")
               .withColumn(out, F.row_number().over(w).cast("bigint")))
    hot_rows = df.join(hot, cond, "left_semi")
    heavy = (_number_bucketed(hot_rows, keys, order, buckets, out) if buckets
             else _number_ranged(hot_rows, keys, order, out))
    return plain.unionByName(heavy)


def cap_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
             buckets: Sequence[Column], n: int, prior: DataFrame | None = None,
             flag: str | None = None) -> DataFrame:
    """First ``n`` rows per key in ``order`` (ties broken by ``order``).
    ``prior`` (``keys + _prior``) carries rows already taken per key, e.g.
    by earlier micro-batches of a stream. With ``flag`` all rows come back,
    and that column says which are among the first ``n``."""
    nb = len(buckets)
    bnames = [f"{_B}{i}" for i in range(nb)]
    b = df.select("*", *_bucket_cols(buckets))
    starts = _bucket_starts(b, keys, nb)
    if prior is not None:
        starts = (_join_on(starts, prior, list(keys), "left")
                  .withColumn("_start", F.col("_start") + F.coalesce(F.col("_prior"), F.lit(0)))
                  .drop("_prior"))
    inside = starts.filter(F.col("_start") + F.col("_n") <= n).select(*keys, *bnames)
    edge = starts.filter((F.col("_start") < n) & (F.col("_start") + F.col("_n") > n)) \
                 .select(*keys, *bnames, "_start")
    whole = _join_on(b, inside, [*keys, *bnames], "left_semi")
    w = Window.partitionBy(*keys, *bnames).orderBy(*order)
    part = _join_on(b, edge, [*keys, *bnames], "inner").withColumn("_rn", F.row_number().over(w))
    fits = F.col("_start") + F.col("_rn") <= n
    if flag is None:
        return whole.unionByName(part.filter(fits).drop("_start", "_rn")).drop(*bnames)
    past = starts.filter((F.col("_start") >= n) & (F.col("_start") + F.col("_n") > n)).select(*keys, *bnames)
    return (whole.withColumn(flag, F.lit(True))
            .unionByName(part.withColumn(flag, fits).drop("_start", "_rn"))
            .unionByName(_join_on(b, past, [*keys, *bnames], "left_semi").withColumn(flag, F.lit(False)))
            .drop(*bnames))


def number_tasks(df: DataFrame, keys: Sequence[str], order: Sequence[str], step: int = 20,
                 hot_key_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """``task_thread_num = i`` and ``sequence_num = i * step`` within
    each key, ordered by ``order`` (list every column needed for a total
    order). A hot key is numbered by range partitioning on the order, so
    it is split however few values its leading order column has."""
    numbered = number_rows(df, keys, [F.col(c) for c in order], None, out="task_thread_num",
                           hot_key_rows=hot_key_rows)
    return numbered.withColumn("sequence_num", F.col("task_thread_num") * F.lit(step))


def cap_per_topic(msgs: DataFrame, n: int, bucket_width: int = 1 << 16) -> DataFrame:
    """at most ``n`` messages per topic (valid and invalid alike) in
    ``(partition, offset)`` order."""
    return cap_rows(msgs, ["topic"], [F.col("partition"), F.col("offset")],
                    [F.col("partition"), F.floor(F.col("offset") / bucket_width)], n)


def page_chain(pages: DataFrame, request: str = "request_id", page_num: str = "page_num",
               cursor: Column | None = None, max_pages: int = 2) -> DataFrame:
    """per request keep pages up to and including the first one whose
    cursor is null/empty, and at most ``max_pages``. The first end page per
    request is a grouped ``min`` (partial aggregation), joined back; no
    request's pages are gathered into one window."""
    cur = cursor if cursor is not None else F.col("next_cursor")
    ends = (pages.filter(cur.isNull() | (cur == ""))
                 .groupBy(request).agg(F.min(page_num).alias("_end_page")))
    return (pages.filter(F.col(page_num) <= max_pages)
                 .join(ends, request, "left")
                 .filter(F.col("_end_page").isNull() | (F.col(page_num) <= F.col("_end_page")))
                 .drop("_end_page"))
