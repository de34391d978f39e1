"""Operator 2: near-duplicates by ProbMinHash.

A document's five-word shingles weigh 1 + ln(occurrences). Each shingle of
weight w sends points of a Poisson process of rate w, derived from its hash
alone, to random registers; a register keeps the earliest point's shingle.
Two documents agree in a register with the probability Jaccard similarity of
their weighted shingles. A shingle stops when its next point is later than
every register's, so after the first points only few go on.

Signatures are cut into bands; documents that share a band are candidates and
are verified exactly: a link is a similarity of 0.8 or more, the larger of
the probability Jaccard similarity of the weighted shingles and the plain one
of the shingle sets. As either can be far below the other (a passage repeated
a different number of times), a text that repeats a shingle has two
signatures: of the weights, and of all weights 1, which agree with the plain
similarity. Without repeats they are the same, so their bands share one
key space. Classes are the connected components of the links.

How hot groups stay cheap, and no link is lost:

- texts equal but for case are one node; copies are only counted;
- all members of a band's bucket are compared with one hub, drawn anew for
  each bucket, so that a text meets as many hubs as it has bands, and
  classes are formed of what is linked (``turns`` times, with new hubs for
  members of other classes than the last one's);
- texts in buckets that still hold several classes, which are mostly far less
  similar than a link, get a second signature of more and longer bands; in
  its buckets, members of other classes than the hub's are compared with the
  hub, then with all members of other classes whose registers, of either
  signature, agree about as often as a link's (one bit of each is compared; a
  link fails this with probability under 1e-4). So each candidate pair is either within a class
  already or verified, while a group of thousands of near-copies costs a few
  comparisons each.

Defined results: a text (null: empty) without words is alone in its class. A
text of one to four words has one shingle, all its words. The class id is the
least doc_id among its documents (null only if all are). Every input row
gives one row; repeated rows share a class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import as_string_array, ready, slices, staged
from .graph import components
from .words import counted, mix, shingles

#: (bands, registers in each): a link shares one with probability over 0.9998,
#: in the signature whose similarity makes it a link.
COARSE, FINE = (25, 5), (128, 12)
SIMILARITY = 0.8
#: Registers of the texts that a task signs at once.
SIGNATURES = 1 << 20
SIGNED = "doc_id long, node binary, bands array<long>, bits array<long>"
_STEP = np.uint64(0x9E3779B97F4A7C15)


def prob_minhash(doc: np.ndarray, value: np.ndarray, weight: np.ndarray, n: int, registers: int) -> np.ndarray:
    """Signatures (n x registers) of texts given as (text, shingle, weight)."""
    time = np.full(n * registers, np.inf)
    sig = np.zeros(n * registers, np.uint64)
    table = time.reshape(n, registers)
    reached, state = np.zeros(len(doc)), value.copy()
    go = np.arange(len(doc))
    with np.errstate(over="ignore"):
        while len(go):
            state[go] += _STEP
            u = mix(state[go])
            wait = -np.log(((u >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight[go]
            reached[go] += wait
            x = reached[go]
            at = doc[go] * registers + (mix(u ^ np.uint64(0xD6E8FEB86659FD93)) % np.uint64(registers)).astype(np.int64)
            np.minimum.at(time, at, x)
            won = time[at] == x
            sig[at[won]] = value[go[won]]
            own = doc[go]
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))     # still in text order
            latest = table[own[first]].max(1)
            go = go[x < np.repeat(latest, np.diff(np.concatenate([first, [len(own)]])))]
    return sig.reshape(n, registers)


def weights(occurrences: np.ndarray) -> np.ndarray:
    return 1 + np.log(occurrences)


def band_keys(texts: pa.Array, bands: int, rows: int) -> tuple[list, list]:
    """The distinct 64-bit keys of each text's bands, and one bit of each
    register packed in 64-bit numbers, first the weighted signature's, then the
    plain one's; None without shingles."""
    doc, value, n = counted(*shingles(texts))
    weighted = prob_minhash(doc, value, weights(n), len(texts), bands * rows)
    plain, repeats = weighted.copy(), np.unique(doc[n > 1])
    some = np.isin(doc, repeats)
    plain[repeats] = prob_minhash(np.searchsorted(repeats, doc[some]), value[some], np.ones(some.sum()),
                                  len(repeats), bands * rows)
    keys, packed = [], []
    for sig in (weighted, plain):
        key = np.zeros((len(texts), bands), np.uint64)
        with np.errstate(over="ignore"):
            for r in range(rows):
                key = mix(key * _STEP + sig[:, r::rows])
            keys.append(mix(key + np.arange(bands, dtype=np.uint64)).view(np.int64))
        bits = np.zeros((len(texts), -(-bands * rows // 64) * 64), np.uint8)
        bits[:, :bands * rows] = mix(sig) & np.uint64(1)
        packed.append(np.packbits(bits, axis=1).view(np.int64))
    has, twice = (np.isin(np.arange(len(texts)), x) for x in (doc, repeats))
    keys = [np.unique(np.concatenate([a, b])) if t else a if h else None
            for a, b, t, h in zip(*keys, twice, has, strict=True)]
    return keys, [x if h else None for x, h in zip(np.concatenate(packed, axis=1), has, strict=True)]


def few_at_once(batches, registers: int):
    """Slices whose texts and signatures are of a few MB."""
    most = max(1, SIGNATURES // registers)
    for b in slices(batches, most=2 << 20):
        for start in range(0, b.num_rows, most):
            yield b.slice(start, most)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The larger of the probability Jaccard similarity and the plain one of
    two texts given as distinct shingles, in order, with weights."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    plain = len(common) / (len(a[0]) + len(b[0]) - len(common))
    wa, wb = a[1][i], b[1][j]
    # for shingle d: sum over all e of max(a_e / a_d, b_e / b_d), split where the ratio a_e : b_e passes a_d : b_d
    ratio = wa / wb
    order = np.argsort(ratio, kind="stable")
    up = np.concatenate([[0], np.cumsum(wb[order])])
    down = np.concatenate([np.cumsum(wa[order][::-1])[::-1], [0]])
    cut = np.searchsorted(ratio[order], ratio, "left")
    total_a = a[1].sum() - wa.sum() + down[cut]        # e with a_e / b_e >= a_d / b_d, and those only in a
    total_b = b[1].sum() - wb.sum() + up[cut]
    return max(plain, float((1 / (total_a / wa + total_b / wb)).sum()))


def _weighted(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    doc, value, n = counted(*shingles(texts))
    at = np.searchsorted(doc, np.arange(len(texts) + 1))
    w = weights(n)
    return [(value[at[i]:at[i + 1]], w[at[i]:at[i + 1]]) for i in range(len(texts))]


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts (node, text) are similar."""

    def run(batches):
        for batch in batches:
            for b in slices([batch], "text_a", 1 << 20):
                left = _weighted(as_string_array(b.column("text_a")))
                right = _weighted(as_string_array(b.column("text_b")))
                ok = [similarity(x, y) >= threshold - 1e-9 for x, y in zip(left, right, strict=True)]
                yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    joined = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
              .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"))
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(run, "a binary, b binary")


def most_differing(registers: int, threshold: float) -> int:
    """How many of the registers' bits may differ at a similarity: the mean
    and four standard deviations. Bits of different shingles agree by half."""
    p = (1 - threshold) / 2
    return int(registers * p + 4 * (registers * p * (1 - p)) ** 0.5)


def _split(members: DataFrame, of: DataFrame | None, turn: int) -> DataFrame:
    """The members (bucket, node) of buckets that hold several classes, with
    their class so far as label and a hub drawn anew by ``turn``."""
    if of is None:
        labelled = members.withColumn("label", F.col("node"))
    else:
        labelled = members.join(of, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root")
    drawn = F.struct(F.xxhash64("node", "bucket", F.lit(turn)).alias("h"), "node", "label")
    split = (labelled.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"),
                                            F.min(drawn).alias("hub"))
             .where("low <> high").select("bucket", F.col("hub.node").alias("hub"), F.col("hub.label").alias("hub_label")))
    return labelled.join(split, "bucket")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = SIMILARITY,
            coarse: tuple[int, int] = COARSE, fine: tuple[int, int] = FINE, turns: int = 1) -> DataFrame:
    """(doc_id, node, some, class_id) for each row; node is the digest of the
    lower-cased text, some is whether it has words."""
    spark = ready(docs.sparkSession)
    # no text leaves this frame but for those that have candidates
    own = docs.select(docs[id_col].cast("long").alias("doc_id"),
                      F.lower(F.coalesce(docs[text_col].cast("string"), F.lit(""))).alias("text"))
    own = own.select("doc_id", F.unhex(F.md5(F.col("text").cast("binary"))).alias("node"), "text")

    def signer(bands, rows):
        def sign(batches):
            for b in few_at_once(batches, bands * rows):
                keys, bits = band_keys(as_string_array(b.column("text")), bands, rows)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("node"), pa.array(keys, pa.list_(pa.int64())),
                     pa.array(bits, pa.list_(pa.int64()))],
                    names=["doc_id", "node", "bands", "bits"])
        return sign

    rows_ = staged(own.mapInArrow(signer(*coarse), SIGNED).drop("bits"), "signatures")
    nodes = staged(rows_.where("bands IS NOT NULL").groupBy("node")
                   .agg(F.min("doc_id").alias("least"), F.first("bands").alias("bands")), "nodes")
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = (buckets.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"))
              .where("low <> high").select("bucket"))
    members = staged(buckets.join(shared, "bucket").select("bucket", "node"), "members")

    # one row for each text that has candidates, its first copy's
    wanted = (members.select("node").distinct().join(nodes.select("node", "least"), "node"))
    texts = (own.join(wanted.withColumnRenamed("node", "n"),
                      (F.col("node") == F.col("n")) & F.col("doc_id").eqNullSafe(F.col("least")), "left_semi")
             .select("node", "text").dropDuplicates(["node"]))
    texts = staged(texts, "texts")

    links = of = None
    for step in range(turns + 2):
        if step == turns:      # what is still apart gets finer bands
            apart = _split(members, of, step).select("node").distinct()
            keys = (texts.join(apart, "node", "left_semi").select(F.lit(0).cast("long").alias("doc_id"), "node", "text")
                    .mapInArrow(signer(*fine), SIGNED))
            members = staged(keys.select("node", "bits", F.explode("bands").alias("bucket")), "members")
        left = _split(members, of, step)
        if step <= turns:
            pairs = left.where("label <> hub_label").select(F.greatest("node", "hub").alias("a"),
                                                            F.least("node", "hub").alias("b"))
        else:
            side = lambda n: left.select(F.col("bucket"), F.col("node").alias(n), F.col("label").alias(f"label_{n}"),
                                         F.col("bits").alias(f"bits_{n}"),
                                         (F.col("label") != F.col("hub_label")).alias(f"out_{n}"))
            x, y = side("x").where("out_x"), side("y")
            longs, most = -(-fine[0] * fine[1] // 64), most_differing(fine[0] * fine[1], threshold)
            differ = lambda first: sum((F.bit_count(x.bits_x[i].bitwiseXOR(y.bits_y[i]))
                                        for i in range(first, first + longs)), F.lit(0))
            pairs = (x.join(y, (x.bucket == y.bucket) & (x.label_x != y.label_y) & (~y.out_y | (x.x < y.y))
                            & ((differ(0) <= most) | (differ(longs) <= most)))
                     .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")))
        found = staged(verified(staged(pairs.distinct(), "pairs"), texts, threshold), "links")
        if not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            of = staged(components(links), "classes")
    if of is None:
        of = spark.createDataFrame([], "node binary, root binary")

    by_node = (nodes.select("node", "least").join(of, "node", "left")
               .select("node", "least", F.coalesce("root", "node").alias("root")))
    least = by_node.groupBy("root").agg(F.min("least").alias("class_id"))
    by_node = staged(by_node.join(least, "root").select("node", "class_id"), "node-classes")
    signed = rows_.select("doc_id", "node", F.col("bands").isNotNull().alias("some"))
    return (signed.join(by_node, "node", "left")
            .select("doc_id", "node", "some",
                    F.when(F.col("some"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id) for each row of ``docs``."""
    return classes(docs, id_col, text_col, threshold).select("doc_id", "class_id")


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                            threshold: float = SIMILARITY) -> DataFrame:
    """One row of each class, all columns kept: that of the least doc_id (null
    last, then by the text's digest; of equal rows any). Rows without words
    stay."""
    found = classes(docs, id_col, text_col, threshold)
    best = (found.where("some").groupBy("class_id")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("k"))
            .select("k.doc_id", "k.node"))
    best = staged(best, "kept")
    digest = F.unhex(F.md5(F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).cast("binary")))
    tagged = docs.withColumns({"__conflux_node": digest, "__conflux_id": F.col(id_col).cast("long"),
                               "__conflux_words": F.coalesce(F.col(text_col), F.lit("")).rlike(r"[^\x20\x09-\x0D]")})
    kept = (tagged.where("__conflux_words")
            .join(best.select(F.col("doc_id").alias("__kept_id"), F.col("node").alias("__kept_node")),
                  (F.col("__conflux_node") == F.col("__kept_node"))
                  & F.col("__conflux_id").eqNullSafe(F.col("__kept_id")), "left_semi")
            .dropDuplicates(["__conflux_node", "__conflux_id"]))
    return kept.unionByName(tagged.where("NOT __conflux_words")).select(*[F.col(f"`{c}`") for c in docs.columns])
