"""Operator 8: benchmark decontamination by size-partitioned MinHash
containment.

MinHash compares sets of like size only, so sizes are partitioned: test items
fall into classes by their number of shingles (class k: from 2^k up to
2^(k+1)), and for each class a document is cut into blocks of 2^(k+1)
shingles, any two neighbouring blocks being a window. An item that stands in
a document stands in one window of its class, with a Jaccard similarity of
0.19 or more at 80 % containment; one common minimum among ``hashes`` (64)
makes the pair a candidate, which an item so contained misses with a
probability under 2e-6. Minima of larger blocks come from those of smaller
ones. Candidates are verified by the exact share of the item's distinct
shingles that the whole document has.

An item of one to four words has one shingle of its own width, all its words;
it is contained where these words stand in a row, which documents are searched
for at that width.

The documents are never shuffled. The items are the small side; they go out
in parts of about ``part_bytes`` of text and ``part_items`` items each, one pass
over the documents for each part. An item takes 0.8 KB of a part (``hashes``
minima with their owner, and 16 bits a minimum in a table of those seen)
besides its shingles, so a part of the default size is under 64 MB however many
items there are; a single item of more text than that is taken whole. With
several parts each one's result is written before the next is made, and the
part is dropped, on the driver too.

Defined results: a text (null: empty) without words has no shingles, is in no
pair and contains nothing. A document of one to four words has one shingle, all
its words. :func:`find_items` reports short items wherever they stand;
:func:`decontaminate` drops a document for one only if it consists of it, or
with ``short_inside``, as a word or two say little about where a text is from.
Each row of documents is paired with each row of items, repeated rows
included. Letters count as lower case.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import as_string_array, id_and_text, ready, slices, staged
from .words import WIDTH, counted, mix, runs, shingles, word_hashes

PAIRS = "doc_id long, item_id long, containment double, n_shingles int"
_SEED = 0x5851F42D4C957F2D


def _multipliers(hashes: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, hashes + 1, dtype=np.uint64) * np.uint64(_SEED)) | np.uint64(1)


def _key(value: np.ndarray, k: int, cls: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(value + np.uint64(((k << 8) + cls + 1) * _SEED % 2**64))


def _matches(known: np.ndarray, owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For all equal pairs of ``value`` and the ordered ``known``: the place of
    the value, and the owner of the known one."""
    lo = np.searchsorted(known, value, "left")
    m = np.searchsorted(known, value, "right") - lo
    at = np.arange(m.sum()) + np.repeat(lo - (np.cumsum(m) - m), m)
    return np.repeat(np.arange(len(value)), m), owner[at].astype(np.int64)


class ItemIndex:
    """Signatures and shingles of one part of the items."""

    def __init__(self, ids: list, texts: list[str], hashes: int, threshold: float):
        self.ids, self.threshold, self.mult = ids, threshold, _multipliers(hashes)
        lower = pc.utf8_lower(pa.array(texts, pa.large_string()))
        words = np.diff(word_hashes(lower)[1])
        doc, value = shingles(lower)
        self.short = {}                # by width: hashes and items, in order of the hashes
        for k in range(1, WIDTH):
            own = np.flatnonzero(words[doc] == k)
            if len(own):
                own = own[np.argsort(value[own], kind="stable")]
                self.short[k] = value[own], doc[own]
        long_ = words[doc] >= WIDTH
        doc, value = doc[long_], value[long_]
        n = np.bincount(doc, minlength=len(ids))
        cls = np.zeros(len(ids), np.int64)
        cls[n > 0] = np.floor(np.log2(n[n > 0])).astype(np.int64)
        d, v, _ = counted(doc, value)
        at = np.searchsorted(d, np.arange(len(ids) + 1))
        self.sets = [v[at[i]:at[i + 1]] for i in range(len(ids))]
        some = np.flatnonzero(n > 0)
        self.classes = sorted(set(cls[some].tolist()))
        keys, owner = [], []
        with np.errstate(over="ignore"):
            for k, a in enumerate(self.mult):
                if len(some):
                    low = np.minimum.reduceat(v * a, at[some])
                    for c in self.classes:
                        of = cls[some] == c
                        keys.append(_key(low[of], k, c))
                        owner.append(some[of])
        keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.owner = keys[order], owner[order].astype(np.int32)
        self.bits = max(16, int(np.floor(np.log2(16 * max(1, len(keys))))))
        at = np.unique(self.keys >> np.uint64(64 - self.bits))       # which keys can be among the items', a bit each
        self.seen = np.zeros(1 << (self.bits - 3), np.uint8)
        np.bitwise_or.at(self.seen, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    def nbytes(self) -> int:
        """What the arrays of the index take up."""
        return (self.keys.nbytes + self.owner.nbytes + self.seen.nbytes + sum(s.nbytes for s in self.sets)
                + sum(h.nbytes + o.nbytes for h, o in self.short.values()))

    def _may_have(self, key: np.ndarray) -> np.ndarray:
        at = key >> np.uint64(64 - self.bits)
        return (self.seen[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)

    def _candidates(self, value: np.ndarray, offsets: np.ndarray):
        """(document, item) arrays; ``value``: shingle hashes, a document's in
        text order from its offset on."""
        found = []
        n = np.diff(offsets)
        docs = np.flatnonzero(n)
        plan, size = {}, None      # for each class: where its blocks start in the finer one's
        for c in range(self.classes[0], self.classes[-1] + 1):
            width = 1 << (c + 1)
            blocks = -(-n[docs] // width)
            owner = np.repeat(docs, blocks)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            if size is None:
                starts = offsets[owner] + number * width
            else:
                starts = np.repeat(np.cumsum(size) - size, blocks) + 2 * number
            plan[c], size = (starts, owner), blocks
        with np.errstate(over="ignore"):
            for k, a in enumerate(self.mult):
                low = value * a
                for c, (starts, owner) in plan.items():
                    low = np.minimum.reduceat(low, starts)
                    if c not in self.classes:
                        continue
                    window = low.copy()
                    same = owner[1:] == owner[:-1]
                    np.minimum(window[:-1], low[1:], out=window[:-1], where=same)
                    key = _key(window, k, c)
                    hit = np.flatnonzero(self._may_have(key))
                    if not len(hit):
                        continue
                    which, of = _matches(self.keys, self.owner, key[hit])
                    found.append(owner[hit][which] * len(self.ids) + of)
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.divmod(np.unique(np.concatenate(found)), len(self.ids))

    def pairs(self, texts: pa.Array, short_inside: bool = True):
        """Verified (document number, item number, containment) arrays."""
        lower = pc.utf8_lower(texts)
        a, b = self._long_pairs(lower), self._short_pairs(lower, short_inside)
        d, q, share = (np.concatenate(x) for x in zip(a, b, strict=True))
        order = np.lexsort((q, d))
        return d[order], q[order], share[order]

    def _short_pairs(self, lower: pa.Array, inside: bool):
        """Documents in which the words of a short item stand in a row (not
        ``inside``: which consist of them)."""
        found = [np.zeros(0, np.int64)]
        if self.short:
            h, at = word_hashes(lower)
            owner = np.repeat(np.arange(len(lower)), np.diff(at))
        for k, (known, items) in self.short.items():
            value, first = runs(h, k)
            whole = owner[first] == owner[first + k - 1]
            if not inside:
                whole &= np.diff(at)[owner[first]] == k
            which, of = _matches(known, items, value[whole])
            found.append(owner[first][whole][which] * len(self.ids) + of)
        d, q = np.divmod(np.unique(np.concatenate(found)), max(1, len(self.ids)))
        return d, q, np.ones(len(d))

    def _long_pairs(self, lower: pa.Array):
        doc, value = shingles(lower)
        texts, none = lower, (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        if not len(doc) or not self.classes:
            return none
        offsets = np.searchsorted(doc, np.arange(len(texts) + 1))
        d, q = self._candidates(value, offsets)
        share, last, own = np.zeros(len(d)), -1, None
        for i, (x, y) in enumerate(zip(d, q, strict=True)):
            if x != last:
                last, own = x, np.unique(value[offsets[x]:offsets[x + 1]])
            item = self.sets[y]
            at = np.minimum(np.searchsorted(own, item), len(own) - 1)
            share[i] = (own[at] == item).sum() / len(item)
        ok = share >= self.threshold - 1e-12
        return d[ok], q[ok], share[ok]


def item_parts(spark: SparkSession, items: DataFrame, id_col: str, text_col: str, hashes: int,
               threshold: float, part_bytes: int, part_items: int):
    """(an :class:`ItemIndex` as broadcast, whether it is one of several) for
    each part of the items. A broadcast of several is dropped when the next one
    is asked for."""
    own = id_and_text(items, id_col, text_col).withColumnRenamed("doc_id", "item_id")
    total, n = own.agg(F.coalesce(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16), F.lit(0)),
                       F.count(F.lit(1))).first()
    parts = max(-(-total // part_bytes), -(-n // part_items))
    if parts > 1:
        spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).cast("int")
        own = staged(own.withColumn("part", spread), "items")
    for p in range(parts):
        rows = (own.where(F.col("part") == p) if parts > 1 else own).select("item_id", "text").collect()
        rows.sort(key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"] or ""))
        index = spark.sparkContext.broadcast(
            ItemIndex([r["item_id"] for r in rows], [r["text"] or "" for r in rows], hashes, threshold))
        del rows
        yield index, parts > 1
        if parts > 1:
            index.destroy()


def find_items(docs: DataFrame, items: DataFrame, threshold: float = 0.8, id_col: str = "doc_id",
               text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
               hashes: int = 64, part_bytes: int = 8 << 20, part_items: int = 1 << 15) -> DataFrame:
    """(doc_id, item_id, containment, n_shingles): the items contained in each
    document; n_shingles is the item's number of distinct ones."""
    spark = ready(docs.sparkSession)
    own = id_and_text(docs, id_col, text_col)
    found = None
    for index, several in item_parts(spark, items, item_id_col, item_text_col, hashes, threshold, part_bytes, part_items):
        def run(batches, index=index):
            for b in slices(batches):
                d, q, share = index.value.pairs(as_string_array(b.column("text")))
                if len(d):
                    ids, sets = index.value.ids, index.value.sets
                    yield pa.RecordBatch.from_arrays(
                        [b.column("doc_id").take(pa.array(d)), pa.array([ids[j] for j in q], pa.int64()),
                         pa.array(share), pa.array([max(1, len(sets[j])) for j in q], pa.int32())],
                        names=["doc_id", "item_id", "containment", "n_shingles"])
        part = own.mapInArrow(run, PAIRS)
        if several:
            part = staged(part, "item-pairs")
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], PAIRS) if found is None else found


def decontaminate(docs: DataFrame, items: DataFrame, threshold: float = 0.8, text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", hashes: int = 64,
                  part_bytes: int = 8 << 20, part_items: int = 1 << 15, short_inside: bool = False) -> DataFrame:
    """The rows of ``docs``, all columns kept, that contain no item."""
    spark, out = ready(docs.sparkSession), docs
    for index, several in item_parts(spark, items, item_id_col, item_text_col, hashes, threshold, part_bytes, part_items):
        def run(batches, index=index):
            for b in slices(batches, text_col):
                clean = np.ones(b.num_rows, bool)
                clean[index.value.pairs(as_string_array(b.column(text_col)), short_inside)[0]] = False
                yield b.filter(pa.array(clean))
        out = out.mapInArrow(run, docs.schema)
        if several:
            out = staged(out, "uncontaminated")
    return out
