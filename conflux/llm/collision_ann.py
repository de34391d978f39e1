"""Operator 4: nearest neighbours by collision-counting hashing.

Largest inner product becomes least distance by one more component: a
candidate x is (x, sqrt(M^2 - |x|^2)) / M with M the greatest length, a query
is (q, 0) / |q|. Candidates are dealt into blocks of bounded size; each block
sorts its vectors along ``projections`` (48) random directions, one array for
each. Around a query's own projection a window is opened in every array; a
vector collides as often as it lies in one.

The window starts narrow (``first`` of the array's length); the vectors that
collide most often are verified, and their k-th best gives a radius R within
which the block's k nearest must lie. Virtual rehashing widens all windows to
R x ``width``: a vector at distance R or less then lies in a window with
probability 0.68 or more, so that it collides ``threshold`` (29) times or more
with probability near 0.9, nearer ones more surely; as R belongs to the k-th
best of a single block, those that are among the k best of all are nearer. All vectors that do are
verified by their inner product in double precision. The best k of each block
are merged for each query.

The queries are a stated share of the table; they go to the candidate blocks
in packed blocks of their own, as rows of an equi-join on the block number.

Defined results: vectors that are null, zero, hold null or non-finite
components, and rows without an id take no part. Vectors of different lengths
among the others are an error. Candidates with the query's own id are left out.
An id counts once in a result, with its best score. Ties go to the smaller id.
Fewer than k candidates: all are verified.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import ready

RESULT = "query_id long, vec_id long, score double"


def _valid(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col("v")
    whole = (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vec_col].cast("array<double>").alias("v"))
            .where(F.col("vec_id").isNotNull() & v.isNotNull()).where(whole).where(F.exists(v, lambda x: x != 0)))


def _packed(rows: DataFrame, blocks: int, name: str) -> DataFrame:
    """(name, ids, vectors): rows dealt into blocks evenly, whatever their
    ids; each block one row."""
    def pack(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        v = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        order = np.argsort(ids, kind="stable")
        v = v.reshape(len(ids), -1)[order]
        return pa.table({name: pa.array([table.column(name)[0].as_py()], pa.int32()),
                         "ids": pa.array([ids[order].tobytes()], pa.binary()),
                         "vectors": pa.array([v.tobytes()], pa.binary())})
    block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    return rows.withColumn(name, block).groupBy(name).applyInArrow(pack, f"{name} int, ids binary, vectors binary")


class BlockIndex:
    """The sorted arrays of one block of candidates."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float, directions: np.ndarray):
        self.ids, self.vectors, self.longest = ids, vectors, longest
        rest = np.sqrt(np.maximum(0, longest**2 - (vectors**2).sum(1)))
        along = np.concatenate([vectors, rest[:, None]], 1) @ directions / longest
        self.order = np.ascontiguousarray(np.argsort(along, axis=0, kind="stable").T)
        self.sorted = np.take_along_axis(along.T, self.order, 1)
        self.directions = directions

    def collisions(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """How often each vector lies in a query's windows [lo, hi)."""
        return np.bincount(np.concatenate([o[a:b] for o, a, b in zip(self.order, lo, hi, strict=True)]),
                           minlength=len(self.ids))

    def search(self, qid: np.ndarray, queries: np.ndarray, k: int, first: float, width: float, threshold: int):
        """(query number, vec_id, score) of the k best of each query."""
        n = len(self.ids)
        length = np.linalg.norm(queries, axis=1)
        along = (queries / length[:, None]) @ self.directions[:-1]
        if n <= 4 * k:
            found = [np.arange(n)] * len(queries)
        else:
            probes = self._probes(along, 8 * k, max(1, int(first * n / 2)))
            radius = np.array([self._radius(p, own, q, x, k)
                               for p, own, q, x in zip(probes, qid, queries, length, strict=True)])
            lo, hi = self._windows(along, radius * width)
            found = []
            for p, a, b in zip(probes, lo, hi, strict=True):
                count = self.collisions(a, b)
                count[p] = threshold                # verified already, part of the result
                found.append(np.flatnonzero(count >= threshold))
        out = []
        for i, (f, own, q) in enumerate(zip(found, qid, queries, strict=True)):
            ids, score = self.ids[f], self.vectors[f] @ q
            keep = ids != own
            if len(f) > 4 * k:       # only what can be among the k best ids: an id may come several times
                keep &= score >= self._kth(ids[keep], score[keep], k)
            ids, score = ids[keep], score[keep]
            order = np.lexsort((ids, -score))
            ids, score = ids[order], score[order]
            _, at = np.unique(ids, return_index=True)
            at = np.sort(at)[:k]
            out.append((np.full(len(at), i), ids[at], score[at]))
        return [np.concatenate(x) for x in zip(*out, strict=True)]

    def _windows(self, along: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end place of each query's window in each sorted array."""
        both = [(np.searchsorted(s, a - half, "left"), np.searchsorted(s, a + half, "right"))
                for s, a in zip(self.sorted, along.T, strict=True)]
        return np.stack([x for x, _ in both], 1), np.stack([y for _, y in both], 1)

    def _probes(self, along: np.ndarray, most: int, half: int) -> list[np.ndarray]:
        """The vectors that collide most often in each query's first windows."""
        middle, n = self._windows(along, np.zeros(len(along)))[0], len(self.ids)
        return [np.argpartition(-self.collisions(np.maximum(0, m - half), m + half), min(most, n - 1))[:most]
                for m in middle]

    def _radius(self, probe: np.ndarray, own: int, q: np.ndarray, length: float, k: int) -> float:
        """A distance within which there are k other ids."""
        ids, score = self.ids[probe], self.vectors[probe] @ q
        kth = self._kth(ids[ids != own], score[ids != own], k)
        return np.sqrt(max(0.0, 2 - 2 * kth / (length * self.longest))) + 1e-9 if kth > -np.inf else 2.0 + 1e-6

    @classmethod
    def _kth(cls, ids: np.ndarray, score: np.ndarray, k: int) -> float:
        """The k-th best score when each id counts once; -inf if there are fewer."""
        if len(ids) > 8 * k:         # a bound will do: the best 4 k rows have k ids, or all are looked at
            top = np.argpartition(-score, 4 * k)[:4 * k]
            best = cls._distinct(ids[top], score[top])
            if len(best) >= k:
                return np.partition(best, len(best) - k)[len(best) - k]
        best = cls._distinct(ids, score)
        return np.partition(best, len(best) - k)[len(best) - k] if len(best) >= k else -np.inf

    @staticmethod
    def _distinct(ids: np.ndarray, score: np.ndarray) -> np.ndarray:
        """The best score of each id."""
        order = np.lexsort((-score, ids))
        ids, score = ids[order], score[order]
        return score[np.concatenate([[True], ids[1:] != ids[:-1]])] if len(ids) else score


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
            projections: int = 48, threshold: int = 29, width: float = 1.0, first: float = 0.02,
            block_rows: int = 8192, query_rows: int = 2048, seed: int = 7) -> DataFrame:
    """query_id, rank, vec_id, score: for each row where ``is_query`` (a
    condition on ``vec_id``) its k nearest other rows."""
    spark = ready(vectors.sparkSession)
    rows = _valid(vectors, id_col, vec_col)
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    size = F.size("v")
    least, dim = rows.agg(F.min(size), F.max(size)).first()
    if dim is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if least != dim:
        raise ValueError(f"vectors of different lengths, from {least} to {dim} components")
    n, n_queries, longest = rows.agg(F.count("*"), F.count(F.when(is_query, 1)), F.max(length)).first()
    blocks, query_blocks = -(-n // block_rows), max(1, -(-n_queries // query_rows))
    directions = np.random.default_rng(seed).standard_normal((dim + 1, projections))

    def run(batches):
        held, index = None, None
        for b in batches:
            for r in b.to_pylist():
                if held != r["block"]:          # rows of a block come one after another
                    held = r["block"]
                    index = BlockIndex(np.frombuffer(r["ids"], np.int64),
                                       np.frombuffer(r["vectors"], np.float64).reshape(-1, dim), longest, directions)
                qid = np.frombuffer(r["query_ids"], np.int64)
                i, ids, score = index.search(qid, np.frombuffer(r["queries"], np.float64).reshape(-1, dim),
                                             k, first, width, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(qid[i]), pa.array(ids), pa.array(score)],
                                                 names=["query_id", "vec_id", "score"])

    queries = (_packed(rows.where(is_query), query_blocks, "query_block")
               .select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                       F.col("ids").alias("query_ids"), F.col("vectors").alias("queries")))
    found = (_packed(rows, blocks, "block").join(queries, "block")
             .select("block", "ids", "vectors", "query_ids", "queries")
             .sortWithinPartitions("block").mapInArrow(run, RESULT))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
