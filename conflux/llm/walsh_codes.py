"""Operator 12: vector codes by parts, in integers from end to end.

Each component x becomes floor(1024 x), each vector is cut into ``parts``
equal consecutive parts, and each part position has a codebook of at most
``entries`` entries, fitted by ``rounds`` of assignment and floored means.
Every round reads all vectors in one pass; a task adds up its vectors by
(part, entry) and sends one row for each, so what is shuffled and what comes
to the driver is a codebook's size, not the data's.

The nearest entry is found in the Walsh-Hadamard domain: parts and entries,
zero-padded to a power of two, are transformed by integer butterflies and put
in sequency order (by sign changes), where smooth vectors have their weight
first. A transform of width w scales squared distances by exactly w, so
partial sums of squared differences are lower bounds of the scaled distance;
an entry is dropped once its sum exceeds the whole scaled distance of the
entry that led after the first coefficients. Ties stay until the end and go to
the lower index. Sums that could pass 64 bits are carried out with Python's
integers; there is no floating point after the floor.

Defined results: rows whose vector is null, empty or holds a null or
non-finite component are dropped. Vectors of different lengths, a length that
isn't a multiple of ``parts``, and components of 2^52 or more are errors. The
codebooks start from the least vec_ids, null ids last, repeated ids in the
order of their components. With fewer vectors than ``entries`` the codebooks
are that small; an empty table gives an empty result. Every kept row gives one
row, repeated rows included. ``label_error`` adds up the errors of equal
labels, nulls being one label.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import ready, staged

SCALE = 1024
#: Coefficients added between two eliminations.
STEP = 4
#: Parts compared with all entries at once.
CHUNK = 2048


def sequency_order(width: int) -> np.ndarray:
    """Where the Walsh function with k sign changes stands in the order of the
    butterflies: the bit-reversed Gray code of k."""
    k = np.arange(width)
    gray, out = k ^ (k >> 1), np.zeros(width, np.int64)
    for b in range(width.bit_length() - 1):
        out |= ((gray >> b) & 1) << (width.bit_length() - 2 - b)
    return out


def walsh(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of the rows of ``x``, zero-padded to a
    power of two, in sequency order."""
    n, w = x.shape
    width = 1 << max(0, w - 1).bit_length()
    out = np.zeros((n, width), x.dtype)
    out[:, :w] = x
    half = 1
    while half < width:
        pairs = out.reshape(n, width // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        half *= 2
    return out[:, sequency_order(width)]


def exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays as 64-bit integers where no scaled distance between their
    rows can pass them, else as Python's."""
    most = max((max(abs(int(a.max())), abs(int(a.min()))) for a in arrays if a.size), default=0)
    w = arrays[0].shape[1]
    fits = (1 << max(0, w - 1).bit_length()) * w * (2 * most) ** 2 < 1 << 62
    return [a.astype(np.int64 if fits else object) for a in arrays]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``parts`` the number of the nearest row of ``entries``
    (ties: the lower) and its squared distance."""
    parts, entries = exact(parts, entries)
    b = walsh(entries)
    width, codes, errors = b.shape[1], [], []
    for start in range(0, len(parts), CHUNK):
        a = walsh(parts[start:start + CHUNK])
        total = sum((a[:, c, None] - b[None, :, c]) ** 2 for c in range(min(STEP, width)))
        leader = total.argmin(1)
        bound = ((a - b[leader]) ** 2).sum(1)
        row, entry = np.nonzero(total <= bound[:, None])
        total = total[row, entry]
        for c in range(STEP, width, STEP):
            total = total + ((a[row, c:c + STEP] - b[entry, c:c + STEP]) ** 2).sum(1)
            stay = (total <= bound[row]).astype(bool)
            row, entry, total = row[stay], entry[stay], total[stay]
        least = np.minimum.reduceat(total, np.searchsorted(row, np.arange(len(a))))
        best = np.flatnonzero((total == least[row]).astype(bool))
        codes.append(entry[best[np.unique(row[best], return_index=True)[1]]])
        errors.append(least // width)
    if not codes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(codes), np.concatenate(errors)


def _components(vector: Column) -> Column:
    """The integer components; a component too large for exact sums is an error."""
    return F.transform(vector, lambda x: F.when(F.abs(x) < float(2**52), F.floor(x * F.lit(float(SCALE))))
                       .otherwise(F.raise_error(F.lit("a component is too large")).cast("long")))


def _matrix(batch: pa.RecordBatch, length: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, length)


def _assigned(v: np.ndarray, books: list[np.ndarray]):
    w = v.shape[1] // len(books)
    for p, book in enumerate(books):
        part = v[:, p * w:(p + 1) * w]
        yield part, *nearest(part, book)


def _improved(kept: DataFrame, books: list[np.ndarray], length: int) -> list[np.ndarray]:
    """The codebooks after one round over all vectors."""
    m, w = len(books[0]), length // len(books)

    def add(batches):
        sums = np.zeros((len(books), m, w), object)
        count = np.zeros((len(books), m), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            for p, (part, code, _) in enumerate(_assigned(_matrix(b, length), books)):
                fits = int(np.abs(part).max()) * len(part) < 1 << 62
                one = np.zeros((m, w), np.int64 if fits else object)
                np.add.at(one, code, part if fits else part.astype(object))
                sums[p] += one.astype(object)
                count[p] += np.bincount(code, minlength=m)
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e]),
             pa.array([[Decimal(x) for x in row] for row in sums[p, e]], pa.list_(pa.decimal128(38, 0)))],
            names=["part", "entry", "n", "sums"])

    rows = (kept.select("v").mapInArrow(add, "part int, entry int, n long, sums array<decimal(38,0)>")
            .select("part", "entry", "n", F.posexplode("sums").alias("at", "x"))
            .groupBy("part", "entry", "at").agg(F.sum("x").alias("x"), F.sum("n").alias("n")).collect())
    out = [book.copy() for book in books]
    for r in rows:       # a codebook's size at most
        out[r["part"]][r["entry"], r["at"]] = int(r["x"]) // r["n"]
    return out


def encode(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
           parts: int = 4, entries: int = 256, rounds: int = 4) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) for each kept row."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    spark = ready(vectors.sparkSession)
    own = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[label_col].alias("label"),
                         vectors[vector_col].cast("array<double>").alias("v"))
    usable = ((F.size("v") > 0)
              & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    kept = staged(own.where(F.col("v").isNotNull() & usable).withColumn("v", _components(F.col("v"))), "components")
    low, high = kept.agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    types = {f.name: f.dataType for f in kept.schema}
    coded = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", types["label"]),
                          T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if low is None:
        return (spark.createDataFrame([], coded).drop("label")
                .withColumns({"label_error": F.lit(0).cast("long"), "codebooks_sha256": F.lit("")}))
    if low != high or low % parts:
        raise ValueError(f"vectors of {low} to {high} components can't be cut into {parts} equal parts")
    first = (kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries)
             .agg(F.sort_array(F.collect_list(F.struct(F.col("vec_id").isNull().alias("none"), "vec_id", "v"))))
             .first()[0])
    start = np.array([r["v"] for r in first], np.int64)
    w = low // parts
    books = [start[:, p * w:(p + 1) * w] for p in range(parts)]
    for _ in range(rounds):
        books = _improved(kept, books, low)
    text = ",".join(str(int(x)) for book in books for entry in book for x in entry)
    digest = hashlib.sha256(text.encode()).hexdigest()

    def code(batches):
        for b in batches:
            if not b.num_rows:
                continue
            found = [(c, e) for _, c, e in _assigned(_matrix(b, low), books)]
            hexed = np.stack([c for c, _ in found], axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array([r.tobytes().hex() for r in hexed], pa.string()),
                 pa.array([int(x) for x in sum(e.astype(object) for _, e in found)], pa.int64())],
                names=["vec_id", "label", "code", "error"])

    done = staged(kept.mapInArrow(code, coded), "codes")
    sums = staged(done.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    sums = sums.withColumnRenamed("label", "of")
    return (done.join(sums, done.label.eqNullSafe(sums.of))
            .select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))
