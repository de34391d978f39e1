"""Helpers shared by the operators: session set-up, input columns, slicing
of Arrow batches and written stages."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import new_path

#: Text bytes a task works on at once; a longer single text is taken whole.
SLICE_BYTES = 4 << 20

_shipped: set[str] = set()


def ready(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches and give the executors this package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        path = os.path.join(tempfile.mkdtemp(prefix="conflux-code-"), "conflux_code.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(os.path.join(top, "conflux")):
                for n in sorted(names):
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.relpath(full, top))
        sc.addPyFile(path)
        _shipped.add(sc.applicationId)
    return spark


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                spark_ready: bool = True) -> DataFrame:
    """Only the two columns an operator reads, under fixed names, so that
    other columns of the input can have any name. A null text stays null."""
    if spark_ready:
        ready(docs.sparkSession)
    return docs.select(docs[id_col].cast("long").alias("doc_id"),
                       docs[text_col].cast("string").alias("text"))


def as_string_array(column) -> pa.Array:
    """A text column of a batch as one ``large_string`` array, null as empty."""
    import pyarrow.compute as pc
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return pc.fill_null(a.cast(pa.large_string()), "")


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that a slice holds at most ``most`` bytes of the
    column (or one row)."""
    import pyarrow.compute as pc
    for b in batches:
        if b.num_rows == 0:
            continue
        size = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size.astype(np.int64))
        start = 0
        while start < b.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield b.slice(start, stop - start)
            start = stop


def per_slice(fn: Callable[[pa.RecordBatch], pa.RecordBatch], most: int = SLICE_BYTES):
    """``mapInArrow`` function which applies ``fn`` to each slice."""
    def run(batches):
        for piece in slices(batches, "text", most):
            yield fn(piece)
    return run


def staged(df: DataFrame, tag: str, compression: str = "zstd") -> DataFrame:
    """Write a frame to the shared staging folder and read it back: later
    steps neither recompute it nor depend on one executor."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(id_column, n: int):
    """crc32 of the id's decimal text modulo ``n`` (null id: null)."""
    return F.crc32(id_column.cast("string").cast("binary")) % n
