"""Flat file to typed table (the flagship load).

``text CSV -> read by header (A4) -> project fields (C1) -> empty text to
null + cast (C5) -> lineage (C4) -> typed stage, counted while writing
(B4) -> target constraints on the stage (C14) -> stage promoted to target
(B1)``.

Quoted fields may hold line breaks, and the files stay splittable: a first
scan counts quotes by byte range (:mod:`conflux.sources.quoted`). The text is
parsed exactly once: parsing and casting are one narrow stage (no shuffle but
of ranges with quoted line breaks) that writes a columnar stage. Constraint checks then read only
the constrained columns of the stage (partial aggregation on the primary
key), and a clean stage replaces the target by a folder rename. A bad value
(strict cast) or a violated constraint leaves the target untouched.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from ..operators.conform import REJECT_COLUMN, Constraints, conform, enforce
from ..operators.project import add_lineage
from ..session import new_path
from ..sinks.tables import archive_source_files, delete_path, finish_moves, list_files, load_with_rowcount, replace_with
from ..sources.quoted import REASON, read_records, split, strict


@dataclass
class LoadResult:
    target: str
    rows: int
    rejected: int = 0


def typed_from_text(spark: SparkSession, csv_path: str, target: T.StructType,
                    encoding: str = "ISO-8859-1", sep: str = ",", mode: str = "strict") -> DataFrame:
    """Raw text rows (by each file's header) conformed to the target schema.
    A record with another number of fields than its header is an error; in
    reject mode it is a reject."""
    raw = read_records(spark, csv_path, target.fieldNames(), sep=sep, encoding=encoding)
    if mode == "strict":
        return conform(strict(raw), target, mode=mode)
    typed = conform(raw, T.StructType([*target.fields, T.StructField(REASON, T.StringType())]), mode=mode)
    return typed.withColumn(REJECT_COLUMN, F.coalesce(REASON, REJECT_COLUMN)).drop(REASON)


def _stage_split(spark: SparkSession, typed: DataFrame, stage: str) -> tuple[int, int]:
    """Reject mode: one write of the conformed rows, partitioned by
    ``route`` -- ``ok``, or the reject reason -- counting both while
    writing. The ``route=ok`` folder then holds exactly the target's
    columns and can be promoted as it is."""
    obs = Observation("routes")
    routed = (typed.withColumn("route", F.coalesce(F.col(REJECT_COLUMN), F.lit("ok"))).drop(REJECT_COLUMN)
                   .observe(obs, F.count(F.when(F.col("route") == "ok", 1)).alias("ok"),
                            F.count(F.when(F.col("route") != "ok", 1)).alias("rejected")))
    routed.write.mode("errorifexists").partitionBy("route").parquet(stage)
    got = obs.get
    return int(got["ok"]), int(got["rejected"])


def _move_rejects(spark: SparkSession, stage: str, reject_path: str) -> None:
    """Move every ``route=<reason>`` folder of the stage under
    ``reject_path`` (read back, ``route`` is the reject reason)."""
    from ..sinks.tables import _fs
    fs, root, jvm = _fs(spark, stage)
    dst_root = jvm.org.apache.hadoop.fs.Path(reject_path)
    fs.mkdirs(dst_root)
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("route=") and name != "route=ok":
            if not fs.rename(st.getPath(), jvm.org.apache.hadoop.fs.Path(dst_root, name)):
                raise OSError(f"could not move {name} to {reject_path}")


def load_flat_file(spark: SparkSession, csv_path: str, target_schema: T.StructType,
                   target_path: str, job_inst_id: int, load_ts: datetime,
                   constraints: Constraints | None = None, encoding: str = "ISO-8859-1",
                   sep: str = ",", archive_files: bool = False,
                   reject_path: str | None = None) -> LoadResult:
    """Load, check and publish.

    * Without ``reject_path`` any value that does not convert fails the
      load (strict, like the reference's procedure).
    * With ``reject_path`` such rows are set aside instead: one write
      routes them to ``reject_path`` (with ``reject_reason``), and the
      target gets the rest. Of records with a wrong number of fields or an
      unclosed quote, ``<reject_path>/_records`` keeps the text.

    With ``archive_files`` the input files are moved to ``processed/``
    after a good load, or to ``error/`` (``err_`` prefix) when the load
    fails -- and the error is raised, never swallowed."""
    if archive_files:
        finish_moves(spark, csv_path)
    inputs = list_files(spark, csv_path) if archive_files else []
    rejected = 0
    try:
        stage = new_path(spark, f"stage_{target_path.rstrip('/').rsplit('/', 1)[-1]}_{job_inst_id}")
        if reject_path is None:
            typed = typed_from_text(spark, csv_path, target_schema, encoding, sep)
            n = load_with_rowcount(add_lineage(typed, job_inst_id, load_ts), stage, mode="errorifexists")
            good = stage
        else:
            typed = add_lineage(typed_from_text(spark, csv_path, target_schema, encoding, sep, mode="reject"),
                                job_inst_id, load_ts)
            n, rejected = _stage_split(spark, typed, stage)
            good = f"{stage}/route=ok"
            if n == 0:     # no good rows: an empty target with the target's columns
                spark.createDataFrame([], typed.drop(REJECT_COLUMN).schema).write.parquet(good)
        if constraints is not None:
            enforce(spark.read.parquet(good), constraints)
        if reject_path is not None and rejected:
            _move_rejects(spark, stage, reject_path)
            malformed = split(read_records(spark, csv_path, target_schema.fieldNames(), sep=sep, encoding=encoding))[1]
            malformed.write.mode("overwrite").parquet(f"{reject_path}/_records")
        replace_with(spark, good, target_path)
        if reject_path is not None:
            delete_path(spark, stage)      # only the stage's bookkeeping files are left
    except Exception:
        if inputs:
            archive_source_files(spark, inputs, failed=True)
        raise
    if inputs:
        archive_source_files(spark, inputs, failed=False)
    return LoadResult(target_path, n, rejected)
