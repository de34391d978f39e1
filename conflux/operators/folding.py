"""Run status kept up to date from the tail of the log.

The status of a run is a fold over its log entries, and the fold is made of
parts that merge: the last status and the first error with their places in
the log, the latest start and end, whether anything failed, how many entries.
A state keeps one such part for each run, and which log files it holds; an
update folds the files that came since and merges. It reads the tail of the
log and the state, whatever the log's age.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import new_path
from ..sinks.tables import path_exists, replace_with
from .aggregates import TERMINAL_STATUSES

#: Seconds after which a log file that was written is taken to be visible.
LATE = 3600
_PARTS = {"last": F.max, "start_time": F.max, "end_time": F.max, "error": F.min, "any_failed": F.bool_or, "n_entries": F.sum}


def fold(log: DataFrame, run: str = "job_inst_id", ts: str = "log_ts", seq: str = "logging_seq",
         status: str = "task_status", msg: str = "error_msg", is_error: str = "is_error") -> DataFrame:
    """One part for each run in the log."""
    st = F.col(status)
    place = [F.col(ts).alias("ts"), F.col(seq).alias("seq")]
    return log.groupBy(F.col(run).alias(run)).agg(
        F.max(F.when(st.isNotNull(), F.struct(*place, st.alias("status")))).alias("last"),
        F.max(F.when(st == "running", F.col(ts))).alias("start_time"),
        F.max(F.when(st.isin(*TERMINAL_STATUSES), F.col(ts))).alias("end_time"),
        F.min(F.when(F.col(is_error), F.struct(*place, F.col(msg).alias("msg")))).alias("error"),
        F.coalesce(F.bool_or(st == "failed"), F.lit(False)).alias("any_failed"),
        F.count(F.lit(1)).cast("bigint").alias("n_entries"))


def merge(a: DataFrame, b: DataFrame, run: str = "job_inst_id") -> DataFrame:
    """The parts of two pieces of a log as one for each run."""
    return a.unionByName(b).groupBy(run).agg(*[f(c).alias(c) for c, f in _PARTS.items()])


def status_of(parts: DataFrame, run: str = "job_inst_id") -> DataFrame:
    """The columns of :func:`conflux.operators.aggregates.run_status`."""
    return parts.select(run, F.col("last.status").alias("last_status"), "start_time", "end_time",
                        F.col("error.msg").alias("error_msg"), "any_failed", F.col("n_entries").cast("bigint").alias("n_entries"))


def update_status(spark: SparkSession, log_path: str, state_path: str, late: int = LATE) -> DataFrame:
    """Fold what the log has gained since the last update into the state;
    the status of all runs.

    A file of the log counts as new by its modification time and name: those of
    the last ``late`` seconds before the newest one are remembered by name, as
    a file can become visible after a later one; older files are not even
    listed to a task. The new state replaces the old one by a rename, so an
    update that fails is done again from the same state."""
    log = spark.read.parquet(log_path).withColumns({"_file": F.col("_metadata.file_path"),
                                                    "_at": F.col("_metadata.file_modification_time")})
    known = path_exists(spark, state_path)
    if known:
        held = spark.read.parquet(f"{state_path}/files")
        newest = held.agg(F.max("_at")).first()[0]
        if newest is not None:
            log = log.where(F.col("_at") >= F.lit(newest) - F.expr(f"make_dt_interval(0, 0, 0, {int(late)})"))
        log = log.join(held.select("_file"), "_file", "left_anti")
    stage = new_path(spark, "run-status")
    parts = fold(log)
    if known:
        parts = merge(spark.read.parquet(f"{state_path}/parts"), parts)
    files = log.select("_file", "_at").distinct()
    if known:
        files = files.unionByName(held)
    files.write.parquet(f"{stage}-files")
    files = spark.read.schema(files.schema).parquet(f"{stage}-files")
    last = files.agg(F.max("_at")).first()[0]
    kept = files if last is None else files.where(F.col("_at") >= F.lit(last) - F.expr(f"make_dt_interval(0, 0, 0, {int(late)})"))
    parts.write.parquet(f"{stage}/parts")
    kept.write.parquet(f"{stage}/files")
    replace_with(spark, stage, state_path)
    return status_of(spark.read.parquet(f"{state_path}/parts"))
