"""Sinks (B1-B7, B10, B11).

Targets are path-based Parquet tables (or JDBC tables). Writes go through
Spark's commit protocol: a failed task or a lost executor is retried and
only committed files become visible, so a load is all-or-nothing. A path is
never overwritten while it is being read -- staging always writes a new
path first.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions.text import archive_file_name
from ..operators.conform import Constraints, enforce
from ..session import new_path


def truncate_and_load(df: DataFrame, path: str, fmt: str = "parquet",
                      partition_by: Sequence[str] = ()) -> None:
    """B1: full reload -- the target holds exactly this load afterwards.
    The load is written to a fresh stage first and promoted by a folder
    rename, so a failed job leaves the previous target in place (a direct
    ``overwrite`` deletes the target before writing)."""
    spark = df.sparkSession
    stage = new_path(spark, "reload-stage")
    w = df.write.mode("errorifexists").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(stage)
    replace_with(spark, stage, path)


def truncate_and_load_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
                           batch_size: int = 100) -> None:
    """B1 (JDBC): ``truncate=true`` keeps the table definition."""
    w = (df.write.format("jdbc").mode("overwrite").option("url", url).option("dbtable", table)
         .option("truncate", "true").option("batchsize", batch_size))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def append_load(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Sequence[str] = (), run_column: str | None = None) -> None:
    """B2: add rows to the target. With ``run_column`` (e.g. ``job_inst_id``)
    the target is partitioned by it and the load replaces only its own run
    partition(s) (dynamic partition overwrite): re-running a failed or
    repeated load does not append its rows twice."""
    if run_column is None:
        w = df.write.mode("append").format(fmt)
        if partition_by:
            w = w.partitionBy(*partition_by)
    else:
        w = (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").format(fmt)
               .partitionBy(run_column, *[c for c in partition_by if c != run_column]))
    w.save(path)


def load_with_rowcount(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                       partition_by: Sequence[str] = ()) -> int:
    """Write and report the rows written, counted while writing (an
    ``Observation``; no second pass over the data)."""
    obs = Observation(f"rows_{path.rsplit('/', 1)[-1]}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = observed.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return int(obs.get["rows"])


def reload_with_rowcount(df: DataFrame, path: str) -> int:
    """B1 + B4: full reload counted while writing, through a stage promoted
    by rename (a failed load keeps the previous target)."""
    spark = df.sparkSession
    stage = new_path(spark, "reload-stage")
    n = load_with_rowcount(df, stage, mode="errorifexists")
    replace_with(spark, stage, path)
    return n


def staged_insert(spark: SparkSession, df: DataFrame, target: str, run_id: int,
                  constraints: Constraints | None = None, drop_stage: bool = False,
                  stage_path: str | None = None) -> int:
    """Write ``temp_<table>_<run>`` first, check the target constraints
    on the stage (C14), then append the stage to the target (positional
    ``INSERT ... SELECT *``: the stage is renamed to the target's column
    order). Returns rows inserted. With ``drop_stage`` the stage folder is
    deleted afterwards."""
    name = target.rstrip("/").rsplit("/", 1)[-1]
    stage = stage_path or new_path(spark, f"temp_{name}_{run_id}")
    df.write.mode("errorifexists").parquet(stage)
    staged = spark.read.parquet(stage)
    if path_exists(spark, target):
        # positional, like INSERT ... SELECT *: i-th stage column -> i-th
        # target column, cast to its type (a width mismatch is an error)
        tgt = spark.read.parquet(target).schema
        if len(tgt.fields) != len(staged.columns):
            raise ValueError(f"stage has {len(staged.columns)} columns, target {len(tgt.fields)}")
        staged = staged.select([F.col(f"`{c}`").cast(f.dataType).alias(f.name)
                                for c, f in zip(staged.columns, tgt.fields)])
    if constraints is not None:
        enforce(staged, constraints)
    n = load_with_rowcount(staged, target, mode="append")
    if drop_stage:
        delete_path(spark, stage)
    return n


def chunked_insert(df: DataFrame, path: str, chunk: int = 100, fmt: str = "parquet") -> None:
    """Insert in chunks of ``chunk`` rows, in parallel over partitions
    (files of at most ``chunk`` records; no global row numbering)."""
    df.write.mode("append").format(fmt).option("maxRecordsPerFile", chunk).save(path)


def chunked_insert_jdbc(df: DataFrame, url: str, table: str, chunk: int = 100,
                        properties: dict | None = None) -> None:
    """B5 (JDBC): one multi-row batch per ``chunk`` rows in every partition."""
    w = (df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table)
         .option("batchsize", chunk))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def archive_json(df: DataFrame, root: str, job_inst_id: int, load_date: str) -> str:
    """Keep fetched records as JSON for reprocessing, partitioned by run
    and load date; re-read with :func:`conflux.sources.files.read_json_records`.
    Only this run/date partition is replaced (dynamic partition overwrite),
    so re-running a failed archive step does not duplicate it and leaves
    other runs alone."""
    (df.withColumn("job_inst_id", F.lit(job_inst_id)).withColumn("load_date", F.lit(load_date))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("job_inst_id", "load_date").json(root))
    return root


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def replace_with(spark: SparkSession, stage: str, target: str) -> None:
    """B1 by promotion: make a fully written and checked stage the target.
    The old target is renamed aside, the stage renamed in, and only then the
    old one deleted; if the rename fails the old target comes back. A stage on
    another file system is first copied next to the target."""
    src_fs, src, jvm = _fs(spark, stage)
    fs, dst, _ = _fs(spark, target)
    if not src_fs.exists(src):
        raise OSError(f"no stage {stage} to promote to {target}")
    fs.mkdirs(dst.getParent())
    beside = lambda tag: jvm.org.apache.hadoop.fs.Path(dst.getParent(), f"_{tag}-{uuid.uuid4().hex[:8]}-{dst.getName()}")
    if src_fs.getUri().toString() != fs.getUri().toString():
        near = beside("stage")
        jvm.org.apache.hadoop.fs.FileUtil.copy(src_fs, src, fs, near, False,
                                               spark.sparkContext._jsc.hadoopConfiguration())
        src = near
    old = beside("old") if fs.exists(dst) else None
    if old is not None and not fs.rename(dst, old):
        raise OSError(f"could not set {target} aside")
    if not fs.rename(src, dst):
        if old is not None:
            fs.rename(old, dst)
        raise OSError(f"could not promote {stage} to {target}")
    if old is not None:
        fs.delete(old, True)


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Data files of ``path`` (a file, or a folder's own files; folders in it,
    such as ``processed/``, and hidden and ``_`` files aren't) -- a
    driver-side listing of file names only."""
    fs, p, _ = _fs(spark, path)
    if fs.isFile(p):
        return [p.toString()]
    return sorted(st.getPath().toString() for st in fs.listStatus(p)
                  if st.isFile() and not st.getPath().getName().startswith((".", "_")))


MOVES = "_moves"
_MOVE_SCHEMA = "source string, target string"


def archive_source_files(spark: SparkSession, files: Sequence[str], failed: bool,
                         when: datetime | None = None) -> list[str]:
    """Move each input file to ``processed/`` (or ``error/`` with an
    ``err_`` prefix) beside it, named ``<name>_<yyyyMMdd_HHmmss><ext>``.

    The planned moves are written first, as a list under ``_moves/`` in the
    files' folder, and the list goes when all are done: a run that is cut off
    amid its moves leaves it, and :func:`finish_moves` does the rest, so each
    file is moved once. Renames are metadata operations, many at a time. (A
    file *stream* does the same with ``cleanSource=archive``.)"""
    when = when or datetime.now()
    stamp = when.strftime("%Y%m%d_%H%M%S")
    folder = F.concat(F.regexp_extract("source", "^(.*)/[^/]*$", 1), F.lit("/error/" if failed else "/processed/"))
    # the name rule is the I8 Column function; evaluate it once for the list
    plan = spark.createDataFrame([(f,) for f in files], "source string").select(
        "source", F.concat(folder, archive_file_name(F.col("source"), F.lit(stamp), failed)).alias("target"))
    if not files:
        return []
    path = f"{files[0].rsplit('/', 1)[0]}/{MOVES}/{uuid.uuid4().hex}"
    plan.coalesce(1).write.parquet(path)
    return _move(spark, path)


def finish_moves(spark: SparkSession, folder: str) -> list[str]:
    """The moves that a run planned for a folder and was cut off in, done now."""
    fs, p, jvm = _fs(spark, folder)
    if fs.isFile(p):
        p = p.getParent()
    plans = jvm.org.apache.hadoop.fs.Path(p, MOVES)
    if not fs.exists(plans):
        return []
    done = []
    for st in fs.listStatus(plans):
        # a list without its mark of success was never acted on
        if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            done += _move(spark, st.getPath().toString())
        else:
            fs.delete(st.getPath(), True)
    return done


def _move(spark: SparkSession, plan: str) -> list[str]:
    from concurrent.futures import ThreadPoolExecutor
    rows = spark.read.schema(_MOVE_SCHEMA).parquet(plan).collect()      # names only

    def one(row) -> str:
        fs, src, jvm = _fs(spark, row.source)
        dst = jvm.org.apache.hadoop.fs.Path(row.target)
        if not fs.exists(src):
            if fs.exists(dst):
                return row.target            # moved before the run was cut off
            raise OSError(f"{row.source} is gone, and not at {row.target}")
        fs.mkdirs(dst.getParent())
        if fs.exists(dst) or not fs.rename(src, dst):
            raise OSError(f"could not move {row.source} to {row.target}")
        return row.target

    with ThreadPoolExecutor(16) as pool:
        moved = list(pool.map(one, rows))
    delete_path(spark, plan)
    return moved


def publish(msgs: DataFrame, bootstrap_servers: str | None = None, topic_col: str = "topic",
            value_cols: Sequence[str] = ("name", "address", "transaction_id", "amount"),
            landing: str | None = None) -> DataFrame:
    """Each record as JSON text to its topic (fan-out by the ``topic``
    column). Returns the Kafka-shaped frame; with ``bootstrap_servers`` it
    is also written through the Kafka connector with ``acks=all`` and 3
    retries, with ``landing`` appended there as JSON lines."""
    out = msgs.select(F.col(topic_col).alias("topic"),
                      F.to_json(F.struct(*[F.col(c) for c in value_cols])).alias("value"))
    if bootstrap_servers:
        (out.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
            .option("kafka.acks", "all").option("kafka.retries", 3).save())
    if landing:
        out.write.mode("append").json(landing)
    return out


RUN_LOG_SCHEMA = ("job_inst_id int, logging_seq bigint, log_ts timestamp_ntz, task_name string, "
                  "task_status string, error_msg string, context string, is_error boolean")


def append_run_log(entries: DataFrame, log_path: str) -> None:
    """Append audit rows (one per event) to the run log table.

    Layout: partitioned by ``log_date`` (low cardinality) and sorted by
    ``(job_inst_id, log_ts)`` inside each file, so a run-scoped read (C11)
    is a pushed filter that skips row groups by their min/max statistics.
    A folder per run id would create one small file per task and run --
    the run id is unbounded over time -- and slow every listing."""
    cols = [c.strip().split(" ")[0] for c in RUN_LOG_SCHEMA.split(",")]
    types = [c.strip().split(" ")[1] for c in RUN_LOG_SCHEMA.split(",")]
    present = set(entries.columns)
    row = [(F.col(c) if c in present else F.lit(None)).cast(t).alias(c) for c, t in zip(cols, types)]
    (entries.select(row).withColumn("log_date", F.to_date("log_ts"))
            .sortWithinPartitions("log_date", "job_inst_id", "log_ts")
            .write.mode("append").partitionBy("log_date").parquet(log_path))


__all__ = ["truncate_and_load", "truncate_and_load_jdbc", "append_load", "load_with_rowcount",
           "staged_insert", "chunked_insert", "chunked_insert_jdbc", "archive_json",
           "archive_source_files", "finish_moves", "list_files", "publish", "reload_with_rowcount", "append_run_log", "delete_path", "path_exists", "replace_with"]
