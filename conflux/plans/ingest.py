"""Metadata-driven load (U2) and the task catalog.

A task row (a dict, or a Row of the task catalog) names the source kind,
the source, the target and the load options; :func:`ingest` reads, shapes,
checks and writes it. The catalog query that produces task rows is a chain
of left joins over the metadata tables -- all of them bounded in size by
the number of configured jobs, so they are broadcast.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from ..operators.conform import conform, enforce
from ..operators.joins import Dim, task_catalog
from ..operators.project import add_lineage, project_fields
from ..operators.windows import number_tasks
from ..session import new_path
from ..sinks.tables import (append_load, archive_source_files, finish_moves, list_files, load_with_rowcount, publish,
                            replace_with)
from ..sources.messages import generate_messages
from ..sources.relational import extract

#: Messages of a micro-batch of a consumer task that names no bound.
MAX_OFFSETS = 1_000_000
PRODUCED = "name string, address string, transaction_id string, amount bigint"


def shape(df: DataFrame, task: dict) -> DataFrame:
    """Field list (C1) and target types (C5) of a task."""
    if task.get("target_schema") is not None:
        return conform(df, task["target_schema"], mode=task.get("conform_mode", "strict"))
    if task.get("fields"):
        return project_fields(df, task["fields"])
    return df


def ingest(spark: SparkSession, task: dict, target_path: str | None = None) -> tuple[DataFrame, int | None]:
    """Task row -> source kind -> reader -> shape -> checks -> target.
    Without ``target_path`` only the shaped frame is returned.

    The source is read once, into a stage; the constraints are checked there
    and the stage is what gets loaded, so a failed load keeps the target. An
    incremental load of a run (``job_inst_id``) replaces what that run has
    loaded before, so doing it again doesn't double its rows; targets of runs
    are partitioned by it for that. With ``archive_files`` the input files move to ``processed/`` or, on failure,
    ``error/`` (B7)."""
    if target_path is None:
        df = shape(extract(spark, task), task)
        if task.get("constraints") is not None:
            enforce(df, task["constraints"])
        return df, None
    if task.get("archive_files"):
        finish_moves(spark, task["file_path"])
    files = list_files(spark, task["file_path"]) if task.get("archive_files") else []
    try:
        n = _load(spark, task, target_path)
    except Exception:
        if files:
            archive_source_files(spark, files, True, task.get("run_ts"))
        raise
    if files:
        archive_source_files(spark, files, False, task.get("run_ts"))
    return spark.read.parquet(target_path), n


def _load(spark: SparkSession, task: dict, target_path: str) -> int:
    df, run = shape(extract(spark, task), task), task.get("job_inst_id")
    if run is not None:
        df = add_lineage(df, run, task.get("run_ts") or datetime.now())
    stage = new_path(spark, "task-stage")
    n = load_with_rowcount(df, stage, mode="errorifexists", partition_by=["job_inst_id"] if run is not None else [])
    staged = spark.read.schema(df.schema).parquet(stage)
    if task.get("constraints") is not None:
        enforce(staged, task["constraints"])
    if task.get("is_full_load", True):
        replace_with(spark, stage, target_path)
    elif run is not None:
        append_load(staged, target_path, run_column="job_inst_id")
    else:
        append_load(staged, target_path)
    return n


def consume_task(spark: SparkSession, task: dict) -> int:
    """A Kafka consumer task: the topics that fit its pattern go through
    validation, dead letters, the per-topic cap and bounded micro-batches
    (S1-S4) into ``target_path``, with dead letters, state and checkpoint
    beside it. Messages come from the broker, or from files landed at
    ``file_path``. Returns the rows loaded in this run."""
    from ..sources.messages import kafka_source, subscribe
    from ..sources.relational import topic_pattern
    from ..streaming import consumer as SC

    table = task["target_path"].rstrip("/")
    targets = SC.IngestTargets(table=table, dlq=f"{table}_dlq", state=f"{table}_state",
                               group_id=task.get("kafka_group_id") or "etl-group",
                               created=task.get("run_ts") or datetime.now(), max_messages=task.get("max_message_num"))
    pattern = topic_pattern(task.get("kafka_topic_pattern")) or task["kafka_topic"]
    if task.get("file_path"):
        stream = subscribe(SC.message_file_stream(spark, task["file_path"], SC.MAX_FILES), pattern)
    else:
        stream = kafka_source(spark, task["kafka_bootstrap_servers"], pattern,
                              max_offsets_per_trigger=task.get("max_offsets_per_trigger") or MAX_OFFSETS)
    targets = replace(targets, run_id=time.time_ns())
    SC.consume_available(stream, targets, f"{table}_checkpoint")
    return SC.rows_of_run(spark, targets)


def produce_task(spark: SparkSession, task: dict) -> int:
    """A Kafka producer task (``job_type`` other than ETL): generated records
    (A11), one for each id of ``ids`` or ``kafka_batch_record_size`` of them,
    published (B10) to the broker, or landed at ``target_path`` where no broker
    is given. Returns the messages published."""
    ids = task.get("ids")
    if ids is None:
        ids = spark.range(int(task["kafka_batch_record_size"])).toDF("id")
    made = generate_messages(ids, ids.columns[0]).select("topic", "value")
    made = made.select("topic", F.from_json("value", PRODUCED).alias("r")).select("topic", "r.*")
    broker = task.get("kafka_bootstrap_servers")
    obs = Observation("published")
    publish(made.observe(obs, F.count(F.lit(1)).alias("rows")), broker,
            landing=None if broker else task["target_path"])
    return int(obs.get["rows"])


def run_task(spark: SparkSession, task: dict) -> int:
    """One task of any kind; the number of rows loaded or published."""
    if (task.get("conn_type") or "").strip().lower() == "kafka":
        if task.get("job_type") == "non-etl":
            return produce_task(spark, task)
        if task.get("is_kafka_consumer"):
            return consume_task(spark, task)
    return ingest(spark, task, task["target_path"])[1]


def job_tasks(job_inst_task: DataFrame, job_task: DataFrame, tbl: DataFrame, conn: DataFrame,
              job_inst_id: int, etl_step: str, task_id: int = 0, step: int = 20) -> DataFrame:
    """A reduced task catalog of one run and step (D2 + D3 + F1): each
    instance task with its definition, source and target table (the same
    ``tbl`` joined in two roles), its connection, and thread/sequence
    numbers. :func:`task_catalog_for` is the full form."""
    t = job_inst_task.filter((F.col("job_inst_id") == job_inst_id) & (F.col("etl_step") == etl_step))
    if task_id:
        t = t.filter(F.col("job_task_id") == task_id)
    src = tbl.select(F.col("tbl_id").alias("src_tbl_id"),
                     F.col("fully_qualified_tbl_name").alias("src_fully_qualified_tbl_name"),
                     F.col("incr_date").alias("src_incr_date"), F.col("incr_column").alias("src_incr_column"))
    tgt = tbl.select(F.col("tbl_id").alias("tgt_tbl_id"),
                     F.col("fully_qualified_tbl_name").alias("tgt_fully_qualified_tbl_name"))
    out = task_catalog(t, [Dim(job_task.drop("etl_step", "step_seq"), "job_task_id", bounded=True),
                           Dim(src, "src_tbl_id", bounded=True), Dim(tgt, "tgt_tbl_id", bounded=True),
                           Dim(conn, "conn_str_id", bounded=True)])
    return number_tasks(out, ["job_inst_id", "etl_step"], ["step_seq", "job_task_id"], step)


@dataclass
class Metadata:
    """The metadata tables (configuration: bounded by the number of
    configured jobs, tasks and connections)."""
    job_inst_task: DataFrame
    job_task: DataFrame
    job_inst: DataFrame
    job: DataFrame
    tbl: DataFrame
    conn_str: DataFrame
    conn_api: DataFrame
    conn_kafka: DataFrame
    sql_script: DataFrame
    data_source: DataFrame


# Connection-string fragments that name the database kind
# (case-insensitive, first match wins).
DB_TYPE_RULES = [("mssql", "MSSQL"), ("SQL Server", "MSSQL"), ("postgres", "POSTGRES")]


def _pick(df: DataFrame, key: str, alias: str, cols: dict[str, str]) -> DataFrame:
    """``df`` narrowed to its key (renamed ``alias``) and ``{out: col}``."""
    return df.select(F.col(key).alias(alias), *[F.col(c).alias(o) for o, c in cols.items()])


def task_catalog_for(md: Metadata, job_inst_id: int, etl_step: str, job_inst_task_id: int = 0,
                     run_ts: datetime | None = None, step: int = 20) -> DataFrame:
    """One row per instance task of a run and step -- the chain of ten
    left joins over the metadata tables (``tbl`` in two roles, D3; the
    parent API connection, D5), with the derived columns: ``sql_type`` and
    ``db_type`` (C7), name/url by connection type, ``src_incr_date``
    defaulting to the day before the run (C13), and thread/sequence numbers
    in ``step_seq`` order (F1). ``job_inst_task_id`` 0 means all tasks
    (C12)."""
    from ..functions.text import classify
    from ..operators.joins import with_parent
    from ..operators.project import null_default, optional_filter

    run_ts = run_ts or datetime.now()
    jit = optional_filter(md.job_inst_task.filter(F.col("job_inst_id") == job_inst_id)
                          .select("job_inst_task_id", "job_inst_id", "job_task_id", "task_status"),
                          "job_inst_task_id", job_inst_task_id)
    jt = md.job_task.select("job_task_id", "job_id", "job_task_name", "etl_step", "step_seq", "conn_type",
                            "src_tbl_id", "tgt_tbl_id", "conn_str_id", "conn_api_id", "conn_kafka_id",
                            "sql_script_id")
    ji = _pick(md.job_inst.filter(F.col("job_inst_id") == job_inst_id), "job_inst_id", "ji_id", {"ji_job_id": "job_id", "etl_steps": "etl_steps",
                                                      "is_full_load": "is_full_load",
                                                      "del_temp_data": "del_temp_data"})
    j = _pick(md.job, "job_id", "j_id", {"job_type": "job_type"})
    t1 = _pick(md.tbl, "tbl_id", "t1_id", {"src_fully_qualified_tbl_name": "fully_qualified_tbl_name",
                                           "t1_incr_date": "incr_date", "src_incr_column": "incr_column",
                                           "src_data_size": "data_size"})
    t2 = _pick(md.tbl, "tbl_id", "t2_id", {"tgt_fully_qualified_tbl_name": "fully_qualified_tbl_name"})
    cs = _pick(md.conn_str, "conn_str_id", "cs_id", {"cs_name": "conn_str_name", "cs_conn_str": "conn_str",
                                                     "username": "username", "pass": "pass",
                                                     "file_path": "file_path"})
    api_cols = ["conn_api_id", "parent_conn_api_id", "data_source_id", "conn_api_name", "api_url",
                "need_token", "payload_json", "page_param_name", "page_size", "cursor_param_name",
                "cursor_path", "max_pages", "output_file_path", "chunk_size", "username", "pass"]
    api = with_parent(md.conn_api.select(*api_cols), "conn_api_id", "parent_conn_api_id",
                      ["api_url", "username", "pass"], prefix="api_key_")
    api = api.select(F.col("conn_api_id").alias("api_id"), "data_source_id", "conn_api_name", "api_url",
                     "need_token", "payload_json", "page_param_name", "page_size", "cursor_param_name",
                     "cursor_path", "max_pages", "output_file_path", "chunk_size",
                     F.col("api_key_api_url").alias("api_key_url"), F.col("api_key_username"),
                     F.col("api_key_pass"))
    kafka = _pick(md.conn_kafka, "conn_kafka_id", "k_id", {
        "kafka_topic": "topic", "kafka_bootstrap_servers": "bootstrap_servers", "kafka_group_id": "group_id",
        "is_kafka_consumer": "is_consumer", "kafka_batch_record_size": "batch_record_size",
        "max_message_num": "max_message_num", "kafka_topic_pattern": "topic_pattern"})
    ss = _pick(md.sql_script, "sql_script_id", "ss_id", {"sql_text": "sql_text",
                                                         "is_stored_proc": "is_stored_proc"})
    ds = _pick(md.data_source, "data_source_id", "ds_id", {"data_source_name": "data_source_name"})

    b = F.broadcast
    out = (jit.join(b(jt), "job_task_id", "left")
              .join(b(ji), F.col("job_inst_id") == F.col("ji_id"), "left")
              .join(b(j), F.col("ji_job_id") == F.col("j_id"), "left")
              .join(b(t1), F.col("src_tbl_id") == F.col("t1_id"), "left")
              .join(b(t2), F.col("tgt_tbl_id") == F.col("t2_id"), "left")
              .join(b(cs), F.col("conn_str_id") == F.col("cs_id"), "left")
              .join(b(api), F.col("conn_api_id") == F.col("api_id"), "left")
              .join(b(kafka), F.col("conn_kafka_id") == F.col("k_id"), "left")
              .join(b(ss), F.col("sql_script_id") == F.col("ss_id"), "left")
              .join(b(ds), F.col("data_source_id") == F.col("ds_id"), "left")
              .filter(F.col("etl_step") == etl_step))
    is_db = F.col("conn_type") == "db"
    conn_str = F.when(is_db, F.col("cs_conn_str")).otherwise(F.col("api_url"))
    out = out.select(
        "job_inst_task_id", "job_id", "job_task_name", "etl_step", "step_seq",
        F.when(F.col("is_stored_proc").cast("int") == 1, "proc")
         .when(F.col("is_stored_proc").cast("int") == 0, "raw-sql")
         .alias("sql_type"),
        "sql_text",
        F.when(is_db, F.col("cs_name")).otherwise(F.col("conn_api_name")).alias("conn_str_name"),
        "conn_type", "username", "pass", "file_path", conn_str.alias("conn_str"), "need_token", "payload_json",
        F.when(is_db, classify(conn_str, DB_TYPE_RULES)).alias("db_type"),
        "src_fully_qualified_tbl_name", "tgt_fully_qualified_tbl_name",
        null_default("t1_incr_date", run_ts).alias("src_incr_date"), "src_incr_column", "src_data_size",
        "task_status", "api_key_url", "api_key_username", "api_key_pass",
        "page_param_name", "page_size", "cursor_param_name", "cursor_path", "max_pages", "output_file_path",
        "chunk_size", "data_source_name", "job_inst_id", "etl_steps", "is_full_load", "del_temp_data",
        "job_type", "kafka_topic", "kafka_bootstrap_servers", "kafka_group_id", "is_kafka_consumer",
        "kafka_batch_record_size", "max_message_num", "kafka_topic_pattern")
    return number_tasks(out, ["job_inst_id", "etl_step"], ["step_seq", "job_inst_task_id"], step)


def tasks_from_catalog(catalog: DataFrame, target_root: str, targets: dict[str, T.StructType] | None = None,
                       connections: dict[str, dict] | None = None) -> list[dict]:
    """Task rows of a catalog (:func:`task_catalog_for`) as dicts ready for
    :func:`run_step`; each target path is ``<target_root>/<schema>/<table>``
    from the target's qualified name (I1). Only configuration rows -- a
    run step's tasks -- are collected.

    ``targets`` gives the schema of each target table (by ``schema.table``):
    what file, JSON and API tasks read and what they are conformed to. Its
    file tasks archive their input. ``connections`` adds settings that
    metadata doesn't hold to the tasks of a connection (by
    ``conn_str_name``): partition column and bounds, driver. The user and
    password of a database row become reader options."""
    from ..functions.text import split_table_name

    named = catalog.withColumn("_tgt", split_table_name(F.col("tgt_fully_qualified_tbl_name")))
    root = target_root.rstrip("/")
    out = []
    for r in named.orderBy("task_thread_num").collect():
        d = r.asDict()
        tgt = d.pop("_tgt")
        d["target_path"] = f"{root}/{tgt['schema_name']}/{tgt['table_name']}"
        if d.get("file_path") is None and d.get("conn_type") == "parquet":
            d["file_path"] = d.get("conn_str")
        schema = (targets or {}).get(f"{tgt['schema_name']}.{tgt['table_name']}")
        if schema is not None:
            d |= {"fields": schema.fieldNames(), "schema": schema, "result_schema": schema, "target_schema": schema,
                  "archive_files": d.get("conn_type") == "file"}
        d |= (connections or {}).get(d.get("conn_str_name"), {})
        if d.get("conn_type") == "db" and d.get("username"):
            d["jdbc_properties"] = {"user": d["username"], "password": d["pass"], **d.get("jdbc_properties", {})}
        out.append(d)
    return out


def run_step(spark: SparkSession, tasks: list[dict], job_inst_id: int, log_path: str,
             run_ts: datetime | None = None) -> DataFrame:
    """Run the task rows of one ETL step in order (``step_seq``) and append
    a ``running`` and a ``succeeded``/``failed`` entry per task to the run
    log (B11); a failed task does not stop the others. Returns the step's
    status fold (E4). The loop is over configuration rows only -- each task
    is its own distributed job; no data passes through the driver."""
    from ..functions.timefmt import PHASE_BASE
    from ..operators.aggregates import run_status
    from ..sinks.tables import append_run_log

    run_ts = run_ts or datetime.now()
    entries = []
    for i, task in enumerate(sorted(tasks, key=lambda t: t.get("step_seq", 0)), start=1):
        step = (task.get("etl_step") or "").upper()
        seq = PHASE_BASE.get(step, 0) + i * 20          # I14 log order
        name = task.get("job_task_name", f"task {i}")
        entries.append((job_inst_id, seq, run_ts, name, "running", None, "run_step", False))
        try:
            n = run_task(spark, {**task, "job_inst_id": job_inst_id, "run_ts": run_ts})
            entries.append((job_inst_id, seq + 1, datetime.now(), name, "succeeded",
                            f"inserted rows || {n:,}", "run_step", False))
        except Exception as e:  # logged, like the reference's per-task error handling
            entries.append((job_inst_id, seq + 1, datetime.now(), name, "failed", str(e),
                            "run_step", True))
    log = spark.createDataFrame(entries, "job_inst_id int, logging_seq bigint, log_ts timestamp_ntz, "
                                         "task_name string, task_status string, error_msg string, "
                                         "context string, is_error boolean")
    append_run_log(log, log_path)
    return run_status(spark.read.parquet(log_path).filter(F.col("job_inst_id") == job_inst_id))
