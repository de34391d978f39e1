"""Named, parameterised SQL transforms (U1) and the two-step JSON
envelope load (U3).

A procedure is a name bound to SQL text (or a Python function returning a
DataFrame). Parameters are bound with ``spark.sql(text, args=...)``: values
never become SQL text, and a table parameter goes through
``IDENTIFIER(:name)``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.conform import Constraints, conform, enforce
from ..operators.joins import flatten_envelope
from ..operators.project import add_lineage, run_scope
from ..sinks.tables import append_run_log, reload_with_rowcount

Proc = str | Callable[..., DataFrame]

_REGISTRY: dict[str, Proc] = {}


def register(name: str, body: Proc) -> None:
    _REGISTRY[name.lower()] = body


def run_sql(spark: SparkSession, name: str, **params) -> DataFrame:
    """Run a registered transform with named parameters."""
    body = _REGISTRY[name.lower()]
    if callable(body):
        return body(spark, **params)
    return spark.sql(body, args=params)


def run_proc(spark: SparkSession, name: str, params: dict) -> DataFrame:
    """U1 as a task step (``EXEC proc @p_job_inst_id, @p_job_inst_task_id``):
    the task's standard parameters are offered to every procedure; a SQL
    body receives those it names (``:p_job_inst_id`` ...), a function body
    those it accepts."""
    import inspect
    import re

    body = _REGISTRY[name.lower()]
    if callable(body):
        sig = inspect.signature(body)
        takes_all = any(p.kind is p.VAR_KEYWORD for p in sig.parameters.values())
        kw = params if takes_all else {k: v for k, v in params.items() if k in sig.parameters}
        return body(spark, **kw)
    named = set(re.findall(r":([A-Za-z_][A-Za-z0-9_]*)", body))
    return spark.sql(body, args={k: v for k, v in params.items() if k in named})


# -- U3 -----------------------------------------------------------------

USER_ENVELOPE = T.StructType([
    T.StructField("page", T.IntegerType()),
    T.StructField("total", T.LongType()),
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()), T.StructField("name", T.StringType())]))),
    T.StructField("support", T.StructType([
        T.StructField("url", T.StringType()), T.StructField("text", T.StringType())])),
])

DBO_TARGET = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("name", T.StringType()),
    T.StructField("page", T.IntegerType()),
    T.StructField("total", T.IntegerType()),
    T.StructField("support_url", T.StringType()),
    T.StructField("support_text", T.StringType()),
])


def _text(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def _ints(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.IntegerType()) for n in names]


#: The resource shape: a page of coloured resources with its paging numbers.
RESOURCE_PAGING = ("page", "per_page", "total", "total_pages")
RESOURCE_ENVELOPE = T.StructType([
    *_ints(*RESOURCE_PAGING),
    T.StructField("data", T.ArrayType(T.StructType(
        [*_ints("id"), *_text("name"), *_ints("year"), *_text("color", "pantone_value")]))),
    T.StructField("support", T.StructType(_text("url", "text"))),
])
RESOURCE_TARGET = T.StructType([
    T.StructField("id", T.IntegerType(), False), *_text("name"), *_ints("year"), *_text("color", "pantone_value"),
    *_ints(*RESOURCE_PAGING), *_text("support_url", "support_text"),
])


def load_envelope(spark: SparkSession, docs: DataFrame, body: str, job_inst_id: int,
                  raw_path: str, dbo_path: str, log_path: str, load_ts: datetime,
                  envelope: T.StructType = USER_ENVELOPE, target: T.StructType = DBO_TARGET,
                  constraints: Constraints | None = None,
                  scalar_fields: Sequence[str] = ("page", "total")) -> DataFrame:
    """JSON -> raw (all text, full reload) -> this run's rows -> typed
    dbo (full reload), with the row counts of both steps appended to the
    run log. Returns the dbo table. The shape is that of users unless
    ``envelope``, ``target`` and ``scalar_fields`` name another one."""
    flat = flatten_envelope(docs, body, envelope, scalar_fields=scalar_fields)
    raw = add_lineage(flat.select([F.col(c).cast("string").alias(c) for c in flat.columns]),
                      job_inst_id, load_ts)
    n_raw = reload_with_rowcount(raw, raw_path)
    scoped = run_scope(spark.read.parquet(raw_path), job_inst_id)
    typed = conform(scoped, target, mode="strict")
    if constraints is not None:
        enforce(typed, constraints)
    n_dbo = reload_with_rowcount(add_lineage(typed, job_inst_id, load_ts), dbo_path)
    log = spark.createDataFrame(
        [(job_inst_id, 1, load_ts, "extract envelope", "running", f"raw inserted rows || {n_raw:,}", "raw", False),
         (job_inst_id, 2, load_ts, "load envelope", "running", f"dbo inserted rows || {n_dbo:,}", "dbo", False)],
        "job_inst_id int, logging_seq bigint, log_ts timestamp_ntz, task_name string, task_status string, "
        "error_msg string, context string, is_error boolean")
    append_run_log(log, log_path)
    return spark.read.parquet(dbo_path)


def load_resources(spark: SparkSession, docs: DataFrame, body: str, job_inst_id: int, raw_path: str, dbo_path: str,
                   log_path: str, load_ts: datetime, constraints: Constraints | None = None) -> DataFrame:
    """U3 for the resource shape."""
    return load_envelope(spark, docs, body, job_inst_id, raw_path, dbo_path, log_path, load_ts, RESOURCE_ENVELOPE,
                         RESOURCE_TARGET, constraints, RESOURCE_PAGING)
