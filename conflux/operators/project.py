"""Projections and row filters.

All of these are narrow expressions: Catalyst folds them into the scan's
whole-stage-codegen span and pushes the filters into the Parquet/JDBC scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T


def ts_literal(ts: datetime) -> Column:
    """A wall-clock ``timestamp_ntz`` literal, independent of the session
    and Python time zones."""
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def project_fields(df: DataFrame, fields: Sequence[str] | T.StructType) -> DataFrame:
    """Keep the listed fields in the given order; a field the input does
    not have becomes a typed null. Matching is case-insensitive, as header
    names are in the text layer."""
    if isinstance(fields, T.StructType):
        spec = [(f.name, f.dataType) for f in fields.fields]
    else:
        spec = [(f, T.StringType()) for f in fields]
    present = {c.lower(): c for c in df.columns}
    cols = []
    for name, dtype in spec:
        src = present.get(name.lower())
        cols.append((F.col(f"`{src}`") if src is not None else F.lit(None).cast(dtype)).alias(name))
    return df.select(cols)


def rename_map(df: DataFrame, mapping: Mapping[str, Column | str]) -> DataFrame:
    """Build target columns from source expressions, ``{target: source}``.
    A string source is a column name or SQL expression."""
    return df.select([(F.expr(src) if isinstance(src, str) else src).alias(tgt)
                      for tgt, src in mapping.items()])


def add_lineage(df: DataFrame, job_inst_id: int, load_ts: datetime | None = None,
                ts_column: str = "date_created") -> DataFrame:
    """C4: stamp the run id and the load timestamp. Pass ``load_ts`` (the
    run's start) to make a load reproducible; otherwise the query's
    ``current_timestamp()`` is used (one value per query)."""
    ts = (ts_literal(load_ts) if load_ts is not None
          else F.current_timestamp().cast("timestamp_ntz"))
    return df.withColumn("job_inst_id", F.lit(job_inst_id).cast("int")).withColumn(ts_column, ts)


def enrich_message(df: DataFrame, group_id: str, created: datetime | None = None) -> DataFrame:
    """Add ``group_id``, ``date_created`` and ``kafka_topic`` to each
    message of a Kafka-shaped frame."""
    ts = (ts_literal(created) if created is not None
          else F.current_timestamp().cast("timestamp_ntz"))
    return (df.withColumn("group_id", F.lit(group_id))
              .withColumn("date_created", ts)
              .withColumn("kafka_topic", F.col("topic")))


def run_scope(df: DataFrame, job_inst_id: int, column: str = "job_inst_id") -> DataFrame:
    """C11: only this run's rows. A literal equality: it prunes partitions
    when the table is partitioned by the column, and otherwise is a pushed
    Parquet filter that skips row groups when files are sorted by it."""
    return df.filter(F.col(column) == F.lit(job_inst_id))


def optional_filter(df: DataFrame, column: str, value) -> DataFrame:
    """``value`` 0 or None means no filter, else equality. The choice
    is made on the driver so the plan carries no dead predicate."""
    if value is None or value == 0:
        return df
    return df.filter(F.col(column) == F.lit(value))


def either_key(df: DataFrame, a: tuple[str, object], b: tuple[str, object],
               c: tuple[str, object]) -> DataFrame:
    """Lookup by (a and b) or by c, whichever key is given."""
    (ca, va), (cb, vb), (cc, vc) = a, b, c
    return df.filter(((F.col(ca) == F.lit(va)) & (F.col(cb) == F.lit(vb)))
                     | (F.col(cc) == F.lit(vc)))


def null_default(col: Column | str, run_ts: datetime | Column, days: int = 1) -> Column:
    """``coalesce(col, run_ts - days)`` -- the default incremental
    date is the day before the run."""
    c = F.col(col) if isinstance(col, str) else col
    ts = run_ts if isinstance(run_ts, Column) else ts_literal(run_ts)
    return F.coalesce(c, ts - F.make_dt_interval(F.lit(days)))
