"""Aggregations (E1-E5) and ordering/limit operators (G1-G3), set
operators (H1, H2).

All aggregates here are declarative (``count``, ``min_by``, ``max_by``,
``bool_or``), so Catalyst plans partial aggregation before the shuffle: a
hot group key costs one partial row per map task, not its raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.timefmt import TERMINAL_STATUSES


def row_count(df: DataFrame) -> DataFrame:
    """One-row count (Parquet answers from footers when it can)."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))


def count_by_topic(msgs: DataFrame, topic: str = "topic") -> DataFrame:
    """Messages per topic."""
    return msgs.groupBy(topic).agg(F.count(F.lit(1)).cast("bigint").alias("n_messages"))


def topics_seen(msgs: DataFrame, topic: str = "topic") -> DataFrame:
    """E5: the set of topics seen."""
    return msgs.select(topic).distinct()


def _order_key(log: DataFrame, ts: str, seq: str) -> Column:
    return F.struct(F.col(ts), F.col(seq))


def first_error(log: DataFrame, run: str = "job_inst_id", ts: str = "log_ts",
                seq: str = "logging_seq", msg: str = "error_msg", is_error: str = "is_error") -> DataFrame:
    """First error text of each run (earliest by ``(ts, seq)``; the
    order makes the pick deterministic)."""
    return (log.filter(F.col(is_error))
               .groupBy(run)
               .agg(F.min_by(F.col(msg), _order_key(log, ts, seq)).alias("first_error")))


def run_status(log: DataFrame, run: str = "job_inst_id", ts: str = "log_ts", seq: str = "logging_seq",
               status: str = "task_status", msg: str = "error_msg", is_error: str = "is_error") -> DataFrame:
    """Fold of an append-only status log into one row per run, replacing
    repeated UPDATEs: last status wins (by ``(ts, seq)``), start = last
    ``running`` time, end = last terminal time, first error text, and
    ``any_failed`` so that a later ``succeeded`` cannot mask a failure."""
    key = _order_key(log, ts, seq)
    st = F.col(status)
    return log.groupBy(run).agg(
        # an aggregate ignores rows whose ordering value is null: this is
        # max_by(...) FILTER (WHERE ...)
        F.max_by(st, F.when(st.isNotNull(), key)).alias("last_status"),
        F.max(F.when(st == "running", F.col(ts))).alias("start_time"),
        F.max(F.when(st.isin(*TERMINAL_STATUSES), F.col(ts))).alias("end_time"),
        F.min_by(F.col(msg), F.when(F.col(is_error), key)).alias("error_msg"),
        F.coalesce(F.bool_or(st == "failed"), F.lit(False)).alias("any_failed"),
        F.count(F.lit(1)).cast("bigint").alias("n_entries"))


def order_by_step(df: DataFrame, order: Sequence[Column | str], n: int | None = None) -> DataFrame:
    """G1: ordered output; with ``n`` a top-k (``TakeOrderedAndProject``:
    each task keeps its k best rows, only those reach the final merge)."""
    out = df.orderBy(*order)
    return out.limit(n) if n is not None else out


def first_row(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """The first row by ``order`` (``TOP 1`` / ``fetchone``)."""
    return df.orderBy(*order).limit(1)


def bounded(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """A global bounded read (the first ``n`` rows by ``order``); per-key
    bounds are :func:`conflux.operators.windows.cap_rows`."""
    return df.orderBy(*order).limit(n)


# The step rows each job step string expands to; any other
# text expands to nothing.
STEP_ROWS = {"E": ("E",), "TL": ("T", "L"), "ETL": ("E", "T", "L")}


def step_rows(jobs: DataFrame, steps_col: str = "etl_steps") -> DataFrame:
    """H1: ``UNION ALL`` of one row per step the job runs, as one scan and an
    ``explode``. ``EL`` and other strings yield no rows (so this is not a
    character split)."""
    steps = F.lit(None).cast("array<string>")
    for text, rows in STEP_ROWS.items():
        steps = F.when(F.col(steps_col) == text, F.array(*map(F.lit, rows))).otherwise(steps)
    return jobs.withColumn("etl_step", F.explode(steps))


def same_sets(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """H2: one row ``same``: are the distinct values of ``a.col`` and
    ``b.col`` the same set? A null is a value like any other. Both are
    grouped by value at once (one shuffle, after a partial aggregation)."""
    both = (a.select(F.col(col).alias("_v"), F.lit(True).alias("_a"), F.lit(False).alias("_b"))
            .unionAll(b.select(F.col(col), F.lit(False), F.lit(True))))
    seen = both.groupBy("_v").agg(F.bool_or("_a").alias("_a"), F.bool_or("_b").alias("_b"))
    return seen.agg(F.coalesce(F.bool_and(F.col("_a") & F.col("_b")), F.lit(True)).alias("same"))
