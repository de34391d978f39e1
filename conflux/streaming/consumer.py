"""Structured Streaming message ingestion.

Source: any Kafka-shaped stream -- the Kafka connector
(:func:`conflux.sources.messages.kafka_source`) or JSON-lines message files
(:func:`message_file_stream`). Each micro-batch runs :func:`ingest_batch`
inside ``foreachBatch``: enrich (C6) -> per-topic cap carried across
batches (S4) -> validate and route (C9/C10, S6) -> valid rows to the table
(B9), rejects to the dead-letter sink (B8).

What a batch wrote shows all at once: its table rows, dead letters and counts
are read through the list of finished batches (:func:`read_table`,
:func:`read_dead_letters`), and a batch joins that list last.

Exactly-once per offset: the stream's checkpoint records which offsets a
batch covered, and every write of batch ``N`` goes to its own
``batch_id=N`` folder with ``overwrite`` -- a batch replayed after a
failure rewrites the same folder instead of appending twice. Batch size is
bounded by ``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger`` (S5), so no
micro-batch grows with the backlog.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F

from ..operators.project import enrich_message
from ..operators.validate import DLQ_VALUE, REASON, route
from ..operators.windows import cap_rows
from ..session import new_path
from ..sinks.tables import path_exists
from ..sources.messages import MESSAGE_SCHEMA

CAP_BUCKET = 1 << 16
MAX_FILES = 1000        # files of one micro-batch, unless the caller sets another bound
_TAKEN = "_taken"

# Typed fields of a message record in the target table.
RECORD_FIELDS = {"name": "string", "address": "string", "transaction_id": "string", "amount": "bigint"}


def write_message_files(msgs: DataFrame, path: str, n_files: int, ordered_times: bool = True) -> str:
    """Land a Kafka-shaped frame as JSON-lines files, each file a
    contiguous offset range (range partitioning, sorted within file).

    A file stream takes files oldest first. With ``ordered_times`` the
    files' modification times are set one second apart in offset order, so
    micro-batches arrive in offset order as they would from a Kafka
    partition (files written by parallel tasks otherwise finish in any
    order)."""
    (msgs.repartitionByRange(n_files, "offset", "topic")
         .sortWithinPartitions("offset", "topic")
         .write.mode("errorifexists").json(path))
    if ordered_times:
        import time
        from ..sinks.tables import _fs, list_files
        spark = msgs.sparkSession
        files = sorted(f for f in list_files(spark, path) if "/part-" in f)
        base = int(time.time() * 1000) - 1000 * (len(files) + 1)
        for i, f in enumerate(files):
            fs, p, _ = _fs(spark, f)
            try:
                fs.setTimes(p, base + 1000 * i, -1)
            except Exception:   # object stores keep their own times: arrival order not forced
                break
    return path



def message_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                        archive_dir: str | None = None, fmt: str = "json") -> DataFrame:
    """Kafka-shaped message files as a stream -- JSON lines by
    default, or ``fmt="parquet"`` (no envelope parsing). With
    ``archive_dir`` consumed files are moved there (B7's streaming form)."""
    r = spark.readStream.schema(MESSAGE_SCHEMA).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return r.load(path)


@dataclass
class IngestTargets:
    table: str                     # valid rows, partitioned by batch_id
    dlq: str                       # dead letters, partitioned by batch_id
    state: str | None = None       # per-topic taken counts and what is left pending (S4)
    group_id: str = "etl-group"
    created: datetime | None = None
    max_messages: int | None = None   # per topic and run
    in_order: bool = False            # offsets of a partition arrive in order: what is pending is kept as ranges
    run_id: int = 0                   # whose counts the cap goes by; 0: consume_available sets a new one

    @property
    def pending(self) -> str:
        return f"{self.state}_pending"

    @property
    def ranges(self) -> str:
        return f"{self.state}_ranges"

    @property
    def commits(self) -> str:
        return f"{self.table.rstrip('/')}_commits"

    @property
    def drains(self) -> str:
        return f"{self.state}_drains"


def _prior_counts(spark: SparkSession, t: IngestTargets, batch_id: int) -> DataFrame | None:
    if not path_exists(spark, t.state):
        return None
    st = _visible(spark, t, t.state)
    return (st.filter((F.col("run_id") == t.run_id) & (F.col("batch_id") < batch_id)).groupBy("topic")
              .agg(F.sum("taken").alias("_prior")))


def finished_batches(spark: SparkSession, t: IngestTargets) -> DataFrame:
    """``(batch_id, run_id, rows, rejects)``: one row for each batch that is
    written to its end."""
    schema = "run_id bigint, rows bigint, rejects bigint, batch_id bigint"
    if not path_exists(spark, t.commits):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(t.commits)


def _visible(spark: SparkSession, t: IngestTargets, path: str) -> DataFrame:
    """The rows of finished batches. ``batch_id`` is the partition column, so
    folders of other batches aren't read."""
    return spark.read.parquet(path).join(finished_batches(spark, t).select("batch_id"), "batch_id", "left_semi")


def read_table(spark: SparkSession, t: IngestTargets) -> DataFrame:
    """The loaded rows of finished batches."""
    return _visible(spark, t, t.table)


def read_dead_letters(spark: SparkSession, t: IngestTargets) -> DataFrame:
    """The dead letters of finished batches."""
    return _visible(spark, t, t.dlq)


def rows_of_run(spark: SparkSession, t: IngestTargets) -> int:
    """The rows that the finished batches of the run ``t.run_id`` loaded;
    counted while they were written."""
    done = finished_batches(spark, t).filter(F.col("run_id") == t.run_id)
    return int(done.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0])


def _staged(df: DataFrame, tag: str) -> DataFrame:
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


RANGES = "topic string, partition int, first bigint, last bigint"


def _past(batch: DataFrame, taken: DataFrame) -> DataFrame:
    """``(topic, partition, first, last)``: the offsets a batch leaves past the
    cap, one range for each partition, as a topic is taken in the order of
    partition and offset."""
    key = ["topic", "partition"]
    every = batch.groupBy(*key).agg(F.min("offset").alias("low"), F.max("offset").alias("last"))
    got = taken.groupBy(*[F.col(c).alias(f"_{c}") for c in key]).agg(F.max("offset").alias("_end"))
    same = F.col("topic").eqNullSafe(F.col("_topic")) & F.col("partition").eqNullSafe(F.col("_partition"))
    return (every.join(got, same, "left").select("topic", F.col("partition").cast("int").alias("partition"),
                                                 F.coalesce(F.col("_end") + 1, F.col("low")).alias("first"), "last")
            .filter("first <= last"))


def merged_ranges(ranges: DataFrame) -> DataFrame:
    """Ranges that overlap or follow one another as one. A window over the
    ranges of a partition, which are few: one a batch."""
    along = Window.partitionBy("topic", "partition").orderBy("first", "last")
    before = F.max("last").over(along.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before.isNull() | (F.col("first") > before + 1), 1).otherwise(0)
    return (ranges.withColumn("_opens", opens).withColumn("_of", F.sum("_opens").over(along))
            .groupBy("topic", "partition", "_of").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_of"))


def messages_in(landing: DataFrame, ranges: DataFrame) -> DataFrame:
    """The landed messages whose offsets lie in ranges that don't overlap."""
    r = ranges.select(F.col("topic").alias("_topic"), F.col("partition").alias("_partition"), "first", "last")
    inside = (F.col("topic").eqNullSafe(F.col("_topic")) & F.col("partition").eqNullSafe(F.col("_partition"))
              & F.col("offset").between(F.col("first"), F.col("last")))
    return landing.join(r, inside, "left_semi")


def ingest_batch(batch: DataFrame, batch_id: int, t: IngestTargets) -> None:
    """S3: one micro-batch, capped, validated and routed. The messages past
    the cap go as they are to ``t.pending``, or with ``t.in_order`` only their
    ranges of offsets to ``t.ranges``; the parsed ones to a written stage, from
    which table and dead letters are filled."""
    spark = batch.sparkSession
    if t.max_messages is not None:
        prior = _prior_counts(spark, t, batch_id) if t.state else None
        by = (["topic"], [F.col("partition"), F.col("offset")], [F.col("partition"), F.floor(F.col("offset") / CAP_BUCKET)])
        if t.in_order:
            taken = _staged(cap_rows(batch, *by, t.max_messages, prior=prior), "micro-batch")
            if t.state:
                _past(batch, taken).write.mode("overwrite").parquet(f"{t.ranges}/batch_id={batch_id}")
            batch = taken
        else:
            marked = _staged(cap_rows(batch, *by, t.max_messages, prior=prior, flag=_TAKEN), "micro-batch")
            batch = marked.filter(_TAKEN).drop(_TAKEN)
            if t.state:
                (marked.filter(~F.col(_TAKEN)).drop(_TAKEN)
                 .write.mode("overwrite").parquet(f"{t.pending}/batch_id={batch_id}"))
        if t.state:
            (batch.groupBy("topic").agg(F.count(F.lit(1)).cast("bigint").alias("taken"))
             .withColumn("run_id", F.lit(t.run_id).cast("bigint"))
             .write.mode("overwrite").parquet(f"{t.state}/batch_id={batch_id}"))
    counts = Observation("routes")
    routed = route(enrich_message(batch, t.group_id, t.created), RECORD_FIELDS).observe(
        counts, F.count(F.when(F.col(REASON).isNull(), 1)).alias("rows"), F.count(REASON).alias("rejects"))
    routed = _staged(routed, "routed")
    (routed.filter(F.col(REASON).isNull())
           .select("topic", "partition", "offset", "timestamp", *RECORD_FIELDS,
                   "group_id", "date_created", "kafka_topic")
           .write.mode("overwrite").parquet(f"{t.table}/batch_id={batch_id}"))
    (routed.filter(F.col(REASON).isNotNull())
           .select(F.col("topic").alias("source_topic"), "partition", "offset", REASON,
                   F.col(DLQ_VALUE).alias("value"))
           .write.mode("overwrite").parquet(f"{t.dlq}/batch_id={batch_id}"))
    # last: from here on the batch is read
    done = counts.get
    (spark.createDataFrame([(t.run_id, int(done["rows"]), int(done["rejects"]))], "run_id bigint, rows bigint, rejects bigint")
     .coalesce(1).write.mode("overwrite").parquet(f"{t.commits}/batch_id={batch_id}"))


def _pending_batches(spark: SparkSession, t: IngestTargets, checkpoint: str) -> tuple[list[int], int]:
    """The batches whose pending messages no drain has taken over, and the
    number of drains so far. A batch counts once its stream has committed
    it: one that hasn't will be run again."""
    left = t.ranges if t.in_order else t.pending
    if not (t.state and path_exists(spark, left)):
        return [], 0
    drains = spark.read.parquet(t.drains).collect() if path_exists(spark, t.drains) else []   # a row for each run
    over = {b for d in drains for b in d["covers"]}
    done = {d["drain"] for d in drains}
    found = [r["batch_id"] for r in spark.read.parquet(left).select("batch_id").distinct().collect()]
    return sorted(b for b in found if b not in over
                  and (b in done if b < 0 else path_exists(spark, f"{checkpoint}/commits/{b}"))), len(drains)


def _left(spark: SparkSession, t: IngestTargets, live: list[int], landing: DataFrame | None) -> DataFrame:
    if not live:
        return spark.createDataFrame([], MESSAGE_SCHEMA)
    if not t.in_order:
        return spark.read.parquet(t.pending).filter(F.col("batch_id").isin(live)).drop("batch_id")
    if landing is None:
        raise ValueError("pending ranges are read again from the landed messages")
    ranges = spark.read.schema(RANGES + ", batch_id bigint").parquet(t.ranges).filter(F.col("batch_id").isin(live))
    return messages_in(landing, merged_ranges(ranges.drop("batch_id")))


def drain_pending(spark: SparkSession, t: IngestTargets, checkpoint: str, landing: DataFrame | None = None) -> None:
    """Load what earlier runs left past the cap, up to this run's cap, as
    batch -1, -2, ...; what is still past it stays pending under that batch.
    The drain counts once its row in ``t.drains`` is written; a drain cut
    off before is done again into the same folders. Ranges (``t.in_order``)
    are read again from ``landing``."""
    live, drained = _pending_batches(spark, t, checkpoint)
    if not live:
        return
    number = -(drained + 1)
    ingest_batch(_left(spark, t, live, landing), number, t)
    (spark.createDataFrame([(live,)], "covers array<bigint>").coalesce(1)
     .write.mode("overwrite").parquet(f"{t.drains}/drain={number}"))


def pending_messages(spark: SparkSession, t: IngestTargets, checkpoint: str, landing: DataFrame | None = None) -> DataFrame:
    """The messages that no run has loaded yet because of the cap."""
    return _left(spark, t, _pending_batches(spark, t, checkpoint)[0], landing)


def consume_available(stream: DataFrame, targets: IngestTargets, checkpoint: str, landing: DataFrame | None = None) -> int:
    """Consume what is available now, then stop (the bounded run of a
    consumer that stops when idle). Returns the number of micro-batches.

    S4: a run takes up to ``max_messages`` of each topic. What it leaves
    stays pending and comes first in the next run, so nothing is lost though
    the stream commits its offsets; that needs ``targets.state``. Where each
    partition's offsets arrive in order, as from a broker, ``targets.in_order``
    keeps ranges instead of messages and reads them again from ``landing``, a
    batch frame of the same messages; nothing is written a second time."""
    if targets.in_order and targets.max_messages is not None and landing is None:
        raise ValueError("a capped run that keeps ranges needs the landed messages")
    if targets.max_messages is not None and not targets.state:
        raise ValueError("a capped run needs a state path for what it leaves")
    batches: list[int] = []
    targets = replace(targets, run_id=targets.run_id or time.time_ns())
    drain_pending(stream.sparkSession, targets, checkpoint, landing)

    def run(df: DataFrame, batch_id: int) -> None:
        ingest_batch(df, batch_id, targets)
        batches.append(batch_id)

    q = (stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return len(batches)


def consume(spark: SparkSession, source_path: str, targets: IngestTargets, replay: bool = False,
            checkpoint: str | None = None, fmt: str = "json", max_files_per_trigger: int = MAX_FILES) -> None:
    """``replay=True`` reads every message again on each run (a fresh
    consumer group that never commits) and appends, each run up to its own
    cap; the default keeps a checkpoint, so each offset is loaded once across
    runs, in micro-batches of at most ``max_files_per_trigger`` files."""
    if replay:
        batch = spark.read.schema(MESSAGE_SCHEMA).format(fmt).load(source_path)
        run = time.time_ns()
        ingest_batch(batch, run, replace(targets, state=None, run_id=targets.run_id or run))
    else:
        if not checkpoint:
            raise ValueError("a checkpoint location is required without replay")
        landing = spark.read.schema(MESSAGE_SCHEMA).format(fmt).load(source_path) if targets.in_order else None
        consume_available(message_file_stream(spark, source_path, max_files_per_trigger, fmt=fmt), targets, checkpoint, landing)
