"""S1-S6 with micro-batches arriving in offset order."""

import time

from pyspark.sql import functions as F

from conflux import fixtures as fx
from conflux.streaming.consumer import IngestTargets, consume, consume_available, message_file_stream


def _land_in_order(spark, msgs, root, n_files):
    # one write per offset range, in offset order, so file times follow offsets
    bounds = msgs.agg(F.max("offset")).first()[0] + 1
    step = -(-bounds // n_files)
    for i in range(n_files):
        part = msgs.filter((F.col("offset") >= i * step) & (F.col("offset") < (i + 1) * step))
        part.coalesce(1).write.mode("append").json(root)
        time.sleep(1.1)


def test_cap_carries_across_batches(spark, sf, tmp_path):
    msgs = fx.messages(spark.read.parquet(f"{sf}/events.parquet"))
    root = str(tmp_path / "src")
    _land_in_order(spark, msgs, root, 3)
    t = IngestTargets(table=str(tmp_path / "tbl"), dlq=str(tmp_path / "dlq"), state=str(tmp_path / "st"),
                      max_messages=150)
    n_batches = consume_available(message_file_stream(spark, root, max_files_per_trigger=1), t,
                                  str(tmp_path / "ck"))
    assert n_batches == 3
    got = (spark.read.parquet(t.table).select("topic", "offset")
           .unionByName(spark.read.parquet(t.dlq).select(F.col("source_topic").alias("topic"), "offset")))
    exp = msgs.filter(F.col("offset") < 150).select("topic", "offset")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


def test_replay_doubles_checkpoint_does_not(spark, sf, tmp_path):
    msgs = fx.messages(spark.read.parquet(f"{sf}/events.parquet"))
    root = str(tmp_path / "src")
    msgs.write.json(root)
    a = IngestTargets(table=str(tmp_path / "a"), dlq=str(tmp_path / "ad"))
    b = IngestTargets(table=str(tmp_path / "b"), dlq=str(tmp_path / "bd"))
    for _ in range(2):
        consume(spark, root, a, replay=True)
        consume(spark, root, b, replay=False, checkpoint=str(tmp_path / "ck"))
    n_valid = spark.read.parquet(b.table).count()
    assert n_valid > 0
    assert spark.read.parquet(a.table).count() == 2 * n_valid


def test_file_stream_archives_consumed_files(spark, sf, tmp_path):
    import os
    msgs = fx.messages(spark.read.parquet(f"{sf}/events.parquet"))
    root, arch = str(tmp_path / "src"), str(tmp_path / "archive")
    _land_in_order(spark, msgs, root, 2)
    t = IngestTargets(table=str(tmp_path / "tbl"), dlq=str(tmp_path / "dlq"))
    ck = str(tmp_path / "ck")
    for _ in range(2):   # the last file of a run is archived by the next run
        consume_available(message_file_stream(spark, root, max_files_per_trigger=1, archive_dir=arch), t, ck)
    archived = [f for _, _, fs in os.walk(arch) for f in fs if f.endswith(".json")]
    assert len(archived) >= 1
    assert spark.read.parquet(t.table).count() + spark.read.parquet(t.dlq).count() == msgs.count()


def test_replayed_batch_is_idempotent(spark, sf, tmp_path):
    from conflux.streaming.consumer import ingest_batch
    msgs = fx.messages(spark.read.parquet(f"{sf}/events.parquet"))
    t = IngestTargets(table=str(tmp_path / "tbl"), dlq=str(tmp_path / "dlq"), state=str(tmp_path / "st"),
                      max_messages=10**9)
    ingest_batch(msgs, 0, t)
    ingest_batch(msgs, 0, t)          # the same batch again, e.g. after a failure before the commit
    total = spark.read.parquet(t.table).count() + spark.read.parquet(t.dlq).count()
    assert total == msgs.count()
    assert spark.read.parquet(t.state).groupBy().sum("taken").first()[0] == msgs.count()


def test_parquet_message_files(spark, sf, tmp_path):
    msgs = fx.messages(spark.read.parquet(f"{sf}/events.parquet"))
    root = str(tmp_path / "pq")
    msgs.write.parquet(root)
    t = IngestTargets(table=str(tmp_path / "tbl"), dlq=str(tmp_path / "dlq"))
    consume_available(message_file_stream(spark, root, fmt="parquet"), t, str(tmp_path / "ck"))
    assert spark.read.parquet(t.table).count() + spark.read.parquet(t.dlq).count() == msgs.count()
