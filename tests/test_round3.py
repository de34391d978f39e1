"""Moves that survive a cut-off run, batches that show all at once, constraints in one scan, sets with nulls."""

import datetime as dt
import os
import random
import re
from collections import Counter

import pytest

from conflux.operators.aggregates import same_sets
from conflux.operators.conform import Constraints, ConstraintViolation, enforce, violated, violations
from conflux.sinks import tables as SK
from conflux.streaming import consumer as SC
from pyspark.sql import functions as F

WHEN = dt.datetime(2024, 1, 2, 3, 4, 5)


def tree(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names
                  if not f.startswith((".", "_")) and "_moves" not in d)


def test_archived_files_stay_where_they_are(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"day{k}.csv").write_text("x")
        SK.archive_source_files(spark, SK.list_files(spark, str(tmp_path)), failed=k == 1, when=WHEN)
    assert tree(tmp_path) == ["error/err_day1_20240102_030405.csv", "processed/day0_20240102_030405.csv",
                              "processed/day2_20240102_030405.csv"]
    assert SK.list_files(spark, str(tmp_path)) == [] and SK.archive_source_files(spark, [], False) == []


def test_a_cut_off_run_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    for k in range(40):
        (tmp_path / f"f{k}.csv").write_text(str(k))
    files = SK.list_files(spark, str(tmp_path))

    def cut(spark, plan):
        for row in spark.read.parquet(plan).collect()[:7]:       # some are moved, then the run ends
            path = row.target.removeprefix("file:")
            os.makedirs(os.path.dirname(path), exist_ok=True)
            os.rename(row.source.removeprefix("file:"), path)
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(SK, "_move", cut)
        with pytest.raises(KeyboardInterrupt):
            SK.archive_source_files(spark, files, failed=False, when=WHEN)
    assert len(SK.list_files(spark, str(tmp_path))) == 33
    (tmp_path / "new.csv").write_text("new")
    assert len(SK.finish_moves(spark, str(tmp_path))) == 40 and SK.finish_moves(spark, str(tmp_path)) == []
    assert tree(tmp_path) == sorted(["new.csv", *[f"processed/f{k}_20240102_030405.csv" for k in range(40)]])
    (tmp_path / "_moves" / "unfinished").mkdir(parents=True)     # a list that was never written to its end
    assert SK.finish_moves(spark, str(tmp_path)) == [] and tree(tmp_path)[0] == "new.csv"


def test_a_taken_name_is_an_error_and_nothing_is_lost(spark, tmp_path):
    for _ in range(2):
        (tmp_path / "a.csv").write_text("x")
        if not (tmp_path / "processed").exists():
            SK.archive_source_files(spark, SK.list_files(spark, str(tmp_path)), False, WHEN)
    with pytest.raises(OSError, match="could not move"):
        SK.archive_source_files(spark, SK.list_files(spark, str(tmp_path)), False, WHEN)
    assert tree(tmp_path) == ["a.csv", "processed/a_20240102_030405.csv"]


def messages(spark, n, start=0):
    rows = [("t", 0, start + i, '{"name":"n","address":"a","transaction_id":"%d","amount":1}' % i if i % 4 else "{bad")
            for i in range(n)]
    return (spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string")
            .withColumn("timestamp", F.lit("2024-01-01T00:00:00").cast("timestamp_ntz")).withColumn("key", F.lit(None).cast("string")))


def test_a_batch_shows_all_at_once(spark, tmp_path):
    t = SC.IngestTargets(table=str(tmp_path / "t"), dlq=str(tmp_path / "d"), state=str(tmp_path / "s"), max_messages=100, run_id=5)
    SC.ingest_batch(messages(spark, 20), 0, t)
    assert SC.read_table(spark, t).count() == 15 and SC.read_dead_letters(spark, t).count() == 5
    (tmp_path / "d2").write_text("no folder")                    # the dead letters can't be written
    cut = SC.IngestTargets(**{**t.__dict__, "dlq": str(tmp_path / "d2" / "x")})
    with pytest.raises(Exception):
        SC.ingest_batch(messages(spark, 8, 20), 1, cut)
    assert spark.read.parquet(t.table).count() == 21             # half a batch is there
    assert SC.read_table(spark, t).count() == 15 and SC.rows_of_run(spark, t) == 15
    assert SC._prior_counts(spark, t, 9).first()["_prior"] == 20
    SC.ingest_batch(messages(spark, 8, 20), 1, t)                # the same batch again
    assert SC.read_table(spark, t).count() == 21 and SC.read_dead_letters(spark, t).count() == 7
    assert SC.rows_of_run(spark, t) == 21
    assert sorted((r.batch_id, r.run_id, r.rows, r.rejects) for r in SC.finished_batches(spark, t).collect()) == [(0, 5, 15, 5), (1, 5, 6, 2)]


SPEC = Constraints(not_null=["a"], primary_key=["a", "b"], max_length={"t": 5, "b": 3})


def test_all_constraints_are_one_scan_and_no_text_is_shuffled(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, 1, 2, 3]), rnd.choice([None, "x", "xy", "x,y", "long"]), rnd.choice([None, "", "short", "too long", "été !!"]))
            for _ in range(300)]
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, "a int, b string, t string").write.parquet(path)
    df = spark.read.parquet(path)
    plan = violated(df, SPEC)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    shuffled = re.findall(r"Exchange hashpartitioning\((.*?)\)", plan)[0]
    assert "rule_no" in shuffled and "digest" in shuffled
    want = Counter()
    for a, b, t in rows:
        want["not_null", "a", None] += a is None
        want["not_null", "b", None] += b is None
        if t is not None and len(t) > 5:
            want["max_length", "t", t] += 1
        if b is not None and len(b) > 3:
            want["max_length", "b", b] += 1
    for (a, b), n in Counter((a, b) for a, b, _ in rows).items():
        if n > 1:
            want["primary_key", "a,b", ",".join(str(x) for x in (a, b) if x is not None), a is None, b is None] += n
    got = Counter()
    for r in violations(df, SPEC).collect():
        got[r.rule, r.column_name, r.key_text] += r.n_rows
    plain = Counter()
    for k, n in want.items():
        if n:
            plain[k[:3]] += n
    assert got == plain
    with pytest.raises(ConstraintViolation, match="not_null|primary_key|max_length"):
        enforce(df, SPEC)


def test_keys_are_told_apart_by_their_lengths(spark):
    df = spark.createDataFrame([("a", "bc", 0.0), ("ab", "c", -0.0), (None, "n", 1.0), ("n", None, 1.0)], "x string, y string, z double")
    assert violations(df, Constraints(primary_key=["x", "y"])).filter("rule = 'primary_key'").count() == 0
    assert [(r.key_text, r.n_rows) for r in violations(df, Constraints(primary_key=["z"])).filter("rule = 'primary_key'").collect()
            if r.key_text != "1.0"] in ([("0.0", 2)], [("-0.0", 2)])
    assert enforce(df.select("x").filter("x IS NOT NULL"), Constraints(primary_key=["x"], max_length={"x": 9})).count() == 3


def test_sets_with_nulls(spark):
    a = spark.createDataFrame([("x",), (None,), ("x",)], "v string")
    b = spark.createDataFrame([("x",)], "v string")
    same = lambda p, q: same_sets(p, q, "v").first().same
    assert same(a, a) and same(b, b) and not same(a, b) and not same(b, a) and same(a.limit(0), b.limit(0))


def test_what_is_pending_is_kept_as_ranges(spark, tmp_path):
    """Runs with a cap over two partitions: rows by range, not by message, each message loaded once."""
    root, ck = str(tmp_path / "src"), str(tmp_path / "ck")
    t = SC.IngestTargets(table=str(tmp_path / "t"), dlq=str(tmp_path / "d"), state=str(tmp_path / "s"), max_messages=30, in_order=True)

    def land(start, n):
        rows = [(topic, p, start + i, '{"name":"n","address":"a","transaction_id":"x","amount":1}') for topic in "ab" for p in (0, 1)
                for i in range(n)]
        (spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string")
         .withColumn("timestamp", F.lit("2024-01-01T00:00:00")).coalesce(1).write.mode("append").json(root))

    def now():
        landing = spark.read.schema(SC.MESSAGE_SCHEMA).json(root)
        rows = [(r.topic, r.partition, r.offset) for r in SC.read_table(spark, t).collect()]
        left = [(r.topic, r.partition, r.offset) for r in SC.pending_messages(spark, t, ck, landing).collect()]
        assert len(set(rows)) == len(rows) and len(set(left)) == len(left) and not set(rows) & set(left)
        return len(rows), len(left)
    land(0, 50)
    SC.consume(spark, root, t, checkpoint=ck)
    assert now() == (60, 140)
    ranges = spark.read.parquet(t.ranges)
    assert sorted((r.topic, r.partition, r.first, r.last) for r in ranges.collect()) == [
        ("a", 0, 30, 49), ("a", 1, 0, 49), ("b", 0, 30, 49), ("b", 1, 0, 49)]
    land(50, 10)
    for want in ((120, 120), (180, 60), (240, 0), (240, 0)):
        SC.consume(spark, root, t, checkpoint=ck)
        assert now() == want
    assert not os.path.exists(t.pending) and SC.read_table(spark, t).count() == 240
    with pytest.raises(ValueError, match="landed messages"):
        SC.consume_available(SC.message_file_stream(spark, root), t, ck)


def test_merged_ranges(spark):
    rnd = random.Random(6)
    rows = [(rnd.choice("ab"), rnd.randint(0, 1), a, a + rnd.randint(0, 9)) for a in (rnd.randint(0, 120) for _ in range(60))]
    got = SC.merged_ranges(spark.createDataFrame(rows, SC.RANGES)).collect()
    cover = lambda rs: {(t, p, x) for t, p, a, b in rs for x in range(a, b + 1)}
    assert cover(map(tuple, got)) == cover(rows)
    assert len(cover(rows)) == sum(r.last - r.first + 1 for r in got)            # none overlaps another
    assert not any((r.topic, r.partition, r.last + 1) in cover(rows) for r in got)


def test_status_updates_equal_the_full_fold_and_read_the_tail(spark, sf, tmp_path):
    import shutil

    from conflux import fixtures as fx
    from conflux.operators.aggregates import run_status
    from conflux.operators.folding import update_status
    entries = fx.run_log(spark.read.parquet(f"{sf}/events.parquet"))
    log, state, away = str(tmp_path / "log"), str(tmp_path / "state"), tmp_path / "away"
    rows = lambda df: sorted(map(tuple, df.select("job_inst_id", "last_status", "start_time", "end_time", "error_msg", "any_failed",
                                                  "n_entries").collect()), key=str)
    for k in range(3):
        SK.append_run_log(entries.filter(F.col("logging_seq") % 3 == k), log)
        got = rows(update_status(spark, log, state))
        assert got == rows(run_status(entries.filter(F.col("logging_seq") % 3 <= k)
                                            .withColumn("job_inst_id", F.col("job_inst_id").cast("int"))))
        assert rows(update_status(spark, log, state)) == got             # nothing new: nothing changes
    for d, _, names in list(os.walk(log)):                               # what is folded isn't read again
        for n in names:
            if n.startswith("part-"):
                away.mkdir(exist_ok=True)
                shutil.move(os.path.join(d, n), away / n)
    SK.append_run_log(entries.limit(5), log)
    again = update_status(spark, log, state)
    assert again.agg(F.sum("n_entries")).first()[0] == entries.count() + 5
