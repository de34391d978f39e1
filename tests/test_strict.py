"""Bad input is an error or a reject (A5, A7, A8, A9, D7); caps by run."""

import pytest
from pyspark.sql import functions as F

from conflux.operators.joins import flatten_envelope
from conflux.sources.files import read_json_or_reject, read_json_records, split_stageable, stage_delimited
from conflux.sources.responses import landed_pages, parse_envelope, split_documents
from conflux.streaming.consumer import IngestTargets, consume, drain_pending, pending_messages

PAGES = [(1, 1, '{"meta":{"next_cursor":"b"},"results":[{"id":1}]}'),
         (1, 2, '{"meta":{"next_cursor":"c"},"results":[{"id":'),
         (1, 3, '{"meta":{"next_cursor":null},"results":[{"id":3}]}'),
         (2, 1, '{"meta":{"next_cursor":null},"results":[{"id":4}]}'),
         (2, 2, '{"cut')]


def _pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "request_id int, page_num int, body string")


def test_a_malformed_page_within_a_chain_is_an_error(spark):
    with pytest.raises(Exception, match="malformed page 2 of request 1"):
        landed_pages(_pages(spark), "id int", max_pages=9).collect()


def test_a_malformed_page_past_a_chains_end_is_not_read(spark):
    rows = landed_pages(_pages(spark, PAGES[3:]), "id int", max_pages=9).collect()
    assert [r.id for r in rows] == [4]


def test_malformed_pages_skipped_and_rejected(spark):
    rows = landed_pages(_pages(spark), "id int", max_pages=9, skip_malformed=True).collect()
    assert sorted(r.id for r in rows) == [1, 3, 4]
    good, bad = split_documents(_pages(spark), "body", "meta string, results string")
    assert good.count() == 3
    assert sorted((r.request_id, r.page_num) for r in bad.collect()) == [(1, 2), (2, 2)]


def test_envelopes_strict_and_rejected(spark):
    schema = "data array<struct<id:int>>, support struct<url:string>"
    texts = ['{"data":[{"id":1}],"support":{"url":"u"}}', '{"data":[{"id":2}', '{"data":[{"id":"x1"}],"support":{"url":"u"}}',
             "", None]
    df = spark.createDataFrame([(t,) for t in texts], "body string")
    for bad in texts[1:3]:
        one = df.filter(F.col("body") == bad)
        with pytest.raises(Exception):
            flatten_envelope(one, "body", schema).collect()
        with pytest.raises(Exception):
            parse_envelope(one, "body", schema).collect()
    good, rest = split_documents(df, "body", schema)
    assert [tuple(r) for r in flatten_envelope(good, "body", schema).collect()] == [(1, "u")]
    assert {r.body for r in rest.collect()} == set(texts[1:])


def test_cut_json_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id":1},{"id":2}]\n{"id":3}\n{"id":4\n')
    with pytest.raises(Exception):
        read_json_records(spark, str(tmp_path), "id int").collect()
    good, bad = read_json_or_reject(spark, str(tmp_path), "id int")
    assert sorted(r.id for r in good.collect()) == [1, 2, 3]
    assert [r.bad_text for r in bad.collect()] == ['{"id":4'] and bad.count() == 1


def test_unstageable_text(spark, tmp_path):
    df = spark.createDataFrame([(1, "5 € œ é"), (2, "日本"), (3, "a\nb"), (4, None)], "id int, t string")
    for k in (2, 3):
        with pytest.raises(Exception, match="can't be staged"):
            stage_delimited(df.filter(F.col("id") == k), str(tmp_path / f"s{k}"))
    fit, rest = split_stageable(df)
    assert [sorted(r.id for r in x.collect()) for x in (fit, rest)] == [[1, 4], [2, 3]]
    assert sorted(r.id for r in split_stageable(df, multi_line=True)[0].collect()) == [1, 3, 4]


def _land(spark, root, n, start=0):
    rows = [("t", 0, start + i, '{"name":"n","address":"a","transaction_id":"%d","amount":1}' % (start + i))
            for i in range(n)]
    (spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string")
     .withColumn("timestamp", F.lit("2024-01-01T00:00:00")).coalesce(1).write.mode("append").json(root))


def test_a_capped_run_leaves_the_rest_to_later_runs(spark, tmp_path):
    root, ck = str(tmp_path / "src"), str(tmp_path / "ck")
    t = IngestTargets(table=str(tmp_path / "t"), dlq=str(tmp_path / "d"), state=str(tmp_path / "s"), max_messages=10)

    def now():
        rows = [r.offset for p in (t.table, t.dlq) for r in spark.read.parquet(p).select("offset").collect()]
        left = [r.offset for r in pending_messages(spark, t, ck).collect()]
        return sorted(rows), sorted(left)

    _land(spark, root, 25)
    consume(spark, root, t, checkpoint=ck)
    assert now() == (list(range(10)), list(range(10, 25)))
    _land(spark, root, 5, 25)
    consume(spark, root, t, checkpoint=ck)
    assert now() == (list(range(20)), list(range(20, 30)))
    consume(spark, root, t, checkpoint=ck)
    assert now() == (list(range(30)), [])
    drain_pending(spark, t, ck)          # nothing left: nothing happens
    assert now() == (list(range(30)), [])


def test_each_capped_replay_takes_the_cap(spark, tmp_path):
    root = str(tmp_path / "src")
    t = IngestTargets(table=str(tmp_path / "t"), dlq=str(tmp_path / "d"), state=str(tmp_path / "s"), max_messages=10)
    _land(spark, root, 25)
    for _ in range(2):
        consume(spark, root, t, replay=True)
    assert spark.read.parquet(t.table).count() + spark.read.parquet(t.dlq).count() == 20


def test_a_capped_checkpointed_run_needs_a_state(spark, tmp_path):
    t = IngestTargets(table=str(tmp_path / "t"), dlq=str(tmp_path / "d"), max_messages=10)
    _land(spark, str(tmp_path / "src"), 1)
    with pytest.raises(ValueError):
        consume(spark, str(tmp_path / "src"), t, checkpoint=str(tmp_path / "ck"))
