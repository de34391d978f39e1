"""Small operators: generator, publish, role joins, scalar subquery, sets, steps, limits."""

import json

from pyspark.sql import functions as F

from conflux.operators.aggregates import bounded, first_row, same_sets, step_rows
from conflux.operators.joins import flatten_envelope, with_scalar, with_table_roles
from conflux.sinks.tables import publish
from conflux.sources.messages import generate_messages


def test_generator_is_reproducible_and_bounded(spark):
    ids = spark.range(300).withColumnRenamed("id", "i")
    a = generate_messages(ids, "i", n_topics=3)
    b = generate_messages(ids, "i", n_topics=3)
    assert sorted(map(tuple, a.select("topic", "offset", "value").collect())) == \
        sorted(map(tuple, b.select("topic", "offset", "value").collect()))
    counts = {r.topic: r["count"] for r in a.groupBy("topic").count().collect()}
    assert counts == {"topic1": 300, "topic2": 300, "topic3": 300}
    recs = [json.loads(r.value) for r in a.collect()]
    assert all(0 <= r["amount"] <= 99999 and r["name"].startswith("name-") for r in recs)
    assert len({r["transaction_id"] for r in recs}) == len(recs)


def test_publish_fans_out_by_topic(spark):
    df = spark.createDataFrame([("t1", "a", "x", "1", 5), ("t2", "b", "y", "2", 6)],
                               "topic string, name string, address string, transaction_id string, amount long")
    out = {r.topic: json.loads(r.value) for r in publish(df).collect()}
    assert out["t2"] == {"name": "b", "address": "y", "transaction_id": "2", "amount": 6}


def test_roles_and_scalar(spark):
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "k int, label string")
    fact = spark.createDataFrame([(10, 1, 2), (11, 2, None)], "id int, a int, b int")
    r = {x.id: (x.src_label, x.dst_label) for x in
         with_table_roles(fact, dim, "k", {"src": "a", "dst": "b"}, ["label"], bounded=True).collect()}
    assert r == {10: ("one", "two"), 11: ("two", None)}
    s = with_scalar(fact, fact.select(F.max("id")), "max_id").collect()
    assert {x.max_id for x in s} == {11}


def test_sets_steps_and_limits(spark):
    a = spark.createDataFrame([("t1",), ("t2",)], "topic string")
    b = spark.createDataFrame([("t1",)], "topic string")
    assert same_sets(a, a, "topic").first().same is True
    assert same_sets(a, b, "topic").first().same is False
    jobs = spark.createDataFrame([(1, "E"), (2, "TL"), (3, "ETL"), (4, "EL")], "job int, etl_steps string")
    got = sorted((r.job, r.etl_step) for r in step_rows(jobs).collect())
    assert got == [(1, "E"), (2, "L"), (2, "T"), (3, "E"), (3, "L"), (3, "T")]
    df = spark.range(100)
    assert first_row(df, [F.desc("id")]).first().id == 99
    assert [r.id for r in bounded(df, 3, ["id"]).collect()] == [0, 1, 2]


def test_envelope_object_data_and_absent_sides(spark):
    docs = spark.createDataFrame([('{"data":{"id":2,"name":"j"},"support":{"url":"u","text":"t"}}',),
                                  ('{"data":{"id":3,"name":"k"}}',),
                                  ('{"support":{"url":"u","text":"t"}}',)], "body string")
    schema = "data struct<id:int,name:string>, support struct<url:string,text:string>"
    rows = [tuple(r) for r in flatten_envelope(docs, "body", schema).collect()]
    assert rows == [(2, "j", "u", "t")]


def test_parse_envelope(spark):
    from conflux.sources.responses import parse_envelope
    df = spark.createDataFrame([('{"page":2,"per_page":6,"data":[{"id":7}]}',)], "body string")
    doc = parse_envelope(df, "body", "page int, per_page int, data array<struct<id:int>>").first().doc
    assert (doc.page, doc.per_page, doc.data[0].id) == (2, 6, 7)
