"""Scalar functions: I1, I8, I10, I11, I14."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conflux.functions.jsonpath import json_value_or_default, nested_path
from conflux.functions.text import archive_file_name, comma_list, split_table_name, step_flags
from conflux.functions.timefmt import log_order, to_smalldatetime


def test_split_table_name(spark):
    df = spark.createDataFrame([("t",), ("s.t",), ("d.s.t",)], "n string")
    got = [tuple(r.p) for r in df.select(split_table_name("n").alias("p")).collect()]
    assert got == [("dbo", "t"), ("s", "t"), ("s", "t")]
    with pytest.raises(Exception):
        spark.createDataFrame([("a.b.c.d",)], "n string").select(split_table_name("n")).collect()


def test_archive_file_name(spark):
    df = spark.createDataFrame([("/in/city.csv", False), ("/in/city.tar.gz", True), ("/in/README", False),
                                ("/in/.env", False)], "p string, f boolean")
    got = [r[0] for r in df.select(archive_file_name("p", F.lit("20250430_143522"), F.col("f"))).collect()]
    assert got == ["city_20250430_143522.csv", "err_city.tar_20250430_143522.gz",
                   "README_20250430_143522", ".env_20250430_143522"]


def test_smalldatetime_rounding(spark):
    base = dt.datetime(2024, 1, 1, 10, 0, 0)
    secs = [29.998, 29.999, 30.0, 59.9]
    df = spark.createDataFrame([(base + dt.timedelta(seconds=s),) for s in secs], "ts timestamp_ntz")
    got = [r[0] for r in df.select(to_smalldatetime("ts")).collect()]
    assert got == [base, base.replace(minute=1), base.replace(minute=1), base.replace(minute=1)]


def test_json_default_and_path(spark):
    df = spark.createDataFrame([('{"pattern":"test-.*"}',), ("{}",), (None,)], "s string")
    got = [r[0] for r in df.select(json_value_or_default("s", "pattern")).collect()]
    assert got == ["test-.*", "Key not found", None]
    df2 = spark.createDataFrame([('{"a":{"b":1}}',), ('{"a":[{"b":1}]}',), ('{"a":null}',)], "s string")
    assert [r[0] for r in df2.select(nested_path("s", "a.b")).collect()] == ["1", None, None]


def test_flags_lists_and_log_order(spark):
    df = spark.createDataFrame([("etl", "e", 3), ("TL", "x", 4)], "s string, step string, seq int")
    r = df.select(step_flags("s").alias("f"), comma_list(F.lit(" a, b ,c")).alias("l"),
                  log_order("step", "seq").alias("o")).collect()
    assert tuple(r[0].f) == (1, 1, 1) and tuple(r[1].f) == (0, 1, 1)
    assert r[0].l == ["a", "b", "c"]
    assert [x.o for x in r] == [123, 4]


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab.", min_size=1, max_size=6), min_size=1, max_size=8))
def test_archive_name_matches_splitext(spark, names):
    import os.path
    rows = [(f"/in/{n}", i % 2 == 0) for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "p string, f boolean")
    got = [r[0] for r in df.select(archive_file_name("p", F.lit("S"), F.col("f"))).collect()]
    exp = []
    for p, f in rows:
        name, ext = os.path.splitext(os.path.basename(p))
        exp.append(f"{'err_' if f else ''}{name}_S{ext}")
    assert got == exp


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet=" \t\nab, ", max_size=8), min_size=1, max_size=6))
def test_comma_list_and_case_match_python(spark, texts):
    from conflux.functions.text import normalize_lower
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = df.select(comma_list("s").alias("l"), normalize_lower("s").alias("n")).collect()
    assert [r.l for r in got] == [[x.strip() for x in t.split(",")] for t in texts]
    assert [r.n for r in got] == [t.strip().lower() for t in texts]
