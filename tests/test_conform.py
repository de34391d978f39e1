"""Conforming text to types and target constraints."""

import pytest
from pyspark.sql import types as T

from conflux.operators.conform import Constraints, ConstraintViolation, conform, enforce, split_rejects, violations

TARGET = T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("amt", T.DoubleType()),
                       T.StructField("name", T.StringType())])


def test_strict_casts_and_blank_is_null(spark):
    df = spark.createDataFrame([("1", "2.5", "a"), ("2", "", ""), ("3", " ", " ")],
                               "id string, amt string, name string")
    rows = conform(df, TARGET).orderBy("id").collect()
    assert rows[0] == (1, 2.5, "a")
    assert rows[1].amt is None and rows[1].name is None
    assert rows[2].amt is None and rows[2].name == " "


def test_strict_fails_the_load(spark):
    df = spark.createDataFrame([("x", "1", "a")], "id string, amt string, name string")
    with pytest.raises(Exception):
        conform(df, TARGET).collect()


def test_reject_mode_splits(spark):
    df = spark.createDataFrame([("1", "1.0", "a"), ("2", "n/a", "b")], "id string, amt string, name string")
    good, bad = split_rejects(conform(df, TARGET, "reject"))
    assert [r.id for r in good.collect()] == [1]
    assert bad.first().reject_reason == "bad double: amt"


def test_violations_and_enforce(spark):
    df = spark.createDataFrame([(1, "abc"), (1, "abcdefgh"), (None, "x")], "id int, name string")
    spec = Constraints(not_null=["id"], primary_key=["id"], max_length={"name": 5})
    v = {(r.rule, r.key_text): r.n_rows for r in violations(df, spec).collect()}
    assert v == {("not_null", None): 1, ("primary_key", "1"): 2, ("max_length", "abcdefgh"): 1}
    with pytest.raises(ConstraintViolation):
        enforce(df, spec)
    ok = spark.createDataFrame([(1, "a")], "id int, name string")
    assert enforce(ok, spec).count() == 1
