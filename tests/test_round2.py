"""Regression tests for findings on real-world input."""

import pytest
from pyspark.sql import Window, functions as F

from conflux.functions.text import str_padded
from conflux.operators.conform import Constraints, ConstraintViolation, enforce, violations
from conflux.operators.windows import number_rows
from conflux.sinks.tables import replace_with
from conflux.sources.files import read_csv_by_header, read_csv_positional


@pytest.mark.parametrize("aqe", ["true", "false"])
def test_hot_key_numbering_with_other_columns(spark, aqe):
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        df = spark.range(400_000).select((F.col("id") % 3 > 0).cast("int").alias("k"), F.xxhash64("id").alias("o"),
                                         F.concat(F.lit("extra "), "id").alias("extra"), "id")
        got = number_rows(df, ["k"], ["o"], hot_key_rows=1000)
        want = df.withColumn("want", F.row_number().over(Window.partitionBy("k").orderBy("o")).cast("bigint"))
        j = got.join(want.select("id", "want"), "id", "full")
        assert j.where("rn IS NULL OR want IS NULL OR rn <> want").count() == 0 and got.count() == 400_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_quoted_text_is_read_whole(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id,note\n1,"say ""hi"", bob"\n2,"two\nlines"\n3,"C:\\"\n')
    want = [("1", 'say "hi", bob'), ("2", "two\nlines"), ("3", "C:\\")]
    for df in (read_csv_positional(spark, str(tmp_path), ["id", "note"], multi_line=True),
               read_csv_by_header(spark, str(tmp_path), ["id", "note"], multi_line=True)):
        assert sorted(tuple(r) for r in df.collect()) == want


def test_str_rounds_and_never_cuts(spark):
    df = spark.sql("SELECT * FROM VALUES (12345678901D), (-9876543210D), (42.5D), (-1.4D), (NULL) AS t(n)")
    assert [r[0] for r in df.select(str_padded("n")).collect()] == ["*" * 10, "*" * 10, "        43", "        -1", None]


def test_null_key_is_a_violation_and_all_are_kept(spark):
    df = spark.createDataFrame([(None, "a"), (1, "b"), (1, "c"), *[(k, "x" * 9) for k in range(10, 20)]], "k int, v string")
    spec = Constraints(primary_key=["k"], max_length={"v": 3})
    assert {(r.rule, r.column_name) for r in violations(df, spec).collect()} == {
        ("not_null", "k"), ("primary_key", "k"), ("max_length", "v")}
    with pytest.raises(ConstraintViolation) as e:
        enforce(df, spec)
    kept = spark.read.parquet(str(e.value).rsplit("all of them: ", 1)[1])
    assert kept.count() == violations(df, spec).count() == 3


def test_a_failed_promotion_keeps_the_target(spark, tmp_path):
    target = str(tmp_path / "t")
    spark.range(3).write.parquet(target)
    with pytest.raises(OSError):
        replace_with(spark, str(tmp_path / "missing"), target)
    assert spark.read.parquet(target).count() == 3
    spark.range(5).write.parquet(str(tmp_path / "s"))
    replace_with(spark, str(tmp_path / "s"), target)
    assert spark.read.parquet(target).count() == 5 and sorted(p.name for p in tmp_path.iterdir()) == ["t"]
