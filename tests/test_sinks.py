"""B3, B4, B7, B11 and the JDBC reader options (no database is started)."""

import os

from pyspark.sql import functions as F

from conflux.operators.conform import Constraints
from conflux.sinks.tables import (archive_source_files, load_with_rowcount, path_exists, staged_insert,
                                  truncate_and_load)
from conflux.sources.relational import JdbcSource, incremental


def test_rowcount_and_reload(spark, tmp_path):
    df = spark.range(123)
    p = str(tmp_path / "t")
    assert load_with_rowcount(df, p) == 123
    truncate_and_load(df, p)
    assert spark.read.parquet(p).count() == 123


def test_staged_insert_drops_stage(spark, tmp_path):
    stage, target = str(tmp_path / "stage"), str(tmp_path / "target")
    n = staged_insert(spark, spark.range(10), target, 1, Constraints(primary_key=["id"]),
                      drop_stage=True, stage_path=stage)
    assert n == 10 and spark.read.parquet(target).count() == 10
    assert not path_exists(spark, stage)


def test_archive_source_files(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for name in ("a.csv", "b.csv"):
        (src / name).write_text("x\n")
    import datetime as dt
    moved = archive_source_files(spark, [f"file://{src}/a.csv"], failed=False, when=dt.datetime(2025, 4, 30, 14, 35, 22))
    moved += archive_source_files(spark, [f"file://{src}/b.csv"], failed=True, when=dt.datetime(2025, 4, 30, 14, 35, 22))
    assert sorted(os.listdir(src / "processed")) == ["a_20250430_143522.csv"]
    assert sorted(os.listdir(src / "error")) == ["err_b_20250430_143522.csv"]
    assert not (src / "a.csv").exists()


def test_jdbc_reader_options_and_incremental_pushdown(spark, sf):
    src = JdbcSource(url="jdbc:example://host/db", query="SELECT * FROM t", partition_column="id",
                     lower_bound=0, upper_bound=100, num_partitions=4)
    assert src.num_partitions == 4
    df = spark.read.parquet(f"{sf}/orders.parquet")
    import datetime as dt
    out = incremental(df, "o_orderdate", dt.datetime(2000, 1, 1), is_full_load=False)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "o_orderdate" in plan
    assert incremental(df, "o_orderdate", None, is_full_load=True) is df


def test_flagship_load_keeps_target_on_violation(spark, tmp_path):
    import datetime as dt

    import pytest
    from pyspark.sql import types as T

    from conflux.operators.conform import ConstraintViolation
    from conflux.plans.flatfile import load_flat_file

    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
    good, bad, target = tmp_path / "good", tmp_path / "bad", str(tmp_path / "target")
    good.mkdir(), bad.mkdir()
    (good / "a.csv").write_text("name,id\nx,1\ny,2\n")
    (bad / "a.csv").write_text("id,name\n1,x\n1,y\n")
    spec = Constraints(primary_key=["id"])
    res = load_flat_file(spark, str(good), schema, target, 7, dt.datetime(2024, 1, 1), spec)
    assert res.rows == 2
    with pytest.raises(ConstraintViolation):
        load_flat_file(spark, str(bad), schema, target, 8, dt.datetime(2024, 1, 1), spec)
    rows = sorted((r.id, r.name, r.job_inst_id) for r in spark.read.parquet(target).collect())
    assert rows == [(1, "x", 7), (2, "y", 7)]


def test_staged_insert_is_positional(spark, tmp_path):
    target = str(tmp_path / "target")
    staged_insert(spark, spark.createDataFrame([(1, "a")], "id int, name string"), target, 1)
    staged_insert(spark, spark.createDataFrame([(2, "b")], "k long, label string"), target, 2)
    rows = sorted(tuple(r) for r in spark.read.parquet(target).collect())
    assert rows == [(1, "a"), (2, "b")]
    assert spark.read.parquet(target).columns == ["id", "name"]


def test_archive_json_is_idempotent_per_run(spark, tmp_path):
    from conflux.sinks.tables import archive_json
    root = str(tmp_path / "arch")
    archive_json(spark.range(3), root, 1, "2024_01_01")
    archive_json(spark.range(3), root, 1, "2024_01_01")      # retry of the same run
    archive_json(spark.range(2), root, 2, "2024_01_01")
    counts = {r.job_inst_id: r["count"] for r in spark.read.json(root).groupBy("job_inst_id").count().collect()}
    assert counts == {1: 3, 2: 2}


def test_flagship_load_archives_inputs(spark, tmp_path):
    import datetime as dt

    import pytest
    from pyspark.sql import types as T

    from conflux.plans.flatfile import load_flat_file

    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
    good, bad = tmp_path / "good", tmp_path / "bad"
    good.mkdir(), bad.mkdir()
    (good / "city.csv").write_text("id,name\n1,x\n")
    (bad / "city.csv").write_text("id,name\nnot-a-number,y\n")
    load_flat_file(spark, str(good / "city.csv"), schema, str(tmp_path / "t1"), 1, dt.datetime(2024, 1, 1),
                   archive_files=True)
    assert not (good / "city.csv").exists()
    assert [p.name.startswith("city_") and p.suffix == ".csv" for p in (good / "processed").iterdir()] == [True]
    with pytest.raises(Exception):
        load_flat_file(spark, str(bad / "city.csv"), schema, str(tmp_path / "t2"), 2, dt.datetime(2024, 1, 1),
                       archive_files=True)
    assert [p.name.startswith("err_city_") for p in (bad / "error").iterdir()] == [True]


def test_append_is_idempotent_per_run(spark, tmp_path):
    from conflux.sinks.tables import append_load
    p = str(tmp_path / "t")
    a = spark.range(5).withColumn("job_inst_id", F.lit(1))
    b = spark.range(3).withColumn("job_inst_id", F.lit(2))
    append_load(a, p, run_column="job_inst_id")
    append_load(b, p, run_column="job_inst_id")
    append_load(b, p, run_column="job_inst_id")          # the same run again
    counts = {r.job_inst_id: r["count"] for r in spark.read.parquet(p).groupBy("job_inst_id").count().collect()}
    assert counts == {1: 5, 2: 3}


def test_flagship_reject_mode_sets_bad_rows_aside(spark, tmp_path):
    import datetime as dt

    from pyspark.sql import types as T

    from conflux.plans.flatfile import load_flat_file

    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("amt", T.DoubleType())])
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text("id,amt\n1,1.5\n2,n/a\nx,3\n4,\n")
    res = load_flat_file(spark, str(src), schema, str(tmp_path / "t"), 7, dt.datetime(2024, 1, 1),
                         reject_path=str(tmp_path / "rej"))
    assert (res.rows, res.rejected) == (2, 2)
    t = spark.read.parquet(str(tmp_path / "t"))
    assert t.columns == ["id", "amt", "job_inst_id", "date_created"]
    assert sorted((r.id, r.amt) for r in t.collect()) == [(1, 1.5), (4, None)]
    rej = sorted(r.route for r in spark.read.parquet(str(tmp_path / "rej")).collect())
    assert rej == ["bad double: amt", "bad int: id"]


def test_failed_reload_keeps_the_previous_target(spark, tmp_path):
    import pytest
    p = str(tmp_path / "t")
    truncate_and_load(spark.range(3), p)
    bad = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("boom"))).otherwise(F.col("id"))
                                .alias("id"))
    with pytest.raises(Exception):
        truncate_and_load(bad, p)
    assert spark.read.parquet(p).count() == 3
    truncate_and_load(spark.range(7), p)
    assert spark.read.parquet(p).count() == 7
