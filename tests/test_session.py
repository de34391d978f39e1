"""Session helpers: staging root, spread(), and the suggested cluster conf."""

from conflux.session import CLUSTER_CONF, new_path, spread, staging_root


def test_staging_root_reads_the_session(spark):
    root = staging_root(spark)
    assert root and new_path(spark, "x").startswith(root + "/conflux/x-")
    assert new_path(spark, "x") != new_path(spark, "x")


def test_spread_only_when_needed(spark, sf):
    one = spark.read.parquet(f"{sf}/events.parquet")
    assert one.rdd.getNumPartitions() == 1
    assert spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, 1, numPartitions=16)
    assert spread(many) is many


def test_cluster_conf_runs_the_flagship(spark, sf):
    import __spark_entry__ as E
    saved = {k: spark.conf.get(k, None) for k in CLUSTER_CONF}
    try:
        for k, v in CLUSTER_CONF.items():
            spark.conf.set(k, v)
        assert E.queries()["flat_file_load"](spark, sf).count() > 0
        assert E.queries()["task_catalog"](spark, sf).count() > 0
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_what_is_staged_in_a_block_goes_with_it(spark, tmp_path):
    import os

    import pytest
    from conflux.session import new_path, staging
    kept = str(tmp_path / "kept")
    with staging(spark) as outer:
        path = new_path(spark, "a")
        spark.range(3).write.parquet(path)
        with pytest.raises(ValueError), staging(spark) as inner:
            spark.range(2).write.parquet(new_path(spark, "b"))
            assert inner.startswith(outer) and os.path.exists(inner.removeprefix("file:"))
            raise ValueError
        assert not os.path.exists(inner.removeprefix("file:"))
        spark.read.parquet(path).write.parquet(kept)
    assert not os.path.exists(outer.removeprefix("file:")) and "scope-" not in new_path(spark, "c")
    assert spark.read.parquet(kept).count() == 3
