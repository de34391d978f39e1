"""Numbering, caps and page chains, including the hot-key paths."""

from pyspark.sql import Window, functions as F

from conflux.operators.windows import cap_rows, number_rows, page_chain


def _skewed(spark, n=3000):
    # key 0 holds about a third of all rows
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"),
                                 (F.col("id") * 7 % 1000).alias("o"), F.col("id"))


def _reference(df, n=None):
    w = Window.partitionBy("k").orderBy("o", "id")
    out = df.withColumn("rn", F.row_number().over(w))
    return out.filter(F.col("rn") <= n).drop("rn") if n else out


def test_number_rows_hot_path_equals_window(spark):
    df = _skewed(spark)
    exp = sorted(map(tuple, _reference(df).select("k", "id", "rn").collect()))
    for hot in (2, 10**9):      # everything hot / nothing hot
        for buckets in ([F.floor(F.col("o") / 100)], None):     # bucketed / ranged hot path
            got = number_rows(df, ["k"], ["o", "id"], buckets, "rn", hot_key_rows=hot)
            assert sorted(map(tuple, got.select("k", "id", "rn").collect())) == exp


def test_cap_rows_equals_window_limit(spark):
    df = _skewed(spark)
    for n in (1, 37, 500, 5000):
        got = cap_rows(df, ["k"], ["o", "id"], [F.floor(F.col("o") / 64)], n)
        assert sorted(r.id for r in got.collect()) == sorted(r.id for r in _reference(df, n).collect())


def test_cap_rows_with_prior(spark):
    df = _skewed(spark)
    prior = spark.createDataFrame([(0, 990)], "k long, _prior long")
    got = cap_rows(df, ["k"], ["o", "id"], [F.floor(F.col("o") / 64)], 1000, prior=prior)
    assert got.filter("k = 0").count() == 10


def test_page_chain_stops_after_first_empty_cursor(spark):
    rows = [(1, 1, "a"), (1, 2, ""), (1, 3, "c"), (2, 1, "a"), (2, 2, "b"), (2, 3, "c"), (3, 1, None)]
    df = spark.createDataFrame(rows, "request_id int, page_num int, next_cursor string")
    got = sorted(tuple(r)[:2] for r in page_chain(df, max_pages=2).collect())
    assert got == [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1)]


def test_number_tasks_hot_key_with_few_leading_values(spark):
    from conflux.operators.windows import number_tasks
    # one key, leading order column with 3 values: the second column splits it
    df = spark.range(5000).select(F.lit(1).alias("k"), (F.col("id") % 3).alias("step_seq"),
                                  (F.col("id") * 7919 % 5000).alias("task_id"))
    got = number_tasks(df, ["k"], ["step_seq", "task_id"], hot_key_rows=10)
    w = Window.partitionBy("k").orderBy("step_seq", "task_id")
    exp = df.withColumn("task_thread_num", F.row_number().over(w))
    assert sorted(map(tuple, got.select("task_id", "task_thread_num").collect())) == \
        sorted(map(tuple, exp.select("task_id", "task_thread_num").collect()))
    assert got.agg(F.max("sequence_num")).first()[0] == 5000 * 20


def test_null_keys_and_buckets_are_kept(spark):
    rows = [(None, 1, 1), (None, 2, 2), ("a", None, 3), ("a", 5, 4), ("a", None, 5)]
    df = spark.createDataFrame(rows, "k string, o int, id int")
    w = Window.partitionBy("k").orderBy("o", "id")
    exp = sorted(map(tuple, df.withColumn("rn", F.row_number().over(w)).select("id", "rn").collect()))
    for buckets in ([F.col("o")], None):
        got = number_rows(df, ["k"], ["o", "id"], buckets, "rn", hot_key_rows=0)
        assert sorted(map(tuple, got.select("id", "rn").collect())) == exp
    capped = cap_rows(df, ["k"], ["o", "id"], [F.col("o")], 2)
    assert sorted(r.id for r in capped.collect()) == [1, 2, 3, 5]
