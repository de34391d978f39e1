"""Task catalog over metadata tables (D2, D3, D4, D5, F1, U1) on inline rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conflux.operators.joins import active_tasks, with_parent
from conflux.operators.project import either_key
from conflux.plans import procs
from conflux.plans.ingest import job_tasks


def test_job_tasks_catalog(spark):
    jit = spark.createDataFrame(
        [(1, 10, 100, "E", 2), (2, 10, 101, "E", 1), (3, 10, 102, "T", 1), (4, 11, 100, "E", 1)],
        "job_inst_task_id int, job_inst_id int, job_task_id int, etl_step string, step_seq int")
    jt = spark.createDataFrame(
        [(100, 1, "load a", "E", 1, 1, 1, 2, 7), (101, 1, "load b", "E", 1, 1, 2, 2, 8),
         (102, 1, "transform", "T", 1, 1, 2, 3, None)],
        "job_task_id int, job_id int, job_task_name string, etl_step string, step_seq int, is_active int, "
        "src_tbl_id int, tgt_tbl_id int, conn_str_id int")
    tbl = spark.createDataFrame([(1, "raw.a", None, None), (2, "raw.b", dt.datetime(2024, 1, 1), "ts"),
                                 (3, "dbo.b", None, None)],
                                "tbl_id int, fully_qualified_tbl_name string, incr_date timestamp_ntz, "
                                "incr_column string")
    conn = spark.createDataFrame([(7, "src a"), (8, "src b")], "conn_str_id int, conn_str_name string")
    rows = job_tasks(jit, jt, tbl, conn, job_inst_id=10, etl_step="E").orderBy("task_thread_num").collect()
    assert [(r.job_task_name, r.task_thread_num, r.sequence_num) for r in rows] == [("load b", 1, 20),
                                                                                     ("load a", 2, 40)]
    assert rows[0].src_fully_qualified_tbl_name == "raw.b" and rows[0].tgt_fully_qualified_tbl_name == "raw.b"
    assert rows[0].conn_str_name == "src b" and rows[1].src_incr_column is None
    one = job_tasks(jit, jt, tbl, conn, job_inst_id=10, etl_step="E", task_id=100).collect()
    assert [r.job_task_id for r in one] == [100]


def test_active_tasks_and_bypass(spark):
    tasks = spark.createDataFrame([(1, "E"), (2, "T"), (3, "L")], "id int, etl_step string")
    steps = spark.createDataFrame([("E",), ("L",)], "etl_step string")
    assert sorted(r.id for r in active_tasks(tasks, steps, "etl_step").collect()) == [1, 3]
    assert active_tasks(tasks, steps, "etl_step", bypass=True).count() == 3


def test_parent_connection_and_either_key(spark):
    conn = spark.createDataFrame([(1, None, "http://a", "u1"), (2, 1, "/child", "u2")],
                                 "conn_api_id int, parent_conn_api_id int, api_url string, username string")
    out = {r.conn_api_id: r.parent_api_url for r in
           with_parent(conn, "conn_api_id", "parent_conn_api_id", ["api_url", "username"]).collect()}
    assert out == {1: None, 2: "http://a"}
    t = spark.createDataFrame([(1, 1, 5), (1, 2, 6), (2, 1, 7)], "run int, seq int, task int")
    assert sorted(r.task for r in either_key(t, ("run", 1), ("seq", 2), ("task", 7)).collect()) == [6, 7]


def test_run_sql_parameters(spark, sf):
    spark.read.parquet(f"{sf}/orders.parquet").createOrReplaceTempView("orders_t")
    procs.register("count_since", "SELECT count(*) AS n FROM IDENTIFIER(:tbl) WHERE o_orderdate >= :since")
    n = procs.run_sql(spark, "count_since", tbl="orders_t", since=dt.datetime(2000, 1, 1)).first().n
    exp = spark.read.parquet(f"{sf}/orders.parquet").filter(F.col("o_orderdate") >= dt.datetime(2000, 1, 1)).count()
    assert n == exp
    procs.register("fn", lambda spark, k: spark.range(k))
    assert procs.run_sql(spark, "fn", k=3).count() == 3


def test_run_step_logs_and_folds(spark, sf, tmp_path):
    from conflux.operators.conform import Constraints
    from conflux.plans.ingest import run_step
    good = {"job_task_name": "orders", "etl_step": "E", "step_seq": 1, "conn_type": "parquet",
            "file_path": f"{sf}/orders.parquet", "is_full_load": True, "target_path": str(tmp_path / "o")}
    bad = {"job_task_name": "lineitem", "etl_step": "E", "step_seq": 2, "conn_type": "parquet",
           "file_path": f"{sf}/lineitem.parquet", "is_full_load": True, "target_path": str(tmp_path / "l"),
           "constraints": Constraints(primary_key=["l_orderkey"])}
    st = run_step(spark, [bad, good], 5, str(tmp_path / "log"), dt.datetime(2024, 1, 1)).first()
    assert st.any_failed and st.n_entries == 4
    assert "primary_key" in st.error_msg
    assert spark.read.parquet(str(tmp_path / "o")).count() == spark.read.parquet(f"{sf}/orders.parquet").count()
    msgs = [r.error_msg for r in spark.read.parquet(str(tmp_path / "log")).filter("task_status = 'succeeded'").collect()]
    assert msgs and msgs[0].startswith("inserted rows || ")


def test_full_task_catalog(spark):
    from conflux.plans.ingest import Metadata, task_catalog_for

    df = spark.createDataFrame
    md = Metadata(
        job_inst_task=df([(1, 9, 100, "not started"), (2, 9, 101, "not started"), (3, 9, 102, "not started"),
                          (4, 9, 103, "not started"), (5, 8, 100, "done")],
                         "job_inst_task_id int, job_inst_id int, job_task_id int, task_status string"),
        job_task=df([(100, 1, "db extract", "E", 2, "db", 1, 2, 1, None, None, 1),
                     (101, 1, "api extract", "E", 1, "api", None, 3, None, 2, None, None),
                     (102, 1, "consume", "E", 3, "kafka", None, 4, None, None, 1, None),
                     (103, 1, "transform", "T", 1, "db", 2, 3, 2, None, None, 2)],
                    "job_task_id int, job_id int, job_task_name string, etl_step string, step_seq int, "
                    "conn_type string, src_tbl_id int, tgt_tbl_id int, conn_str_id int, conn_api_id int, "
                    "conn_kafka_id int, sql_script_id int"),
        job_inst=df([(9, 1, "ETL", True, False), (8, 1, "E", True, False)],
                    "job_inst_id int, job_id int, etl_steps string, is_full_load boolean, del_temp_data boolean"),
        job=df([(1, "etl")], "job_id int, job_type string"),
        tbl=df([(1, "src.dbo.orders", dt.datetime(2024, 5, 1), "o_orderdate", "large"),
                (2, "raw.orders", None, "o_orderdate", "small"), (3, "raw.api", None, None, None),
                (4, "raw.kafka_topic", None, None, None)],
               "tbl_id int, fully_qualified_tbl_name string, incr_date timestamp_ntz, incr_column string, "
               "data_size string"),
        conn_str=df([(1, "src", "mssql+pyodbc://host/db", "u", "p", None),
                     (2, "dwh", "postgresql://host/dwh", "u", "p", None)],
                    "conn_str_id int, conn_str_name string, conn_str string, username string, pass string, "
                    "file_path string"),
        conn_api=df([(1, None, 1, "login", "https://api/login", "lu", "lp", False, None, None, None, None, None,
                      None, None, None),
                     (2, 1, 1, "works", "https://api/works", None, None, True, "{}", "page", 100, "cursor",
                      "meta.next_cursor", 2, "/out", 100)],
                    "conn_api_id int, parent_conn_api_id int, data_source_id int, conn_api_name string, "
                    "api_url string, username string, pass string, need_token boolean, payload_json string, "
                    "page_param_name string, page_size int, cursor_param_name string, cursor_path string, "
                    "max_pages int, output_file_path string, chunk_size int"),
        conn_kafka=df([(1, "test-topic1", '{"pattern": "test-.*"}', "kafka:9092", "etl-group", True, 100, 500)],
                      "conn_kafka_id int, topic string, topic_pattern string, bootstrap_servers string, "
                      "group_id string, is_consumer boolean, batch_record_size int, max_message_num int"),
        sql_script=df([(1, "SELECT * FROM orders", False), (2, "dbo.load_orders", True)],
                      "sql_script_id int, sql_text string, is_stored_proc boolean"),
        data_source=df([(1, "scholarly api")], "data_source_id int, data_source_name string"))
    rows = task_catalog_for(md, 9, "E", run_ts=dt.datetime(2024, 6, 2)).orderBy("task_thread_num").collect()
    assert [r.job_task_name for r in rows] == ["api extract", "db extract", "consume"]
    assert [r.sequence_num for r in rows] == [20, 40, 60]
    api, db, kafka = rows
    assert (api.conn_str_name, api.conn_str, api.api_key_url, api.api_key_username) == \
        ("works", "https://api/works", "https://api/login", "lu")
    assert api.db_type is None and api.data_source_name == "scholarly api" and api.sql_type is None
    assert (db.conn_str_name, db.db_type, db.sql_type) == ("src", "MSSQL", "raw-sql")
    assert db.src_incr_date == dt.datetime(2024, 5, 1) and db.src_data_size == "large"
    assert api.src_incr_date == dt.datetime(2024, 6, 1)          # run date - 1 day
    assert kafka.kafka_topic_pattern == '{"pattern": "test-.*"}' and kafka.max_message_num == 500
    assert all(r.etl_steps == "ETL" and r.job_type == "etl" for r in rows)
    one = task_catalog_for(md, 9, "E", job_inst_task_id=1).collect()
    assert [r.job_task_name for r in one] == ["db extract"]
    t = task_catalog_for(md, 9, "T").first()
    assert (t.db_type, t.sql_type) == ("POSTGRES", "proc")


def test_ingest_api_task_from_landed_pages(spark, sf, tmp_path):
    from conflux import fixtures as fx
    from conflux.plans.ingest import ingest
    from conflux.sources.relational import topic_pattern
    landed = str(tmp_path / "landed")
    fx.response_pages(spark.read.parquet(f"{sf}/pages.parquet")).write.json(landed)
    df, _ = ingest(spark, {"conn_type": "api", "output_file_path": landed, "max_pages": 2,
                           "result_schema": "id bigint, title string", "is_full_load": True})
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    # page 1 of every request, page 2 unless page 1 ended the chain (page_id % 7 == 6)
    exp = pages.filter((F.col("page_id") % 10 == 0) |
                       ((F.col("page_id") % 10 == 1) & ((F.col("page_id") - 1) % 7 != 6))).count()
    assert df.count() == exp and df.columns == ["request_id", "page_num", "id", "title"]
    assert topic_pattern('{"pattern": "test-.*"}') == "test-.*"
    assert topic_pattern("{}") == "Key not found" and topic_pattern(None) is None


def test_proc_task_runs_registered_transform(spark, sf, tmp_path):
    from conflux.plans.ingest import ingest
    spark.read.parquet(f"{sf}/orders.parquet").createOrReplaceTempView("raw_orders")
    procs.register("dbo.load_orders", "SELECT o_orderkey, o_orderstatus, :p_job_inst_id AS job_inst_id "
                                      "FROM raw_orders WHERE o_orderstatus = 'F'")
    procs.register("dbo.count_orders", lambda spark: spark.sql("SELECT count(*) AS n FROM raw_orders"))
    df, n = ingest(spark, {"conn_type": "db", "sql_type": "proc", "sql_text": "dbo.load_orders",
                           "job_inst_id": 3, "job_inst_task_id": 9}, str(tmp_path / "t"))
    exp = spark.read.parquet(f"{sf}/orders.parquet").filter("o_orderstatus = 'F'").count()
    assert n == exp and df.filter("job_inst_id = 3").count() == exp
    one, _ = ingest(spark, {"conn_type": "db", "sql_type": "proc", "sql_text": "dbo.count_orders"})
    assert one.first().n == spark.read.parquet(f"{sf}/orders.parquet").count()


def test_run_step_from_catalog_rows(spark, sf, tmp_path):
    from conflux.plans.ingest import Metadata, run_step, task_catalog_for, tasks_from_catalog

    df = spark.createDataFrame
    md = Metadata(
        job_inst_task=df([(1, 9, 100, "not started")], "job_inst_task_id int, job_inst_id int, job_task_id int, "
                                                       "task_status string"),
        job_task=df([(100, 1, "orders to raw", "E", 1, "parquet", None, 2, 1, None, None, None)],
                    "job_task_id int, job_id int, job_task_name string, etl_step string, step_seq int, "
                    "conn_type string, src_tbl_id int, tgt_tbl_id int, conn_str_id int, conn_api_id int, "
                    "conn_kafka_id int, sql_script_id int"),
        job_inst=df([(9, 1, "E", True, False)], "job_inst_id int, job_id int, etl_steps string, "
                                                "is_full_load boolean, del_temp_data boolean"),
        job=df([(1, "etl")], "job_id int, job_type string"),
        tbl=df([(2, "raw.orders", None, None, None)], "tbl_id int, fully_qualified_tbl_name string, "
                                                      "incr_date timestamp_ntz, incr_column string, data_size string"),
        conn_str=df([(1, "landing", None, None, None, f"{sf}/orders.parquet")],
                    "conn_str_id int, conn_str_name string, conn_str string, username string, pass string, "
                    "file_path string"),
        conn_api=df([], "conn_api_id int, parent_conn_api_id int, data_source_id int, conn_api_name string, "
                        "api_url string, username string, pass string, need_token boolean, payload_json string, "
                        "page_param_name string, page_size int, cursor_param_name string, cursor_path string, "
                        "max_pages int, output_file_path string, chunk_size int"),
        conn_kafka=df([], "conn_kafka_id int, topic string, topic_pattern string, bootstrap_servers string, "
                          "group_id string, is_consumer boolean, batch_record_size int, max_message_num int"),
        sql_script=df([], "sql_script_id int, sql_text string, is_stored_proc boolean"),
        data_source=df([], "data_source_id int, data_source_name string"))
    tasks = tasks_from_catalog(task_catalog_for(md, 9, "E"), str(tmp_path / "wh"))
    assert [t["target_path"] for t in tasks] == [str(tmp_path / "wh" / "raw" / "orders")]
    st = run_step(spark, tasks, 9, str(tmp_path / "log"), dt.datetime(2024, 1, 1)).first()
    assert (st.last_status, st.any_failed) == ("succeeded", False)
    assert spark.read.parquet(tasks[0]["target_path"]).count() == spark.read.parquet(f"{sf}/orders.parquet").count()


def test_incremental_run_twice_keeps_one_copy(spark, sf, tmp_path):
    from conflux.plans.ingest import ingest
    target, task = str(tmp_path / "t"), {"conn_type": "parquet", "file_path": f"{sf}/orders.parquet",
                                         "run_ts": dt.datetime(2024, 1, 1)}
    n = spark.read.parquet(f"{sf}/orders.parquet").count()
    assert ingest(spark, {**task, "job_inst_id": 1, "is_full_load": True}, target)[1] == n
    for run in (2, 2):                              # the second time replaces the first
        assert ingest(spark, {**task, "job_inst_id": run, "is_full_load": False}, target)[1] == n
    got = spark.read.parquet(target).groupBy("job_inst_id").count().collect()
    assert {(r[0], r[1]) for r in got} == {(1, n), (2, n)}


def test_failed_file_task_keeps_target_and_moves_input(spark, tmp_path):
    from conflux.operators.conform import Constraints, ConstraintViolation
    from conflux.plans.ingest import ingest
    target = str(tmp_path / "t")
    spark.range(3).write.parquet(target)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,name\n1,a\n1,b\n")
    task = {"conn_type": "file", "file_path": str(tmp_path / "in"), "fields": ["id", "name"], "archive_files": True,
            "job_inst_id": 1, "run_ts": dt.datetime(2024, 1, 1), "constraints": Constraints(primary_key=["id"])}
    with pytest.raises(ConstraintViolation):
        ingest(spark, task, target)
    assert spark.read.parquet(target).count() == 3
    assert [p.name for p in (tmp_path / "in" / "error").glob("*.csv")] == ["err_a_20240101_000000.csv"]


def test_catalog_rows_carry_credentials_and_bounds(spark):
    from conflux.plans.ingest import tasks_from_catalog
    rows = spark.createDataFrame([("raw.orders", 1, "db", "src", "u", "p", None)],
                                 "tgt_fully_qualified_tbl_name string, task_thread_num int, conn_type string, "
                                 "conn_str_name string, username string, pass string, file_path string")
    task = tasks_from_catalog(rows, "/wh", connections={"src": {"partition_column": "id", "lower_bound": 0,
                                                                "upper_bound": 9, "num_partitions": 3}})[0]
    assert task["jdbc_properties"] == {"user": "u", "password": "p"} and task["target_path"] == "/wh/raw/orders"
    assert (task["partition_column"], task["upper_bound"], task["num_partitions"]) == ("id", 9, 3)
