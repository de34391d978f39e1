"""Registered checks: one Spark query per operator of the inventory, each
paired with an independent DuckDB SQL oracle over the same tables.

Every query reads the given tables (or inputs Spark derives from them by
the rules in :mod:`conflux.fixtures`), runs over the whole tables, and
returns a DataFrame whose column names equal the oracle's. Queries that
exercise a sink write to fresh folders under the shared staging root and
return the re-read result.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import fixtures as fx
from ..functions import jsonpath as J
from ..functions import text as X
from ..functions import timefmt as TM
from ..operators import aggregates as AG
from ..operators import folding as FO
from ..operators import joins as JN
from ..operators import project as PR
from ..operators import windows as WN
from ..operators.conform import Constraints, conform, violations
from ..operators.validate import REASON, land_routed, with_reason
from ..session import new_path, prepare
from ..sinks import tables as SK
from ..sources import files as FS
from ..sources import messages as MS
from ..sources import quoted as QT
from ..sources import relational as RL
from ..sources import responses as RS
from ..streaming import consumer as SC
from . import procs
from .entities import project_entity
from .flatfile import load_flat_file
from .ingest import Metadata, ingest, run_step, task_catalog_for, tasks_from_catalog

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RUN_TS = datetime(2024, 1, 1, 0, 0, 0)
RUN_ID = 42


def check(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def _path(sf: str, name: str) -> str:
    return f"{sf.rstrip('/')}/{name}.parquet"


CUSTOMER = T.StructType([T.StructField("c_custkey", T.LongType(), False),
                         T.StructField("c_name", T.StringType()),
                         T.StructField("c_nationkey", T.IntegerType(), False),
                         T.StructField("c_acctbal", T.DoubleType()),
                         T.StructField("c_mktsegment", T.StringType())])
SUPPLIER = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()),
                         T.StructField("s_nationkey", T.IntegerType()), T.StructField("s_acctbal", T.DoubleType()),
                         T.StructField("s_phone", T.StringType())])
PART = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()),
                     T.StructField("p_brand", T.StringType()), T.StructField("p_type", T.StringType()),
                     T.StructField("p_size", T.IntegerType()), T.StructField("p_retailprice", T.DoubleType())])
WORK = T.StructType([T.StructField("id", T.StringType()), T.StructField("title", T.StringType()),
                     T.StructField("publication_year", T.IntegerType()),
                     T.StructField("cited_by_count", T.LongType()),
                     T.StructField("primary_location", T.StringType())])


# SQL form of the message fixture M (conflux.fixtures.messages)
M_SQL = """
m AS (
  SELECT event_id, user_id, event_type, ts,
    'test-topic' || CAST(event_id % 3 + 1 AS VARCHAR) AS topic,
    CAST(0 AS INTEGER) AS "partition",
    CAST(event_id // 3 AS BIGINT) AS "offset",
    CASE event_id % 20
      WHEN 0 THEN '{"name":null,"amount":1}'
      WHEN 1 THEN '{"name":"a","address":""}'
      WHEN 2 THEN '{"name":"a","transaction_id":[]}'
      WHEN 3 THEN '{"address":"' || event_type || '","amount":' || CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) || '}'
      WHEN 4 THEN '{"name":"z","amount":0}'
      WHEN 5 THEN '{bad'
      WHEN 6 THEN '[1]'
      ELSE '{"name":"user-' || CAST(user_id AS VARCHAR) || '","address":"' || event_type
           || '","transaction_id":"' || CAST(event_id AS VARCHAR) || '","amount":'
           || CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) || '}'
    END AS value,
    CASE WHEN event_id % 20 IN (0, 1, 2) THEN 'Validation failed: null or empty fields'
         WHEN event_id % 20 IN (5, 6) THEN 'Processing error' END AS error_reason,
    CASE WHEN event_id % 20 = 4 THEN 'z' WHEN event_id % 20 >= 7 THEN 'user-' || CAST(user_id AS VARCHAR) END AS name,
    CASE WHEN event_id % 20 = 3 OR event_id % 20 >= 7 THEN event_type END AS address,
    CASE WHEN event_id % 20 >= 7 THEN CAST(event_id AS VARCHAR) END AS transaction_id,
    CASE WHEN event_id % 20 = 4 THEN CAST(0 AS BIGINT)
         WHEN event_id % 20 = 3 OR event_id % 20 >= 7 THEN CAST(floor(value * 100) AS BIGINT) END AS amount
  FROM events)
"""

# SQL form of the page fixture G (conflux.fixtures.response_pages)
G_SQL = """
g AS (
  SELECT page_id, url, CAST(page_id // 10 AS BIGINT) AS request_id,
         CAST(page_id % 10 + 1 AS INTEGER) AS page_num,
         CASE WHEN page_id % 7 = 6 THEN NULL ELSE 'c' || CAST(page_id AS VARCHAR) END AS next_cursor
  FROM pages),
g_end AS (SELECT request_id, min(page_num) AS end_page FROM g WHERE next_cursor IS NULL GROUP BY request_id)
"""

RUN_LOG_SQL = """
rl AS (
  SELECT CAST(user_id AS BIGINT) AS job_inst_id, event_id AS logging_seq, ts AS log_ts,
         event_type AS task_name,
         CASE event_type WHEN 'view' THEN 'running' WHEN 'purchase' THEN 'succeeded'
                         WHEN 'error' THEN 'failed' END AS task_status,
         props AS error_msg, event_type = 'error' AS is_error
  FROM events)
"""


def _messages(spark, sf) -> DataFrame:
    return fx.messages(_t(spark, sf, "events"))


# ---------------------------------------------------------------- flagship


@check("flat_file_load", """
SELECT c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey, c_acctbal, c_mktsegment,
       CAST(42 AS INTEGER) AS job_inst_id, TIMESTAMP '2024-01-01 00:00:00' AS date_created
FROM customer""")
def flat_file_load(spark, sf):
    """Text CSV -> typed, checked, stamped full reload."""
    csv = FS.write_text_csv(_t(spark, sf, "customer"), new_path(spark, "customer-csv"))
    target = new_path(spark, "dbo-customer")
    load_flat_file(spark, csv, CUSTOMER, target, RUN_ID, RUN_TS,
                   Constraints(not_null=["c_custkey", "c_nationkey"], primary_key=["c_custkey"],
                               max_length={"c_name": 128}))
    return spark.read.parquet(target)


def _customer_with_bad_balances(spark, sf):
    c = _t(spark, sf, "customer")
    return c.select("c_custkey", "c_name", "c_nationkey",
                    F.when(F.col("c_custkey") % 10 == 0, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string"))
                     .alias("c_acctbal"), "c_mktsegment")


@check("flat_file_load_rejects", """
SELECT c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey, c_acctbal, c_mktsegment,
       CAST(42 AS INTEGER) AS job_inst_id, TIMESTAMP '2024-01-01 00:00:00' AS date_created
FROM customer WHERE c_custkey % 10 <> 0""")
def flat_file_load_rejects(spark, sf):
    """C5 reject mode in the flagship: rows whose balance is not a number
    are set aside in one routed write; the target gets the rest."""
    csv = FS.write_text_csv(_customer_with_bad_balances(spark, sf), new_path(spark, "customer-bad-csv"))
    target = new_path(spark, "dbo-customer-ok")
    load_flat_file(spark, csv, CUSTOMER, target, RUN_ID, RUN_TS, Constraints(primary_key=["c_custkey"]),
                   reject_path=new_path(spark, "customer-rejects"))
    return spark.read.parquet(target)


@check("flat_file_rejects", """
SELECT c_custkey, 'bad double: c_acctbal' AS reject_reason FROM customer WHERE c_custkey % 10 = 0""")
def flat_file_rejects(spark, sf):
    """The rejected rows of the same load, with their reason."""
    csv = FS.write_text_csv(_customer_with_bad_balances(spark, sf), new_path(spark, "customer-bad-csv"))
    rejects = new_path(spark, "customer-rejects")
    load_flat_file(spark, csv, CUSTOMER, new_path(spark, "dbo-customer-ok"), RUN_ID, RUN_TS,
                   reject_path=rejects)
    return spark.read.parquet(rejects).select("c_custkey", F.col("route").alias("reject_reason"))


# ---------------------------------------------------------------- 2.1 sources


@check("extract_full", "SELECT * FROM orders")
def extract_full(spark, sf):
    """A1 through the source dispatcher (Parquet connection; a JDBC
    connection takes the same path with a partitioned read)."""
    prepare(spark)
    return RL.extract(spark, {"conn_type": "parquet", "file_path": _path(sf, "orders"), "is_full_load": True})


@check("extract_incremental", "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01 00:00:00'")
def extract_incremental(spark, sf):
    """A2: incremental predicate, pushed into the scan."""
    prepare(spark)
    return RL.extract(spark, {"conn_type": "parquet", "file_path": _path(sf, "orders"), "is_full_load": False,
                              "incr_column": "o_orderdate", "incr_date": datetime(2000, 1, 1)})


@check("csv_bulk_load", "SELECT * FROM customer")
def csv_bulk_load(spark, sf):
    """A3: header skipped, positional text columns, then typed."""
    cust = _t(spark, sf, "customer")
    csv = FS.write_text_csv(cust, new_path(spark, "customer-small"), encoding="UTF-8")
    raw = FS.read_csv_positional(spark, csv, cust.columns)
    return conform(raw, CUSTOMER, "strict")


@check("csv_named_load", """
SELECT s_suppkey, s_name, CAST(s_nationkey AS INTEGER) AS s_nationkey, s_acctbal, CAST(NULL AS VARCHAR) AS s_phone
FROM supplier""")
def csv_named_load(spark, sf):
    """A4: Latin-1 file with reordered and extra columns, read by header."""
    sup = _t(spark, sf, "supplier")
    shuffled = sup.select("s_acctbal", F.lit("x,y").alias("s_comment"), "s_name", "s_nationkey", "s_suppkey")
    csv = FS.write_text_csv(shuffled, new_path(spark, "supplier-csv"))
    raw = FS.read_csv_by_header(spark, csv, SUPPLIER.fieldNames())
    return conform(raw, SUPPLIER, "strict")


@check("delimited_stage", "SELECT * FROM part")
def delimited_stage(spark, sf):
    """A5: '|'-separated windows-1252 staging round trip."""
    part = _t(spark, sf, "part")
    stage = FS.stage_delimited(part, new_path(spark, "part-stage"))
    return FS.read_delimited_stage(spark, stage, part.schema)


@check("delimited_real_text", r"""
SELECT doc_id, text, NOT regexp_matches(text, '[^\x00-\x7f\xa0-\xff€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]') AS was_staged
FROM documents""")
def delimited_real_text(spark, sf):
    """A5 on real texts: line breaks, quotes and delimiters survive the stage;
    rows that its encoding can't hold are kept apart, whole."""
    docs = _t(spark, sf, "documents").select("doc_id", "text")
    fit, rest = FS.split_stageable(docs, multi_line=True)
    stage = FS.stage_delimited(fit, new_path(spark, "text-stage"), multi_line=True)
    back = FS.read_delimited_stage(spark, stage, docs.schema, multi_line=True)
    return back.withColumn("was_staged", F.lit(True)).unionByName(rest.withColumn("was_staged", F.lit(False)))


@check("json_rejects", """
SELECT doc_id, CASE WHEN doc_id % 7 <> 3 THEN text END AS text, doc_id % 7 = 3 AS was_rejected FROM documents""")
def json_rejects(spark, sf):
    """A7's reject mode: lines cut short are kept apart, whole, and the
    records of all other lines are read."""
    docs = _t(spark, sf, "documents")
    line = F.to_json(F.struct("doc_id", "text"))
    path = new_path(spark, "cut-lines")
    (docs.select(F.when(F.col("doc_id") % 7 == 3, F.expr("concat('{\"doc_id\":', doc_id, ',\"text')")).otherwise(line)
                 .alias("value")).write.text(path))
    good, bad = FS.read_json_or_reject(spark, path, "doc_id bigint, text string")
    cut = bad.select(F.regexp_extract("bad_text", r"^\{\"doc_id\":(\d+)", 1).cast("bigint").alias("doc_id"),
                     F.lit(None).cast("string").alias("text"), F.lit(True).alias("was_rejected"))
    return good.withColumn("was_rejected", F.lit(False)).unionByName(cut)


@check("parquet_shape", """
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST((SELECT count(*) FROM information_schema.columns WHERE table_name = 'lineitem') AS BIGINT) AS n_cols
FROM lineitem""")
def parquet_shape(spark, sf):
    """A6."""
    prepare(spark)
    return FS.parquet_shape(spark, _path(sf, "lineitem"))


WORKS_SQL = """
SELECT 'W' || CAST(doc_id AS VARCHAR) AS id, source AS title,
       CAST(2000 + doc_id % 25 AS INTEGER) AS publication_year, n_chars AS cited_by_count
FROM documents"""


@check("json_array_scan", WORKS_SQL)
def json_array_scan(spark, sf):
    """JSON-array pages of work records."""
    path = fx.write_work_pages(spark, _t(spark, sf, "documents"))
    return FS.read_json_records(spark, path, WORK).drop("primary_location")


@check("landed_pages", "WITH " + G_SQL + """
SELECT g.request_id, g.page_num, g.page_id AS id, g.url AS title
FROM g LEFT JOIN g_end USING (request_id)
WHERE g.page_num <= 8 AND (g_end.end_page IS NULL OR g.page_num <= g_end.end_page)""")
def landed_pages(spark, sf):
    """A8 (+F3): results of each request's cursor chain, max 8 pages."""
    pages = fx.response_pages(_t(spark, sf, "pages"))
    return RS.landed_pages(pages, "id bigint, title string", max_pages=8)


# SQL form of the page fixture C (conflux.fixtures.cursor_pages), walked step by step
C_SQL = """
RECURSIVE c AS (
  SELECT page_id, url, html, CAST(page_id // 8 AS BIGINT) AS request_id,
         CASE WHEN page_id % 8 = 0 THEN '*' ELSE 'c' || page_id END AS cursor,
         CASE WHEN page_id % 7 = 6 OR page_id % 8 = 7 THEN NULL WHEN page_id % 31 = 8 THEN '*'
              ELSE 'c' || (page_id + 1) END AS next_cursor,
         page_id % 17 = 2 AS twice
  FROM pages WHERE page_id % 29 <> 11),
walked AS (
  SELECT *, CAST(1 AS INTEGER) AS page_num FROM c WHERE cursor = '*'
  UNION ALL
  SELECT c.*, CAST(w.page_num + 1 AS INTEGER) FROM walked w JOIN c ON c.request_id = w.request_id AND c.cursor = w.next_cursor
  WHERE w.page_num < 6 AND c.cursor <> '*')
"""


@check("linked_pages", "WITH " + C_SQL + """
SELECT request_id, page_num, CAST(page_id AS BIGINT) AS id, url AS title, html FROM walked
UNION ALL SELECT request_id, page_num, CAST(-page_id AS BIGINT), NULL, NULL FROM walked WHERE page_id % 5 NOT IN (1, 2)""")
def linked_pages(spark, sf):
    """A8 (+F3) over whole pages: chains followed by cursor, past repeated,
    missing and circular pages, bad elements left out."""
    pages = fx.cursor_pages(_t(spark, sf, "pages"))
    return RS.linked_pages(pages, "id bigint, title string, html string", max_pages=6, rejects=True)[0]


@check("linked_page_elements", "WITH " + C_SQL + """
SELECT request_id, page_num, CAST(1 AS INTEGER) AS place,
       CASE WHEN page_id % 5 = 1 THEN 'not an object' ELSE 'bad bigint: id' END AS reason,
       CASE WHEN page_id % 5 = 1 THEN '"oops"' ELSE '{"id":"x' || page_id || '"}' END AS element
FROM walked WHERE page_id % 5 IN (1, 2)""")
def linked_page_elements(spark, sf):
    """The elements that the same load keeps apart."""
    pages = fx.cursor_pages(_t(spark, sf, "pages"))
    bad = RS.linked_pages(pages, "id bigint, title string, html string", max_pages=6, rejects=True)[1]
    return bad.select("request_id", "page_num", F.col(RS.PLACE).alias("place"), F.col(RS.REASON).alias("reason"),
                      F.col(RS.ELEMENT).alias("element"))


@check("linked_page_problems", "WITH " + C_SQL + """
, started AS (SELECT DISTINCT request_id FROM walked),
problem AS (
  SELECT request_id, 'repeated page' AS reason FROM c WHERE twice
  UNION ALL SELECT w.request_id, 'missing page' FROM walked w WHERE next_cursor IS NOT NULL AND page_num < 6
    AND NOT EXISTS (SELECT 1 FROM c WHERE c.request_id = w.request_id AND c.cursor = w.next_cursor)
  UNION ALL SELECT request_id, 'cursor goes back' FROM walked WHERE next_cursor = '*'
  UNION ALL SELECT DISTINCT request_id, 'no first page' FROM c WHERE request_id NOT IN (SELECT request_id FROM started)
  UNION ALL SELECT request_id, 'not reached' FROM c WHERE request_id IN (SELECT request_id FROM started)
    AND page_id NOT IN (SELECT page_id FROM walked))
SELECT request_id, reason, CAST(count(*) AS BIGINT) AS n FROM problem GROUP BY 1, 2""")
def linked_page_problems(spark, sf):
    """What is wrong with the chains of the same load."""
    pages = fx.cursor_pages(_t(spark, sf, "pages"))
    problems = RS.linked_pages(pages, "id bigint, title string, html string", max_pages=6, rejects=True)[2]
    return problems.groupBy(F.col("request").alias("request_id"), "reason").agg(F.sum("n").cast("bigint").alias("n"))


ENVELOPE = T.StructType([
    T.StructField("page", T.IntegerType()), T.StructField("total", T.LongType()),
    T.StructField("data", T.ArrayType(T.StructType([T.StructField("id", T.IntegerType()),
                                                     T.StructField("name", T.StringType())]))),
    T.StructField("support", T.StructType([T.StructField("url", T.StringType()),
                                           T.StructField("text", T.StringType())]))])

ENVELOPE_SQL = """
SELECT r.r_regionkey AS region_id, CAST(1 AS INTEGER) AS page,
       CAST((SELECT count(*) FROM nation n2 WHERE n2.n_regionkey = r.r_regionkey) AS BIGINT) AS total,
       CAST(n.n_nationkey AS INTEGER) AS id, n.n_name AS name, r.r_name AS support_url, 't' AS support_text
FROM region r JOIN nation n ON n.n_regionkey = r.r_regionkey
WHERE r.r_regionkey NOT IN (3, 4)"""


@check("envelope_flatten", ENVELOPE_SQL)
def envelope_flatten(spark, sf):
    """A9 + D7: data x support cross apply; absent/empty sides give no rows."""
    docs = fx.envelopes(_t(spark, sf, "region"), _t(spark, sf, "nation"))
    return JN.flatten_envelope(docs, "body", ENVELOPE, scalar_fields=("page", "total"), keep=("region_id",))


@check("kafka_subscribe", "WITH " + M_SQL + """
SELECT topic, "partition", "offset", ts AS "timestamp", value FROM m
WHERE regexp_matches(topic, '^(?:test-topic[12])')""")
def kafka_subscribe(spark, sf):
    """A10 + I13: pattern subscription over a Kafka-shaped frame."""
    return MS.subscribe(_messages(spark, sf), "test-topic[12]").select(
        "topic", "partition", "offset", "timestamp", "value")


@check("generate_messages", """
SELECT t.topic, CAST(count(*) AS BIGINT) AS n_messages, true AS amounts_in_range,
       CAST(count(*) AS BIGINT) AS n_distinct_ids
FROM events, (SELECT 'topic1' AS topic UNION ALL SELECT 'topic2' UNION ALL SELECT 'topic3') t
GROUP BY t.topic""")
def generate_messages(spark, sf):
    """A11 + I15: one reproducible synthetic record per event id and topic."""
    g = MS.generate_messages(_t(spark, sf, "events"), "event_id")
    tid = F.get_json_object("value", "$.transaction_id")
    return g.groupBy("topic").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_messages"),
        F.bool_and(F.col("amount").between(0, 99999)).alias("amounts_in_range"),
        F.count_distinct(tid).cast("bigint").alias("n_distinct_ids"))


@check("empty_like", "SELECT * FROM customer WHERE false")
def empty_like(spark, sf):
    """A12."""
    return FS.empty_like(_t(spark, sf, "customer"))


# ---------------------------------------------------------------- 2.2 sinks


@check("truncate_and_load", "SELECT * FROM customer")
def truncate_and_load(spark, sf):
    """B1: loading twice leaves one copy."""
    cust, target = _t(spark, sf, "customer"), new_path(spark, "reload")
    SK.truncate_and_load(cust, target)
    SK.truncate_and_load(cust, target)
    return spark.read.parquet(target)


@check("append_load", "SELECT * FROM orders")
def append_load(spark, sf):
    """B2: two appended halves equal the whole."""
    o, target = _t(spark, sf, "orders"), new_path(spark, "append")
    SK.append_load(o.filter(F.col("o_orderkey") % 2 == 0), target)
    SK.append_load(o.filter(F.col("o_orderkey") % 2 != 0), target)
    return spark.read.parquet(target)


@check("staged_insert", "SELECT * FROM nation")
def staged_insert(spark, sf):
    """Stage, check, insert, drop the stage."""
    target = new_path(spark, "nation-target")
    SK.staged_insert(spark, _t(spark, sf, "nation"), target, RUN_ID,
                     Constraints(not_null=["n_nationkey"], primary_key=["n_nationkey"]), drop_stage=True)
    return spark.read.parquet(target)


@check("load_with_rowcount", """
SELECT CAST(count(*) AS BIGINT) AS rows_observed, CAST(count(*) AS BIGINT) AS rows_in_target FROM lineitem""")
def load_with_rowcount(spark, sf):
    """Rows counted while writing vs rows in the target."""
    target = new_path(spark, "counted")
    n = SK.load_with_rowcount(_t(spark, sf, "lineitem"), target)
    return AG.row_count(spark.read.parquet(target)).select(
        F.lit(n).cast("bigint").alias("rows_observed"), F.col("n_rows").alias("rows_in_target"))


@check("chunked_insert", "SELECT * FROM supplier")
def chunked_insert(spark, sf):
    """Chunks of at most 100 rows, written in parallel."""
    target = new_path(spark, "chunked")
    SK.chunked_insert(_t(spark, sf, "supplier"), target, chunk=100)
    return spark.read.parquet(target)


@check("archive_replay", "WITH " + G_SQL + """
SELECT request_id, page_num, next_cursor, CAST(42 AS INTEGER) AS job_inst_id, '2024_01_01' AS load_date FROM g""")
def archive_replay(spark, sf):
    """Archive fetched pages as JSON by run and date, then replay."""
    root = new_path(spark, "archive")
    SK.archive_json(fx.response_pages(_t(spark, sf, "pages")), root, RUN_ID, "2024_01_01")
    back = FS.read_json_records(spark, root, "request_id bigint, page_num int, body string, "
                                             "job_inst_id int, load_date string")
    return back.select("request_id", "page_num",
                       J.nested_path("body", "meta.next_cursor").alias("next_cursor"),
                       "job_inst_id", "load_date")


@check("dlq_records", "WITH " + M_SQL + """
SELECT topic AS source_topic, "partition", "offset", error_reason,
       error_reason AS dlq_reason,
       CASE WHEN event_id % 20 IN (5, 6) THEN value END AS original_message
FROM m WHERE error_reason IS NOT NULL""")
def dlq_records_q(spark, sf):
    """Dead-letter JSON for rejected messages (routed once, landed in
    one write, read back field-wise)."""
    _, dead = land_routed(_messages(spark, sf), {"name": "string"}, new_path(spark, "routed"))
    return dead.select("source_topic", "partition", "offset", REASON,
                       F.get_json_object("value", "$.error_reason").alias("dlq_reason"),
                       F.get_json_object("value", "$.bad_record.original_message").alias("original_message"))


@check("publish_fanout", "WITH " + M_SQL + """
SELECT topic, CAST(count(*) AS BIGINT) AS n_messages,
       CAST(count(*) FILTER (WHERE name IS NOT NULL) AS BIGINT) AS n_named
FROM m WHERE error_reason IS NULL GROUP BY topic""")
def publish_fanout(spark, sf):
    """Valid records re-serialised to their topics, landed and read back."""
    good, _ = land_routed(_messages(spark, sf), SC.RECORD_FIELDS, new_path(spark, "routed"))
    landed = new_path(spark, "published")
    SK.publish(good, landing=landed)
    out = spark.read.schema("topic string, value string").json(landed)
    return out.groupBy("topic").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_messages"),
        F.count(F.get_json_object("value", "$.name")).cast("bigint").alias("n_named"))


@check("run_log_append", """
SELECT CAST(user_id AS INTEGER) AS job_inst_id, CAST(count(*) AS BIGINT) AS n_entries,
       CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS n_errors
FROM events GROUP BY 1""")
def run_log_append(spark, sf):
    """Audit rows appended per run, folded back."""
    log = new_path(spark, "runlog")
    SK.append_run_log(fx.run_log(_t(spark, sf, "events")), log)
    return spark.read.parquet(log).groupBy("job_inst_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_entries"),
        F.count(F.when(F.col("is_error"), 1)).cast("bigint").alias("n_errors"))


# ---------------------------------------------------------------- 2.3 projections


@check("project_fields", "SELECT c_custkey, c_mktsegment, CAST(NULL AS VARCHAR) AS c_phone, c_name FROM customer")
def project_fields(spark, sf):
    """C1."""
    return PR.project_fields(_t(spark, sf, "customer"), ["c_custkey", "C_MKTSEGMENT", "c_phone", "c_name"]) \
        .withColumnRenamed("C_MKTSEGMENT", "c_mktsegment")


@check("works_nested_path", """
SELECT 'W' || CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 4 = 0 THEN lang END AS host_venue
FROM documents""")
def works_nested_path(spark, sf):
    """Object / null / array / absent location -> value only for the object."""
    path = fx.write_work_pages(spark, _t(spark, sf, "documents"))
    w = FS.read_json_records(spark, path, WORK)
    return w.select("id", J.nested_path("primary_location", "source.display_name").alias("host_venue"))


@check("works_rename_map", """
SELECT 'W' || CAST(doc_id AS VARCHAR) AS id, source AS title, n_chars AS citation_count,
       CASE WHEN doc_id % 4 = 0 THEN lang END AS host_venue
FROM documents""")
def works_rename_map(spark, sf):
    """Target <- source mapping."""
    w = fx.work_records(_t(spark, sf, "documents"))
    rec = F.col("record")
    return PR.rename_map(w, {
        "id": F.get_json_object(rec, "$.id"),
        "title": F.get_json_object(rec, "$.title"),
        "citation_count": F.get_json_object(rec, "$.cited_by_count").cast("bigint"),
        "host_venue": J.nested_path(F.get_json_object(rec, "$.primary_location"), "source.display_name"),
    })


@check("works_entity", """
SELECT 'W' || CAST(doc_id AS VARCHAR) AS id, source AS title, CAST(NULL AS VARCHAR) AS doi,
       CAST(2000 + doc_id % 25 AS VARCHAR) AS publication_year,
       CASE WHEN doc_id % 4 = 0 THEN lang END AS host_venue, CAST(NULL AS VARCHAR) AS type
FROM documents""")
def works_entity(spark, sf):
    """C1+C2+C3: a landed work record mapped to the works table's fields."""
    return project_entity(fx.work_records(_t(spark, sf, "documents")), "openalex_works")


@check("add_lineage", """
SELECT r_regionkey, r_name, CAST(42 AS INTEGER) AS job_inst_id, TIMESTAMP '2024-01-01 00:00:00' AS date_created
FROM region""")
def add_lineage(spark, sf):
    """C4."""
    return PR.add_lineage(_t(spark, sf, "region"), RUN_ID, RUN_TS)


@check("conform_typed", "SELECT * FROM customer")
def conform_typed(spark, sf):
    """C5 strict: text layer -> typed."""
    c = _t(spark, sf, "customer")
    text = c.select([F.col(x).cast("string").alias(x) for x in c.columns])
    return conform(text, CUSTOMER, "strict")


@check("conform_reject", """
SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_custkey % 10 = 0 THEN 'bad double: c_acctbal' END AS reject_reason
FROM customer""")
def conform_reject(spark, sf):
    """C5 reject mode: unconvertible values flagged, not fatal."""
    c = _t(spark, sf, "customer")
    text = c.select(F.col("c_custkey").cast("string").alias("c_custkey"),
                    F.when(F.col("c_custkey") % 10 == 0, F.lit("n/a"))
                     .otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"))
    schema = T.StructType([CUSTOMER["c_custkey"], CUSTOMER["c_acctbal"]])
    return conform(text, schema, "reject")


@check("enrich_message", "WITH " + M_SQL + """
SELECT topic, "offset", 'etl-group' AS group_id, TIMESTAMP '2024-01-01 00:00:00' AS date_created,
       topic AS kafka_topic FROM m""")
def enrich_message(spark, sf):
    """C6."""
    return PR.enrich_message(_messages(spark, sf), "etl-group", RUN_TS).select(
        "topic", "offset", "group_id", "date_created", "kafka_topic")


CLASS_RULES = [("econ", "budget"), ("small", "compact"), ("large", "bulk")]


@check("classify", """
SELECT p_partkey, p_type,
       CASE WHEN p_type ILIKE '%econ%' THEN 'budget' WHEN p_type ILIKE '%small%' THEN 'compact'
            WHEN p_type ILIKE '%large%' THEN 'bulk' ELSE 'other' END AS p_class
FROM part""")
def classify(spark, sf):
    """C7."""
    p = _t(spark, sf, "part")
    return p.select("p_partkey", "p_type", X.classify("p_type", CLASS_RULES, "other").alias("p_class"))


@check("step_flags", """
SELECT o_orderkey, o_orderpriority,
       CASE WHEN o_orderpriority ILIKE '%E%' THEN 1 ELSE 0 END AS run_extract,
       CASE WHEN o_orderpriority ILIKE '%T%' THEN 1 ELSE 0 END AS run_transform,
       CASE WHEN o_orderpriority ILIKE '%L%' THEN 1 ELSE 0 END AS run_load
FROM orders""")
def step_flags(spark, sf):
    """Letters of o_orderpriority as E/T/L step flags."""
    o = _t(spark, sf, "orders")
    return o.select("o_orderkey", "o_orderpriority", X.step_flags(F.lower("o_orderpriority")).alias("f")) \
        .select("o_orderkey", "o_orderpriority", "f.*")


@check("is_valid", "WITH " + M_SQL + """
SELECT topic, "offset",
       CASE WHEN event_id % 20 IN (5, 6) THEN NULL WHEN event_id % 20 IN (0, 1, 2) THEN false ELSE true END AS is_valid
FROM m""")
def is_valid(spark, sf):
    """Present values must be non-null, non-empty; missing keys are fine."""
    return _messages(spark, sf).select("topic", "offset", J.is_valid_record("value").alias("is_valid"))


@check("split_valid_counts", "WITH " + M_SQL + """
SELECT topic, error_reason, CAST(count(*) AS BIGINT) AS n_messages FROM m GROUP BY topic, error_reason""")
def split_valid_counts(spark, sf):
    """Routed counts per topic and reason (null reason = valid)."""
    return with_reason(_messages(spark, sf)).groupBy("topic", REASON).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_messages"))


@check("run_scope", "WITH " + RUN_LOG_SQL + "SELECT * FROM rl WHERE job_inst_id = 7")
def run_scope(spark, sf):
    """C11: one run's rows (a pushed filter; the log is sorted by run
    inside each file, so row groups of other runs are skipped)."""
    log = new_path(spark, "runlog-scope")
    SK.append_run_log(fx.run_log(_t(spark, sf, "events")), log)
    df = PR.run_scope(spark.read.parquet(log), 7)
    return df.select(F.col("job_inst_id").cast("bigint").alias("job_inst_id"), "logging_seq", "log_ts",
                     "task_name", "task_status", "error_msg", "is_error")


@check("optional_filter_off", "SELECT CAST(count(*) AS BIGINT) AS n_rows FROM lineitem")
def optional_filter_off(spark, sf):
    """p = 0 -> no filter."""
    return AG.row_count(PR.optional_filter(_t(spark, sf, "lineitem"), "l_suppkey", 0))


@check("optional_filter_on", "SELECT * FROM lineitem WHERE l_suppkey = 17")
def optional_filter_on(spark, sf):
    """p = 17 -> equality, pushed into the scan."""
    return PR.optional_filter(_t(spark, sf, "lineitem"), "l_suppkey", 17)


@check("null_default", """
SELECT c.c_custkey, coalesce(max(o.o_orderdate), TIMESTAMP '2001-12-31 00:00:00') AS incr_date
FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey""")
def null_default(spark, sf):
    """A customer without orders gets run date - 1 day."""
    c, o = _t(spark, sf, "customer"), _t(spark, sf, "orders")
    last = o.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_order"))
    j = c.join(last, c.c_custkey == last.o_custkey, "left")
    return j.select("c_custkey", PR.null_default("last_order", datetime(2002, 1, 1)).alias("incr_date"))


@check("check_constraints", """
SELECT 'primary_key' AS rule, 'l_orderkey' AS column_name, CAST(l_orderkey AS VARCHAR) AS key_text,
       CAST(count(*) AS BIGINT) AS n_rows
FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1
UNION ALL
SELECT 'max_length', 'p_name', p_name, CAST(count(*) AS BIGINT) FROM part WHERE length(p_name) > 10 GROUP BY p_name
UNION ALL
SELECT 'not_null', 'c_name', NULL, CAST(count(*) AS BIGINT) FROM customer WHERE c_name IS NULL HAVING count(*) > 0""")
def check_constraints(spark, sf):
    """C14: violations of primary key, text length and NOT NULL."""
    a = violations(_t(spark, sf, "lineitem"), Constraints(not_null=["l_orderkey"], primary_key=["l_orderkey"]))
    b = violations(_t(spark, sf, "part"), Constraints(max_length={"p_name": 10}))
    c = violations(_t(spark, sf, "customer"), Constraints(not_null=["c_name"]))
    return a.unionByName(b).unionByName(c)


# ---------------------------------------------------------------- 2.4 joins


@check("join_runs", """
SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")
def join_runs(spark, sf):
    """D1."""
    n, r = _t(spark, sf, "nation"), _t(spark, sf, "region")
    return JN.join_runs(n, r, n.n_regionkey == r.r_regionkey, right_bounded=True).select(
        "n_nationkey", "n_name", "r_name")


@check("task_catalog", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, o.o_orderdate, c.c_name, n.n_name, r.r_name,
       p.p_name, s.s_name
FROM lineitem l
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey""")
def task_catalog(spark, sf):
    """Chain of left joins, one row per base row."""
    l = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    o = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    c = _t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey")
    n = _t(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    r = _t(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    p = _t(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    s = _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    out = JN.task_catalog(l, [JN.Dim(o, "l_orderkey"), JN.Dim(c, "o_custkey"),
                              JN.Dim(n, "c_nationkey", bounded=True), JN.Dim(r, "n_regionkey", bounded=True),
                              JN.Dim(p, "l_partkey"), JN.Dim(s, "l_suppkey")])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_orderdate", "c_name",
                      "n_name", "r_name", "p_name", "s_name")


@check("table_roles", """
SELECT l.l_orderkey, l.l_linenumber, cn.n_name AS cust_n_name, sn.n_name AS supp_n_name
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey
LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey""")
def table_roles(spark, sf):
    """D3: nation joined as the customer's and as the supplier's nation of
    each line item."""
    sold = (_t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("s_suppkey"))
            .join(_t(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                                 F.col("o_custkey").alias("c_custkey")), "l_orderkey")
            .join(_t(spark, sf, "customer").select("c_custkey", "c_nationkey"), "c_custkey")
            .join(_t(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), "s_suppkey"))
    out = JN.with_table_roles(sold, _t(spark, sf, "nation"), "n_nationkey",
                              {"cust": "c_nationkey", "supp": "s_nationkey"}, ["n_name"], bounded=True)
    return out.select("l_orderkey", "l_linenumber", "cust_n_name", "supp_n_name")


@check("active_tasks", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def active_tasks(spark, sf):
    """Semi-join on a filtered key set."""
    seg = _t(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("o_custkey"))
    return JN.active_tasks(_t(spark, sf, "orders"), seg, "o_custkey").select("o_orderkey", "o_custkey")


@check("correlated_lookup", """
SELECT c.c_custkey, (SELECT max(c2.c_acctbal) FROM customer c2 WHERE c2.c_nationkey = c.c_nationkey)
       AS nation_max_balance
FROM customer c""")
def correlated_lookup(spark, sf):
    """Correlated scalar subquery (decorrelated to aggregate + left join)."""
    c = _t(spark, sf, "customer")
    return JN.with_correlated(c, c, "c_nationkey", F.max("c_acctbal"), "nation_max_balance").select(
        "c_custkey", "nation_max_balance")


@check("scalar_subquery", "SELECT event_id, value, (SELECT max(value) FROM events) AS max_value FROM events")
def scalar_subquery(spark, sf):
    """Uncorrelated scalar subquery as a column."""
    e = _t(spark, sf, "events")
    return JN.with_scalar(e.select("event_id", "value"), e.select(F.max("value")), "max_value")


# ---------------------------------------------------------------- 2.5 aggregates


@check("row_count", "SELECT CAST(count(*) AS BIGINT) AS n_rows FROM lineitem")
def row_count(spark, sf):
    """E1."""
    return AG.row_count(_t(spark, sf, "lineitem"))


@check("count_by_topic", "WITH " + M_SQL + "SELECT topic, CAST(count(*) AS BIGINT) AS n_messages FROM m GROUP BY topic")
def count_by_topic(spark, sf):
    """E2."""
    return AG.count_by_topic(_messages(spark, sf))


@check("first_error", "WITH " + RUN_LOG_SQL + """
SELECT job_inst_id, arg_min(error_msg, (log_ts, logging_seq)) AS first_error
FROM rl WHERE is_error GROUP BY job_inst_id""")
def first_error(spark, sf):
    """E3."""
    return AG.first_error(fx.run_log(_t(spark, sf, "events")))


@check("run_status", "WITH " + RUN_LOG_SQL + """
SELECT job_inst_id,
       arg_max(task_status, (log_ts, logging_seq)) FILTER (WHERE task_status IS NOT NULL) AS last_status,
       max(log_ts) FILTER (WHERE task_status = 'running') AS start_time,
       max(log_ts) FILTER (WHERE task_status IN ('failed', 'succeeded')) AS end_time,
       arg_min(error_msg, (log_ts, logging_seq)) FILTER (WHERE is_error) AS error_msg,
       coalesce(bool_or(task_status = 'failed'), false) AS any_failed,
       CAST(count(*) AS BIGINT) AS n_entries
FROM rl GROUP BY job_inst_id""")
def run_status(spark, sf):
    """Status fold over the append-only run log."""
    return AG.run_status(fx.run_log(_t(spark, sf, "events")))


@check("run_status_updates", "WITH " + RUN_LOG_SQL + """
SELECT CAST(job_inst_id AS INTEGER) AS job_inst_id,
       arg_max(task_status, (log_ts, logging_seq)) FILTER (WHERE task_status IS NOT NULL) AS last_status,
       max(log_ts) FILTER (WHERE task_status = 'running') AS start_time,
       max(log_ts) FILTER (WHERE task_status IN ('failed', 'succeeded')) AS end_time,
       arg_min(error_msg, (log_ts, logging_seq)) FILTER (WHERE is_error) AS error_msg,
       coalesce(bool_or(task_status = 'failed'), false) AS any_failed,
       CAST(count(*) AS BIGINT) AS n_entries
FROM rl GROUP BY job_inst_id""")
def run_status_updates(spark, sf):
    """E4 kept in a state: the log grows three times, each update reads what is new."""
    entries = fx.run_log(_t(spark, sf, "events"))
    log, state = new_path(spark, "runlog"), new_path(spark, "run-state")
    for k in range(3):
        SK.append_run_log(entries.filter(F.col("logging_seq") % 3 == k), log)
        out = FO.update_status(spark, log, state)
    return out


@check("topics_seen", "WITH " + M_SQL + "SELECT DISTINCT topic FROM m")
def topics_seen(spark, sf):
    """E5."""
    return AG.topics_seen(_messages(spark, sf))


# ---------------------------------------------------------------- 2.6 windows

F1_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_shipdate"]


@check("number_tasks", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY """ + ", ".join(F1_ORDER) + """) AS BIGINT)
         AS task_thread_num,
       CAST(20 * row_number() OVER (PARTITION BY l_orderkey ORDER BY """ + ", ".join(F1_ORDER) + """) AS BIGINT)
         AS sequence_num
FROM lineitem""")
def number_tasks(spark, sf):
    """per-order numbering, step 20 (skew-safe bucketed numbering)."""
    l = _t(spark, sf, "lineitem")
    return WN.number_tasks(l, ["l_orderkey"], F1_ORDER, step=20).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "task_thread_num", "sequence_num")


@check("number_tasks_hot", """
SELECT event_type, event_id, ts, props,
       CAST(row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS BIGINT) AS task_thread_num,
       CAST(20 * row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS BIGINT) AS sequence_num
FROM events""")
def number_tasks_hot(spark, sf):
    """F1 on a few hot keys, with columns outside the order."""
    e = _t(spark, sf, "events").select("event_type", "event_id", "ts", "props")
    return WN.number_tasks(e, ["event_type"], ["ts", "event_id"], step=20, hot_key_rows=100)


CAP_SQL = "WITH " + M_SQL + """
SELECT topic, "partition", "offset", value FROM (
  SELECT *, row_number() OVER (PARTITION BY topic ORDER BY "partition", "offset") AS rn FROM m) WHERE rn <= 500"""


@check("cap_per_topic", CAP_SQL)
def cap_per_topic(spark, sf):
    """first 500 messages per topic, valid or not."""
    return WN.cap_per_topic(_messages(spark, sf), 500).select("topic", "partition", "offset", "value")


@check("page_chain", "WITH " + G_SQL + """
SELECT g.request_id, g.page_num, g.next_cursor FROM g LEFT JOIN g_end USING (request_id)
WHERE g.page_num <= 2 AND (g_end.end_page IS NULL OR g.page_num <= g_end.end_page)""")
def page_chain(spark, sf):
    """F3 with the default of 2 pages."""
    pages = fx.response_pages(_t(spark, sf, "pages"))
    p = pages.select("request_id", "page_num",
                     F.get_json_object("body", "$.meta.next_cursor").alias("next_cursor"))
    return WN.page_chain(p, max_pages=2)


# ---------------------------------------------------------------- 2.7 ordering


@check("order_by_step", """
SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100""")
def order_by_step(spark, sf):
    """G1: top 100 by (date, key)."""
    return AG.order_by_step(_t(spark, sf, "orders").select("o_orderkey", "o_orderdate"),
                            ["o_orderdate", "o_orderkey"], 100)


@check("first_row", """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1""")
def first_row(spark, sf):
    """Latest order."""
    return AG.first_row(_t(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice"),
                        [F.desc("o_orderdate"), F.desc("o_orderkey")])


@check("bounded_read", "WITH " + M_SQL + """
SELECT topic, "offset" FROM m ORDER BY "partition", "offset", topic LIMIT 1000""")
def bounded_read(spark, sf):
    """Global bound of 1000 messages in offset order."""
    return AG.bounded(_messages(spark, sf).select("topic", "partition", "offset"), 1000,
                      ["partition", "offset", "topic"]).select("topic", "offset")


# ---------------------------------------------------------------- 2.8 sets

STEPS_OF_EVENT = "CASE event_id % 4 WHEN 0 THEN 'E' WHEN 1 THEN 'TL' WHEN 2 THEN 'ETL' ELSE 'EL' END"


@check("step_rows", """
WITH j AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'E' WHEN 1 THEN 'TL' WHEN 2 THEN 'ETL' ELSE 'EL' END
           AS etl_steps FROM events)
SELECT event_id, etl_steps, 'E' AS etl_step FROM j WHERE etl_steps IN ('E', 'ETL')
UNION ALL SELECT event_id, etl_steps, 'T' FROM j WHERE etl_steps IN ('TL', 'ETL')
UNION ALL SELECT event_id, etl_steps, 'L' FROM j WHERE etl_steps IN ('TL', 'ETL')""")
def step_rows(spark, sf):
    """H1: E / TL / ETL expand to step rows; EL expands to none."""
    jobs = _t(spark, sf, "events").select("event_id", F.expr(STEPS_OF_EVENT).alias("etl_steps"))
    return AG.step_rows(jobs)


@check("same_topics", "WITH " + M_SQL + """,
capped AS (SELECT topic FROM (
  SELECT topic, row_number() OVER (PARTITION BY topic ORDER BY "partition", "offset") AS rn FROM m) WHERE rn <= 500),
finished AS (SELECT topic FROM capped GROUP BY topic HAVING count(*) >= 500)
SELECT NOT EXISTS (SELECT topic FROM m EXCEPT SELECT topic FROM finished)
   AND NOT EXISTS (SELECT topic FROM finished EXCEPT SELECT topic FROM m) AS same""")
def same_topics(spark, sf):
    """H2: the topics that reached the 500-message cap equal the assigned
    (seen) topics -- the consumer's stop rule."""
    msgs = _messages(spark, sf)
    finished = AG.count_by_topic(WN.cap_per_topic(msgs, 500)).filter(F.col("n_messages") >= 500)
    return AG.same_sets(msgs, finished, "topic")


# ---------------------------------------------------------------- 2.9 scalar functions


@check("split_table_name", """
SELECT n_nationkey,
       CASE n_nationkey % 3 WHEN 0 THEN 'dbo' ELSE 'sales' END AS schema_name, n_name AS table_name
FROM nation""")
def split_table_name(spark, sf):
    """1, 2 and 3 part names."""
    n = _t(spark, sf, "nation")
    name = (F.when(F.col("n_nationkey") % 3 == 0, F.col("n_name"))
             .when(F.col("n_nationkey") % 3 == 1, F.concat(F.lit("sales."), "n_name"))
             .otherwise(F.concat(F.lit("db"), F.col("n_regionkey").cast("string"), F.lit(".sales."), "n_name")))
    return n.select("n_nationkey", X.split_table_name(name).alias("p")).select("n_nationkey", "p.*")


@check("normalize_case", """
SELECT c_custkey, lower(trim(c_mktsegment)) AS seg_lower, upper(trim(lower(c_mktsegment))) AS seg_upper
FROM customer""")
def normalize_case(spark, sf):
    """I2."""
    c = _t(spark, sf, "customer")
    return c.select("c_custkey", X.normalize_lower("c_mktsegment").alias("seg_lower"),
                    X.normalize_upper(F.lower("c_mktsegment")).alias("seg_upper"))


@check("comma_list", """
SELECT event_id, event_type || '|x|y' AS items_joined, CAST(3 AS INTEGER) AS n_items FROM events""")
def comma_list(spark, sf):
    """I3: ' a , x,y ' -> [a, x, y]."""
    e = _t(spark, sf, "events")
    items = X.comma_list(F.concat(F.lit(" "), "event_type", F.lit(" , x,y ")))
    return e.select("event_id", F.array_join(items, "|").alias("items_joined"), F.size(items).alias("n_items"))


@check("contains_ci", "SELECT p_partkey, p_type FROM part WHERE p_type ILIKE '%all%'")
def contains_ci(spark, sf):
    """I4."""
    return _t(spark, sf, "part").filter(X.contains_ci("p_type", "ALL")).select("p_partkey", "p_type")


@check("concat_padded", """
SELECT c.c_custkey, c.c_name || ' / ' || n.n_name AS label, lpad(CAST(c.c_custkey AS VARCHAR), 10, ' ') AS padded
FROM customer c LEFT JOIN (SELECT * FROM nation WHERE n_regionkey = 1) n ON c.c_nationkey = n.n_nationkey""")
def concat_padded(spark, sf):
    """Null-propagating concat over a left join; width-10 number text."""
    c = _t(spark, sf, "customer")
    n = _t(spark, sf, "nation").filter(F.col("n_regionkey") == 1)
    j = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left")
    return j.select("c_custkey", X.concat_nullable("c_name", F.lit(" / "), "n_name").alias("label"),
                    X.str_padded("c_custkey").alias("padded"))


@check("str_wide", """
SELECT c_custkey, CASE WHEN length(CAST(CAST(v AS HUGEINT) AS VARCHAR)) > 10 THEN '**********'
                       ELSE lpad(CAST(CAST(v AS HUGEINT) AS VARCHAR), 10, ' ') END AS padded
FROM (SELECT c_custkey, CAST(round(CAST(c_acctbal * c_custkey * 997 AS DECIMAL(38, 6)), 0) AS DECIMAL(32, 0)) AS v FROM customer)""")
def str_wide(spark, sf):
    """STR rounds, and shows asterisks where a number is too long."""
    c = _t(spark, sf, "customer")
    return c.select("c_custkey", X.str_padded(F.col("c_acctbal") * F.col("c_custkey") * 997).alias("padded"))


@check("csv_real_text", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang FROM documents")
def csv_real_text(spark, sf):
    """A3 on whole document texts: quotes, newlines, four languages."""
    d = _t(spark, sf, "documents").select(F.col("doc_id").cast("string"), "text", "lang")
    path = FS.write_text_csv(d, new_path(spark, "csv-text"), encoding="UTF-8")
    return FS.read_csv_positional(spark, path, ["doc_id", "text", "lang"], multi_line=True)


@check("flat_file_real_text", """
SELECT doc_id, nullif(text, '') AS text, nullif(lang, '') AS lang, CAST(n_chars AS BIGINT) AS n_chars,
       CAST(42 AS INTEGER) AS job_inst_id, TIMESTAMP '2024-01-01 00:00:00' AS date_created FROM documents""")
def flat_file_real_text(spark, sf):
    """The flagship on whole document texts: quotes, quoted line breaks, four
    languages; the files stay splittable."""
    d = _t(spark, sf, "documents")
    csv = FS.write_text_csv(d.select("doc_id", "text", "lang", "n_chars"), new_path(spark, "documents-csv"), encoding="UTF-8")
    schema = T.StructType([T.StructField("doc_id", T.LongType(), False), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("n_chars", T.LongType())])
    target = new_path(spark, "dbo-documents")
    load_flat_file(spark, csv, schema, target, RUN_ID, RUN_TS, Constraints(primary_key=["doc_id"]), encoding="UTF-8")
    return spark.read.parquet(target)


@check("archive_runs", """
SELECT CASE WHEN c_custkey % 3 = 1 THEN 'error' ELSE 'processed' END AS folder, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(sum(c_custkey) AS BIGINT) AS keys, CAST(count(*) FILTER (WHERE c_custkey % 3 = 2) AS BIGINT) AS n_loaded_last
FROM customer GROUP BY 1""")
def archive_runs(spark, sf):
    """B7 over three runs in one landing folder, the second of which fails:
    each file is moved once, and what is archived stays."""
    cust = _customer_with_bad_balances(spark, sf)
    src, target = new_path(spark, "landing"), new_path(spark, "dbo-customer-runs")
    for k in range(3):
        bal = F.lit("n/a") if k == 1 else F.lit("1.5")
        (cust.where(F.col("c_custkey") % 3 == k).withColumn("c_acctbal", bal)
         .write.mode("append").option("header", True).csv(src))
        try:
            load_flat_file(spark, src, CUSTOMER, target, RUN_ID + k, RUN_TS, archive_files=True)
        except Exception:
            if k != 1:
                raise
    if SK.list_files(spark, src):
        raise ValueError("files are left in the landing folder")
    last = spark.read.parquet(target)
    parts = []
    for folder in ("processed", "error"):
        rows = (spark.read.schema("c_custkey bigint").option("header", True).option("recursiveFileLookup", True)
                .csv(f"{src}/{folder}"))
        found = rows.join(last.select(F.col("c_custkey").alias("k")), F.col("c_custkey") == F.col("k"), "left")
        parts.append(found.agg(F.lit(folder).alias("folder"), F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                               F.sum("c_custkey").cast("bigint").alias("keys"),
                               F.count("k").cast("bigint").alias("n_loaded_last")))
    return parts[0].unionByName(parts[1])


@check("csv_mixed_headers", """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, CASE WHEN doc_id % 3 = 1 THEN NULL ELSE lang END AS lang FROM documents""")
def csv_mixed_headers(spark, sf):
    """A4 over files with three headers: other orders, a missing and a further column."""
    d = _t(spark, sf, "documents")
    root = new_path(spark, "documents-mixed")
    for k, cols in enumerate((["doc_id", "text", "lang"], ["text", "doc_id"], ["source", "lang", "text", "doc_id"])):
        FS.write_text_csv(d.where(F.col("doc_id") % 3 == k).select(*cols), f"{root}/{k}", encoding="UTF-8")
    return FS.read_csv_files_by_header(spark, [f"{root}/{k}" for k in range(3)], ["doc_id", "text", "lang"], encoding="UTF-8")


@check("csv_field_counts", """
SELECT CASE WHEN doc_id % 5 = 0 THEN 'too many fields' WHEN doc_id % 5 = 1 THEN 'too few fields' END AS reason,
       CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN doc_id % 5 < 2 THEN 0 ELSE length(text) END) AS BIGINT) AS n_text
FROM documents GROUP BY 1""")
def csv_field_counts(spark, sf):
    """A4: records with a field too many or too few are kept apart, none is padded or cut."""
    d = _t(spark, sf, "documents").select("doc_id", "text", "lang")
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    fields = [F.col("doc_id").cast("string"), quoted(F.col("text"))]
    line = (F.when(F.col("doc_id") % 5 == 0, F.concat_ws(",", *fields, "lang", F.lit('"EX,TRA"')))
            .when(F.col("doc_id") % 5 == 1, F.concat_ws(",", *fields)).otherwise(F.concat_ws(",", *fields, "lang")))
    # files of one partition each, whose first line is the header
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = d.select(F.pmod("doc_id", F.lit(n)).alias("file"), F.lit(1).alias("place"), line.alias("value")).unionByName(
        spark.range(n).select(F.col("id").alias("file"), F.lit(0).alias("place"), F.lit("doc_id,text,lang").alias("value")))
    path = new_path(spark, "documents-ragged")
    (rows.repartition(n, "file").sortWithinPartitions("file", "place").select("file", "value")
     .write.partitionBy("file").text(path))
    rows = QT.read_records(spark, path, ["doc_id", "text", "lang"])
    return rows.groupBy(F.col(QT.REASON).alias("reason")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("bigint").alias("n_text"))


@check("thousands", """
SELECT r.r_name, CAST(count(*) AS BIGINT) AS n_customers, format('{:,}', count(*) * 1000) AS n_fmt
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name""")
def thousands(spark, sf):
    """FORMAT(n, 'n0') of customer counts (x1000) per region."""
    c, n, r = _t(spark, sf, "customer"), _t(spark, sf, "nation"), _t(spark, sf, "region")
    j = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey)
    g = j.groupBy("r_name").agg(F.count(F.lit(1)).cast("bigint").alias("n_customers"))
    return g.withColumn("n_fmt", X.thousands(F.col("n_customers") * 1000))


@check("time_formats", """
SELECT event_id, strftime(ts, '%Y_%m_%d') AS day_stamp, strftime(ts, '%Y%m%d_%H%M%S') AS file_stamp,
       strftime(ts, '%Y_%m_%d_%H_%M_%S') AS stage_stamp FROM events""")
def time_formats(spark, sf):
    """I7."""
    e = _t(spark, sf, "events")
    return e.select("event_id", TM.day_stamp("ts").alias("day_stamp"), TM.file_stamp("ts").alias("file_stamp"),
                    TM.stage_stamp("ts").alias("stage_stamp"))


@check("archive_names", """
WITH s AS (SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS seg FROM pages)
SELECT page_id,
       CASE WHEN page_id % 5 = 0 THEN 'err_' ELSE '' END
       || CASE WHEN regexp_matches(seg, '^(\\.*[^.].*)(\\.[^.]*)$')
               THEN regexp_extract(seg, '^(\\.*[^.].*)(\\.[^.]*)$', 1) || '_20240101_000000'
                    || regexp_extract(seg, '^(\\.*[^.].*)(\\.[^.]*)$', 2)
               ELSE seg || '_20240101_000000' END AS archive_name
FROM s""")
def archive_names(spark, sf):
    """I8: [err_]name_stamp.ext for each page url's last segment."""
    p = _t(spark, sf, "pages")
    return p.select("page_id", X.archive_file_name("url", F.lit("20240101_000000"),
                                                   F.col("page_id") % 5 == 0).alias("archive_name"))


@check("date_arith", """
SELECT o_orderkey, o_orderdate - INTERVAL 1 DAY AS prev_day,
       CASE WHEN o_orderstatus IN ('F', 'P') THEN o_orderdate END AS end_date
FROM orders""")
def date_arith(spark, sf):
    """Minus one day; end date only on a terminal status."""
    o = _t(spark, sf, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "succeeded").when(F.col("o_orderstatus") == "P", "failed") \
        .otherwise("running")
    return o.select("o_orderkey", TM.minus_days("o_orderdate").alias("prev_day"),
                    TM.end_date_on_terminal(status, "o_orderdate", F.lit(None).cast("timestamp_ntz")).alias("end_date"))


@check("smalldatetime", """
SELECT event_id, date_trunc('minute', ts + INTERVAL 30001 MILLISECOND) AS ts_minute FROM events""")
def smalldatetime(spark, sf):
    """I10."""
    return _t(spark, sf, "events").select("event_id", TM.to_smalldatetime("ts").alias("ts_minute"))


@check("json_default", """
SELECT event_id, json_extract_string(props, '$.k') AS k_value,
       coalesce(json_extract_string(props, '$.zz'), 'Key not found') AS zz_value FROM events""")
def json_default(spark, sf):
    """I11."""
    e = _t(spark, sf, "events")
    return e.select("event_id", J.json_value_or_default("props", "k").alias("k_value"),
                    J.json_value_or_default("props", "zz").alias("zz_value"))


@check("json_roundtrip", "SELECT event_id, event_type, value FROM events")
def json_roundtrip(spark, sf):
    """Serialise, re-parse field-wise."""
    e = _t(spark, sf, "events")
    j = e.select(J.to_json_record("event_id", "event_type", "value").alias("j"))
    return j.select(F.get_json_object("j", "$.event_id").cast("bigint").alias("event_id"),
                    F.get_json_object("j", "$.event_type").alias("event_type"),
                    F.get_json_object("j", "$.value").cast("double").alias("value"))


@check("topic_regex", "WITH " + M_SQL + """
SELECT DISTINCT topic, regexp_matches(topic, '^(?:test-.*)') AS m_prefix,
       regexp_matches(topic, '^(?:topic[12])') AS m_unanchored FROM m""")
def topic_regex(spark, sf):
    """Pattern anchored at the start only."""
    m = _messages(spark, sf)
    return m.select("topic", X.topic_matches("topic", "test-.*").alias("m_prefix"),
                    X.topic_matches("topic", "topic[12]").alias("m_unanchored")).distinct()


@check("log_order", """
SELECT o_orderkey,
       CASE o_orderstatus WHEN 'F' THEN 120 WHEN 'O' THEN 220 WHEN 'P' THEN 320 ELSE 0 END
       + CAST(o_orderkey % 20 AS INTEGER) AS log_order
FROM orders""")
def log_order(spark, sf):
    """Phase base + task offset."""
    o = _t(spark, sf, "orders")
    step = F.when(F.col("o_orderstatus") == "F", "e").when(F.col("o_orderstatus") == "O", "T") \
        .when(F.col("o_orderstatus") == "P", "L").otherwise("X")
    return o.select("o_orderkey", TM.log_order(step, (F.col("o_orderkey") % 20).cast("int")).cast("int").alias("log_order"))


# ---------------------------------------------------------------- 2.10 streaming


def _stream_setup(spark, sf, n_files=4):
    src = SC.write_message_files(_messages(spark, sf), new_path(spark, "msg-files"), n_files)
    return src, SC.IngestTargets(table=new_path(spark, "msg-table"), dlq=new_path(spark, "msg-dlq"),
                                 state=new_path(spark, "msg-state"), created=RUN_TS)


VALID_ROWS_SQL = "WITH " + M_SQL + """
SELECT topic, "partition", "offset", name, address, transaction_id, amount FROM m WHERE error_reason IS NULL"""


@check("consume_available", VALID_ROWS_SQL)
def consume_available(spark, sf):
    """S1 + B9: available-now file stream, validated rows in the table."""
    src, t = _stream_setup(spark, sf)
    SC.consume_available(SC.message_file_stream(spark, src), t, new_path(spark, "ckpt"))
    return spark.read.parquet(t.table).select("topic", "partition", "offset", "name", "address",
                                              "transaction_id", "amount")


@check("replay_vs_checkpoint", """
SELECT 'replay' AS mode, CAST(2 * count(*) AS BIGINT) AS n_rows FROM events WHERE event_id % 20 NOT IN (0, 1, 2, 5, 6)
UNION ALL
SELECT 'checkpoint', CAST(count(*) AS BIGINT) FROM events WHERE event_id % 20 NOT IN (0, 1, 2, 5, 6)""")
def replay_vs_checkpoint(spark, sf):
    """Two runs each -- replay reloads everything, checkpoint does not."""
    src, t = _stream_setup(spark, sf)
    ck = new_path(spark, "ckpt")
    t2 = SC.IngestTargets(table=new_path(spark, "msg-table2"), dlq=new_path(spark, "msg-dlq2"), created=RUN_TS)
    for _ in range(2):
        SC.consume(spark, src, t, replay=True)
        SC.consume(spark, src, t2, replay=False, checkpoint=ck)
    a = AG.row_count(spark.read.parquet(t.table)).select(F.lit("replay").alias("mode"), F.col("n_rows"))
    b = AG.row_count(spark.read.parquet(t2.table)).select(F.lit("checkpoint").alias("mode"), F.col("n_rows"))
    return a.unionByName(b)


@check("ingest_messages", "WITH " + M_SQL + """
SELECT topic, CAST(count(*) FILTER (WHERE error_reason IS NULL) AS BIGINT) AS n_loaded,
       CAST(count(*) FILTER (WHERE error_reason IS NOT NULL) AS BIGINT) AS n_dead FROM m GROUP BY topic""")
def ingest_messages(spark, sf):
    """S3: per micro-batch validate + route; table and DLQ totals."""
    src, t = _stream_setup(spark, sf)
    SC.consume_available(SC.message_file_stream(spark, src, max_files_per_trigger=2), t, new_path(spark, "ckpt"))
    a = spark.read.parquet(t.table).groupBy("topic").agg(F.count(F.lit(1)).cast("bigint").alias("n_loaded"))
    b = spark.read.parquet(t.dlq).groupBy(F.col("source_topic").alias("topic")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_dead"))
    return a.join(b, "topic", "full_outer").select(
        "topic", F.coalesce("n_loaded", F.lit(0)).alias("n_loaded"), F.coalesce("n_dead", F.lit(0)).alias("n_dead"))


@check("cap_per_topic_stream", "WITH " + M_SQL + """
SELECT topic, "partition", "offset" FROM (
  SELECT *, row_number() OVER (PARTITION BY topic ORDER BY "partition", "offset") AS rn FROM m) WHERE rn <= 500""")
def cap_per_topic_stream(spark, sf):
    """Per-topic cap carried across micro-batches (valid + rejected)."""
    src, t = _stream_setup(spark, sf)
    t.max_messages = 500
    SC.consume_available(SC.message_file_stream(spark, src), t, new_path(spark, "ckpt"))
    a = spark.read.parquet(t.table).select("topic", "partition", "offset")
    b = spark.read.parquet(t.dlq).select(F.col("source_topic").alias("topic"), "partition", "offset")
    return a.unionByName(b)


@check("cap_per_topic_multibatch", "WITH " + M_SQL + """
SELECT topic, "partition", "offset" FROM (
  SELECT *, row_number() OVER (PARTITION BY topic ORDER BY "partition", "offset") AS rn FROM m)
WHERE rn <= (SELECT count(*) FROM events) // 8""")
def cap_per_topic_multibatch(spark, sf):
    """S4 across micro-batches: 4 files (offset ranges) read one per
    trigger; the cap (1.5 files' worth per topic) is reached in the second
    batch and carried by the state table -- equal to the batch F2."""
    src, t = _stream_setup(spark, sf, n_files=4)
    t.max_messages = _t(spark, sf, "events").count() // 8
    SC.consume_available(SC.message_file_stream(spark, src, max_files_per_trigger=1), t, new_path(spark, "ckpt"))
    a = spark.read.parquet(t.table).select("topic", "partition", "offset")
    b = spark.read.parquet(t.dlq).select(F.col("source_topic").alias("topic"), "partition", "offset")
    return a.unionByName(b)


@check("batch_visibility", "WITH " + M_SQL + """, ok AS (SELECT * FROM m WHERE error_reason IS NULL)
SELECT 'n_rows' AS what, CAST(count(*) AS BIGINT) AS n FROM ok
UNION ALL SELECT 'n_rejects', CAST(count(*) AS BIGINT) FROM m WHERE error_reason IS NOT NULL
UNION ALL SELECT 'n_counted', CAST(count(*) AS BIGINT) FROM ok
UNION ALL SELECT 'n_written', CAST(2 * count(*) AS BIGINT) FROM ok""")
def batch_visibility(spark, sf):
    """A batch that was cut off between its writes isn't read."""
    src, t = _stream_setup(spark, sf)
    t.run_id = RUN_ID
    SC.consume_available(SC.message_file_stream(spark, src), t, new_path(spark, "ckpt"))
    spark.read.parquet(t.table).drop("batch_id").write.parquet(f"{t.table}/batch_id=1000000")
    rows, dead = SC.read_table(spark, t), SC.read_dead_letters(spark, t)
    count = lambda df, name: df.select(F.lit(name).alias("what"), F.lit(1).alias("n"))
    counted = SC.finished_batches(spark, t).select(F.lit("n_counted").alias("what"), F.col("rows").alias("n"))
    every = (count(rows, "n_rows").unionByName(count(dead, "n_rejects")).unionByName(counted)
             .unionByName(count(spark.read.parquet(t.table), "n_written")))
    return every.groupBy("what").agg(F.sum("n").cast("bigint").alias("n"))


CAP_RUN_SQL = "WITH " + M_SQL + """,
p AS (SELECT (SELECT count(*) FROM events) // 12 AS cap, (SELECT max("offset") FROM m) // 2 AS half),
n AS (SELECT topic, count(*) AS n_all, count(*) FILTER (WHERE "offset" < (SELECT half FROM p)) AS n_first
      FROM m GROUP BY topic),
l AS (SELECT topic, n_all, least(n_first, cap) + least(n_all - least(n_first, cap), cap) AS loaded, cap FROM n, p)
SELECT 'checkpoint' AS mode, topic, CAST(loaded AS BIGINT) AS n_loaded, CAST(n_all - loaded AS BIGINT) AS n_pending FROM l
UNION ALL SELECT 'replay', topic, CAST(2 * least(n_all, cap) AS BIGINT), CAST(0 AS BIGINT) FROM l"""


@check("cap_per_run", CAP_RUN_SQL)
def cap_per_run(spark, sf):
    """S2 + S4: two capped checkpointed runs with files landing between them,
    and two capped replays. Each run takes up to the cap of each topic; what
    a checkpointed run leaves is pending."""
    return _capped_runs(spark, sf, False)


@check("cap_per_run_ranges", CAP_RUN_SQL)
def cap_per_run_ranges(spark, sf):
    """The same with offsets in order: what is pending is a few ranges, read
    again from the landed messages."""
    return _capped_runs(spark, sf, True)


def _capped_runs(spark, sf, in_order):
    msgs, events = _messages(spark, sf), _t(spark, sf, "events")
    cap, half = events.count() // 12, msgs.agg(F.max("offset")).first()[0] // 2
    src, ck = new_path(spark, "msg-files"), new_path(spark, "ckpt")

    def targets():
        return SC.IngestTargets(table=new_path(spark, "msg-table"), dlq=new_path(spark, "msg-dlq"),
                                state=new_path(spark, "msg-state"), created=RUN_TS, max_messages=cap, in_order=in_order)

    def loaded(t):
        both = spark.read.parquet(t.table).select("topic").unionByName(
            spark.read.parquet(t.dlq).select(F.col("source_topic").alias("topic")))
        return both.groupBy("topic").agg(F.count(F.lit(1)).alias("n_loaded"))

    a, b = targets(), targets()
    for part in (msgs.filter(F.col("offset") < half), msgs.filter(F.col("offset") >= half)):
        part.write.mode("append").json(src)
        SC.consume(spark, src, a, checkpoint=ck)
    for _ in range(2):
        SC.consume(spark, src, b, replay=True)
    landed = spark.read.schema(MS.MESSAGE_SCHEMA).json(src) if in_order else None
    left = SC.pending_messages(spark, a, ck, landed).groupBy("topic").agg(F.count(F.lit(1)).alias("n_pending"))
    kept = loaded(a).join(left, "topic", "full_outer").select(
        F.lit("checkpoint").alias("mode"), "topic", F.coalesce("n_loaded", F.lit(0)).cast("bigint").alias("n_loaded"),
        F.coalesce("n_pending", F.lit(0)).cast("bigint").alias("n_pending"))
    return kept.unionByName(loaded(b).select(F.lit("replay").alias("mode"), "topic", "n_loaded",
                                             F.lit(0).cast("bigint").alias("n_pending")))


@check("micro_batch_options", "SELECT CAST(4 AS BIGINT) AS n_batches, CAST(count(*) AS BIGINT) AS n_rows FROM events")
def micro_batch_options(spark, sf):
    """maxFilesPerTrigger=1 over 4 message files -> 4 batches, all rows."""
    src, t = _stream_setup(spark, sf, n_files=4)
    SC.consume_available(SC.message_file_stream(spark, src, max_files_per_trigger=1), t, new_path(spark, "ckpt"))
    a = spark.read.parquet(t.table).select("batch_id")
    b = spark.read.parquet(t.dlq).select("batch_id")
    u = a.unionByName(b)
    return u.agg(F.count_distinct("batch_id").cast("bigint").alias("n_batches"),
                 F.count(F.lit(1)).cast("bigint").alias("n_rows"))


@check("reject_unparseable", "WITH " + M_SQL + """
SELECT topic AS source_topic, "offset", error_reason FROM m WHERE error_reason = 'Processing error'""")
def reject_unparseable(spark, sf):
    """Malformed messages go to the DLQ; the stream keeps going."""
    src, t = _stream_setup(spark, sf)
    SC.consume_available(SC.message_file_stream(spark, src), t, new_path(spark, "ckpt"))
    d = spark.read.parquet(t.dlq)
    return d.filter(F.col(REASON) == "Processing error").select("source_topic", "offset", REASON)


# ---------------------------------------------------------------- 2.11 procedures

procs.register("orders_by_status", """
SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n_orders, max(o_totalprice) AS max_price
FROM IDENTIFIER(:tbl) WHERE o_orderdate >= :since GROUP BY o_orderstatus""")


@check("run_sql", """
SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n_orders, max(o_totalprice) AS max_price
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' GROUP BY o_orderstatus""")
def run_sql(spark, sf):
    """A registered SQL transform with bound parameters."""
    _t(spark, sf, "orders").createOrReplaceTempView("orders_src")
    return procs.run_sql(spark, "orders_by_status", tbl="orders_src", since=datetime(1998, 1, 1))


@check("ingest_task", "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01 00:00:00'")
def ingest_task(spark, sf):
    """One task row drives read, shape, checks and load."""
    prepare(spark)
    orders = _t(spark, sf, "orders")
    task = {"conn_type": "parquet", "file_path": _path(sf, "orders"), "is_full_load": False,
            "incr_column": "o_orderdate", "incr_date": datetime(2000, 1, 1), "target_schema": orders.schema,
            "constraints": Constraints(not_null=["o_orderkey"], primary_key=["o_orderkey"])}
    df, _ = ingest(spark, task, new_path(spark, "ingest-target"))
    return df


@check("ingest_file_task", """
SELECT s_suppkey, s_name, CAST(s_nationkey AS INTEGER) AS s_nationkey, s_acctbal, CAST(NULL AS VARCHAR) AS s_phone,
       CAST(42 AS INTEGER) AS job_inst_id, TIMESTAMP '2024-01-01 00:00:00' AS date_created
FROM supplier""")
def ingest_file_task(spark, sf):
    """U2 with a delimited-file task: same rows as the direct A4 + C5 path."""
    prepare(spark)
    csv = FS.write_text_csv(_t(spark, sf, "supplier"), new_path(spark, "supplier-task"))
    task = {"conn_type": "file", "file_path": csv, "fields": SUPPLIER.fieldNames(), "target_schema": SUPPLIER,
            "is_full_load": True, "job_inst_id": RUN_ID, "run_ts": RUN_TS,
            "constraints": Constraints(not_null=["s_suppkey"], primary_key=["s_suppkey"])}
    df, _ = ingest(spark, task, new_path(spark, "ingest-file-target"))
    return df


@check("ingest_json_task", WORKS_SQL)
def ingest_json_task(spark, sf):
    """U2 with a JSON task: landed work pages read by schema."""
    prepare(spark)
    path = fx.write_work_pages(spark, _t(spark, sf, "documents"))
    task = {"conn_type": "json", "file_path": path, "schema": WORK, "is_full_load": True,
            "fields": ["id", "title", "publication_year", "cited_by_count"]}
    df, _ = ingest(spark, task)
    return df


@check("run_step_status", """
WITH dup AS (SELECT count(*) > count(DISTINCT l_orderkey) AS d FROM lineitem)
SELECT CAST(5 AS INTEGER) AS job_inst_id, CASE WHEN d THEN 'failed' ELSE 'succeeded' END AS last_status,
       d AS any_failed, CAST(4 AS BIGINT) AS n_entries, (SELECT CAST(count(*) AS BIGINT) FROM orders) AS orders_loaded
FROM dup""")
def run_step_status(spark, sf):
    """U2 + B11 + E4 + I14: an E step of two task rows (orders; lineitem
    with a primary key on l_orderkey), logged and folded."""
    prepare(spark)
    o_target = new_path(spark, "step-orders")
    tasks = [{"job_task_name": "orders", "etl_step": "E", "step_seq": 1, "conn_type": "parquet",
              "file_path": _path(sf, "orders"), "target_path": o_target},
             {"job_task_name": "lineitem", "etl_step": "E", "step_seq": 2, "conn_type": "parquet",
              "file_path": _path(sf, "lineitem"), "target_path": new_path(spark, "step-lineitem"),
              "constraints": Constraints(primary_key=["l_orderkey"])}]
    st = run_step(spark, tasks, 5, new_path(spark, "step-log"), RUN_TS)
    loaded = AG.row_count(spark.read.parquet(o_target)).select(F.col("n_rows").alias("orders_loaded"))
    return st.select("job_inst_id", "last_status", "any_failed", "n_entries",
                     loaded.scalar().alias("orders_loaded"))


@check("load_envelope", """
SELECT CAST(n.n_nationkey AS INTEGER) AS id, n.n_name AS name, CAST(1 AS INTEGER) AS page,
       CAST((SELECT count(*) FROM nation n2 WHERE n2.n_regionkey = r.r_regionkey) AS INTEGER) AS total,
       r.r_name AS support_url, 't' AS support_text,
       CAST(42 AS INTEGER) AS job_inst_id, TIMESTAMP '2024-01-01 00:00:00' AS date_created
FROM region r JOIN nation n ON n.n_regionkey = r.r_regionkey WHERE r.r_regionkey NOT IN (3, 4)""")
def load_envelope(spark, sf):
    """JSON -> raw -> dbo in one call, counts logged."""
    docs = fx.envelopes(_t(spark, sf, "region"), _t(spark, sf, "nation"))
    return procs.load_envelope(spark, docs, "body", RUN_ID, new_path(spark, "raw-env"), new_path(spark, "dbo-env"),
                               new_path(spark, "log-env"), RUN_TS)


@check("load_envelope_resource", """
SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS name, CAST(2000 + p_partkey % 25 AS INTEGER) AS year,
       p_brand AS color, p_type AS pantone_value, CAST(p_partkey // 10 AS INTEGER) AS page,
       CAST(10 AS INTEGER) AS per_page, CAST(count(*) OVER (PARTITION BY p_partkey // 10) AS INTEGER) AS total,
       CAST(1 AS INTEGER) AS total_pages, 'https://support' AS support_url,
       'page ' || CAST(p_partkey // 10 AS VARCHAR) AS support_text,
       CAST(42 AS INTEGER) AS job_inst_id, TIMESTAMP '2024-01-01 00:00:00' AS date_created
FROM part WHERE (p_partkey // 10) % 7 <> 0""")
def load_envelope_resource(spark, sf):
    """The three-way resource load, raw and dbo."""
    docs = fx.resource_envelopes(_t(spark, sf, "part"))
    return procs.load_resources(spark, docs, "body", RUN_ID, new_path(spark, "raw-res"), new_path(spark, "dbo-res"),
                                new_path(spark, "log-res"), RUN_TS)


def _catalog_step(spark, conn_type: str, target: str, schema: T.StructType | None = None, path: str | None = None,
                  job_type: str = "etl", kafka: tuple | None = None, max_pages: int | None = None,
                  more: dict | None = None) -> tuple[dict, DataFrame]:
    """A run step of one task that starts from rows of the metadata tables:
    the task and the step's status."""
    prepare(spark)
    df = spark.createDataFrame
    md = Metadata(
        job_inst_task=df([(1, RUN_ID, 100, "not started")],
                         "job_inst_task_id int, job_inst_id int, job_task_id int, task_status string"),
        job_task=df([(100, 1, f"{conn_type} task", "E", 1, conn_type, None, 2, 1, 1, 1, None)],
                    "job_task_id int, job_id int, job_task_name string, etl_step string, step_seq int, conn_type string, "
                    "src_tbl_id int, tgt_tbl_id int, conn_str_id int, conn_api_id int, conn_kafka_id int, "
                    "sql_script_id int"),
        job_inst=df([(RUN_ID, 1, "E", True, False)],
                    "job_inst_id int, job_id int, etl_steps string, is_full_load boolean, del_temp_data boolean"),
        job=df([(1, job_type)], "job_id int, job_type string"),
        tbl=df([(2, target, None, None, None)], "tbl_id int, fully_qualified_tbl_name string, incr_date timestamp_ntz, "
                                                "incr_column string, data_size string"),
        conn_str=df([(1, "landing", None, None, None, path)], "conn_str_id int, conn_str_name string, conn_str string, "
                                                              "username string, pass string, file_path string"),
        conn_api=df([(1, None, 1, "api", None, None, None, False, None, None, None, None, None, max_pages, path, None)],
                    "conn_api_id int, parent_conn_api_id int, data_source_id int, conn_api_name string, api_url string, "
                    "username string, pass string, need_token boolean, payload_json string, page_param_name string, "
                    "page_size int, cursor_param_name string, cursor_path string, max_pages int, "
                    "output_file_path string, chunk_size int"),
        conn_kafka=df([(1, *(kafka or (None,) * 6), None)],
                      "conn_kafka_id int, topic string, topic_pattern string, group_id string, is_consumer boolean, "
                      "batch_record_size int, max_message_num int, bootstrap_servers string"),
        sql_script=df([], "sql_script_id int, sql_text string, is_stored_proc boolean"),
        data_source=df([(1, "landing")], "data_source_id int, data_source_name string"))
    catalog = task_catalog_for(md, RUN_ID, "E", run_ts=RUN_TS)
    task = tasks_from_catalog(catalog, new_path(spark, "warehouse"), {target: schema} if schema else None)[0]
    task |= more or {}
    status = run_step(spark, [task], RUN_ID, new_path(spark, "step-log"), RUN_TS)
    return task, status


def _with_status(out: DataFrame, status: DataFrame) -> DataFrame:
    return out.withColumn("last_status", status.select("last_status").scalar())


@check("step_file_task", """
SELECT s_suppkey, s_name, CAST(s_nationkey AS INTEGER) AS s_nationkey, s_acctbal, CAST(NULL AS VARCHAR) AS s_phone,
       CAST(42 AS INTEGER) AS job_inst_id, TIMESTAMP '2024-01-01 00:00:00' AS date_created,
       'succeeded' AS last_status, true AS all_archived
FROM supplier""")
def step_file_task(spark, sf):
    """U2 + B7: a file task from the catalog; its input files are archived."""
    csv = FS.write_text_csv(_t(spark, sf, "supplier"), new_path(spark, "supplier-step"))
    before = len(SK.list_files(spark, csv))
    task, status = _catalog_step(spark, "file", "raw.supplier", SUPPLIER, csv)
    archived = len(SK.list_files(spark, f"{csv}/processed")) if SK.path_exists(spark, f"{csv}/processed") else 0
    return (_with_status(spark.read.parquet(task["target_path"]), status)
            .withColumn("all_archived", F.lit(archived == before > 0 and not SK.list_files(spark, csv))))


@check("step_json_task", "SELECT *, CAST(42 AS INTEGER) AS job_inst_id, 'succeeded' AS last_status FROM ("
       + WORKS_SQL + ")")
def step_json_task(spark, sf):
    """A JSON task from the catalog."""
    path = fx.write_work_pages(spark, _t(spark, sf, "documents"))
    task, status = _catalog_step(spark, "json", "raw.works", T.StructType(WORK.fields[:4]), path)
    return _with_status(spark.read.parquet(task["target_path"]).drop("date_created"), status)


@check("step_api_task", "WITH " + G_SQL + """
SELECT g.page_id AS id, g.url AS title, CAST(42 AS INTEGER) AS job_inst_id, 'succeeded' AS last_status
FROM g LEFT JOIN g_end USING (request_id)
WHERE g.page_num <= 8 AND (g_end.end_page IS NULL OR g.page_num <= g_end.end_page)""")
def step_api_task(spark, sf):
    """An API task from the catalog over landed pages."""
    landed = new_path(spark, "landed-pages")
    fx.response_pages(_t(spark, sf, "pages")).write.json(landed)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("title", T.StringType())])
    task, status = _catalog_step(spark, "api", "raw.pages", schema, landed, max_pages=8)
    return _with_status(spark.read.parquet(task["target_path"]).drop("date_created"), status)


@check("step_consumer_task", "WITH " + M_SQL + """
SELECT topic, "partition", "offset", error_reason, 'succeeded' AS last_status FROM m
WHERE topic IN ('test-topic1', 'test-topic2')""")
def step_consumer_task(spark, sf):
    """U2 + S1-S4: a consumer task from the catalog: valid rows and dead
    letters of the topics that fit its pattern."""
    src = SC.write_message_files(_messages(spark, sf), new_path(spark, "msg-step"), 4)
    task, status = _catalog_step(spark, "kafka", "raw.messages", path=src,
                                 kafka=("test-topic1", '{"pattern": "test-topic[12]"}', "step-group", True, 100, None))
    good = spark.read.parquet(task["target_path"]).select("topic", "partition", "offset",
                                                          F.lit(None).cast("string").alias(REASON))
    bad = spark.read.parquet(f"{task['target_path']}_dlq").select(F.col("source_topic").alias("topic"), "partition",
                                                                  "offset", REASON)
    return _with_status(good.unionByName(bad), status)


@check("step_producer_task", """
SELECT t.topic, CAST(count(*) AS BIGINT) AS n_messages, CAST(count(*) AS BIGINT) AS n_distinct_ids,
       'succeeded' AS last_status
FROM events, (SELECT 'topic1' AS topic UNION ALL SELECT 'topic2' UNION ALL SELECT 'topic3') t
GROUP BY t.topic""")
def step_producer_task(spark, sf):
    """U2 + A11 + B10: a producer task from the catalog, landed and read back."""
    task, status = _catalog_step(spark, "kafka", "out.messages", job_type="non-etl",
                                 kafka=("topic1", None, None, False, 100, None),
                                 more={"ids": _t(spark, sf, "events").select("event_id")})
    sent = spark.read.schema("topic string, value string").json(task["target_path"])
    return _with_status(sent.groupBy("topic").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_messages"),
        F.count_distinct(F.get_json_object("value", "$.transaction_id")).cast("bigint").alias("n_distinct_ids")), status)
