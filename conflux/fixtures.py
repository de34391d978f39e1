"""Derived inputs built by Spark from the driver's tables.

The ingestion operators consume message streams, paged API responses and
JSON documents. None of those ship as tables, so they are derived here from
the given tables by fixed rules; the same rules are written in SQL for the
DuckDB oracle. All derivations are narrow (row-wise) except the grouping of
records into pages, whose groups are bounded by construction (``page_size``
consecutive ids per page).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .session import new_path, spread

# Fixed values of the message fixture (topic family and the seven special
# record shapes selected by event_id % 20).
TOPIC_PREFIX = "test-topic"
N_TOPICS = 3


def _amount(value: Column) -> Column:
    return F.floor(value * 100).cast("bigint")


def messages(events: DataFrame) -> DataFrame:
    """Kafka-shaped frame ``(topic, partition, offset, timestamp, key, value)``
    from ``events``; ``value`` is JSON text of a transaction record."""
    eid = F.col("event_id")
    k = eid % 20
    good = F.to_json(F.struct(
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("name"),
        F.col("event_type").alias("address"),
        eid.cast("string").alias("transaction_id"),
        _amount(F.col("value")).alias("amount")))
    no_name = F.to_json(F.struct(F.col("event_type").alias("address"),
                                 _amount(F.col("value")).alias("amount")))
    value = (F.when(k == 0, F.lit('{"name":null,"amount":1}'))
              .when(k == 1, F.lit('{"name":"a","address":""}'))
              .when(k == 2, F.lit('{"name":"a","transaction_id":[]}'))
              .when(k == 3, no_name)
              .when(k == 4, F.lit('{"name":"z","amount":0}'))
              .when(k == 5, F.lit('{bad'))
              .when(k == 6, F.lit('[1]'))
              .otherwise(good))
    return spread(events).select(
        F.concat(F.lit(TOPIC_PREFIX), (eid % N_TOPICS + 1).cast("string")).alias("topic"),
        F.lit(0).alias("partition"),
        F.expr(f"event_id div {N_TOPICS}").cast("bigint").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.lit(None).cast("string").alias("key"),
        value.alias("value"))


def response_pages(pages: DataFrame) -> DataFrame:
    """Landed cursor-paged API responses ``(request_id, page_num, body)``."""
    pid = F.col("page_id")
    cursor = F.when(pid % 7 == 6, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("c"), pid.cast("string")))
    body = F.to_json(
        F.struct(F.struct(cursor.alias("next_cursor")).alias("meta"),
                 F.array(F.struct(pid.alias("id"), F.col("url").alias("title"))).alias("results")),
        {"ignoreNullFields": "false"})
    return spread(pages).select(F.expr("page_id div 10").cast("bigint").alias("request_id"),
                        (pid % 10 + 1).cast("int").alias("page_num"),
                        body.alias("body"))


def cursor_pages(pages: DataFrame) -> DataFrame:
    """Landed responses with the cursor each was fetched with
    (``request_id, cursor, body``), made of whole pages: up to eight pages a
    request (``page_id div 8``), whose results are the page and one more element.

    By ``page_id``: ``% 7 = 6`` ends its chain, ``% 29 = 11`` isn't landed,
    ``% 17 = 2`` is landed twice, ``% 31 = 8`` leads back to the first cursor;
    the second element is a string (``% 5 = 1``), has an id that isn't a
    number (``% 5 = 2``), or is good."""
    pid, place = F.col("page_id"), F.col("page_id") % 8
    name = lambda x: F.concat(F.lit("c"), x.cast("string"))
    cursor = F.when(place == 0, F.lit("*")).otherwise(name(pid))
    nxt = F.when((pid % 7 == 6) | (place == 7), F.lit(None).cast("string")).when(pid % 31 == 8, F.lit("*")).otherwise(name(pid + 1))
    first = F.to_json(F.struct(pid.alias("id"), F.col("url").alias("title"), F.col("html").alias("html")))
    second = (F.when(pid % 5 == 1, F.lit('"oops"')).when(pid % 5 == 2, F.concat(F.lit('{"id":"x'), pid.cast("string"), F.lit('"}')))
              .otherwise(F.concat(F.lit('{"id":'), (-pid).cast("string"), F.lit("}"))))
    meta = F.to_json(F.struct(F.struct(nxt.alias("next_cursor")).alias("meta")), {"ignoreNullFields": "false"})
    body = F.concat(F.expr("substring(meta, 1, length(meta) - 1)"), F.lit(',"results":['), "first", F.lit(","), "second", F.lit("]}"))
    times = F.when(pid % 29 == 11, 0).when(pid % 17 == 2, 2).otherwise(1)
    return (spread(pages).select(F.expr("page_id div 8").cast("bigint").alias("request_id"), cursor.alias("cursor"),
                                 meta.alias("meta"), first.alias("first"), second.alias("second"),
                                 F.explode(F.sequence(F.lit(0), times)).alias("again")).where("again > 0")
            .select("request_id", "cursor", body.alias("body")))


def work_records(documents: DataFrame) -> DataFrame:
    """One JSON work record per document (``doc_id``, ``record``).

    ``primary_location`` takes four shapes by ``doc_id % 4``: an object,
    ``null``, the object inside an array, and absent."""
    did = F.col("doc_id")
    base = F.to_json(F.struct(
        F.concat(F.lit("W"), did.cast("string")).alias("id"),
        F.col("source").alias("title"),
        (F.lit(2000) + did % 25).cast("int").alias("publication_year"),
        F.col("n_chars").alias("cited_by_count")))
    loc = F.to_json(F.struct(F.struct(F.col("lang").alias("display_name")).alias("source")))
    shape = did % 4
    loc_part = (F.when(shape == 0, F.concat(F.lit(',"primary_location":'), loc))
                 .when(shape == 1, F.lit(',"primary_location":null'))
                 .when(shape == 2, F.concat(F.lit(',"primary_location":['), loc, F.lit("]")))
                 .otherwise(F.lit("")))
    # splice the location into the object: drop the closing brace, append
    return (spread(documents).select("doc_id", base.alias("base"), loc_part.alias("loc"))
            .select("doc_id", F.concat(F.expr("substring(base, 1, length(base) - 1)"),
                                       F.col("loc"), F.lit("}")).alias("record")))


def write_work_pages(spark, documents: DataFrame, page_size: int = 100) -> str:
    """Land the work records as files of JSON-array pages (one array per
    line, ``page_size`` consecutive doc ids per page, as an API returns
    them). Returns the folder."""
    path = new_path(spark, "works")
    (work_records(documents)
     .groupBy(F.expr(f"doc_id div {int(page_size)}").alias("page"))
     .agg(F.concat(F.lit("["), F.array_join(F.collect_list("record"), ","), F.lit("]")).alias("value"))
     .select("value")
     .write.text(path))
    return path


def envelopes(region: DataFrame, nation: DataFrame) -> DataFrame:
    """One response envelope per region (``region_id``, ``body``): ``data``
    lists the region's nations, ``support`` names the region. Region 3 has
    an empty ``data``; region 4 has no ``support``. Each ``collect_list``
    group is one region's nations: bounded by the fixed-size nation
    dimension (25 rows), like one API response page."""
    grouped = (nation.groupBy("n_regionkey")
               .agg(F.collect_list(F.struct(F.col("n_nationkey").alias("id"),
                                            F.col("n_name").alias("name"))).alias("data"),
                    F.count(F.lit(1)).alias("total")))
    j = region.join(grouped, region.r_regionkey == grouped.n_regionkey, "left")
    rk = F.col("r_regionkey")
    data = F.when(rk == 3, F.filter(F.col("data"), lambda x: F.lit(False))).otherwise(F.col("data"))
    support = F.when(rk == 4, F.lit(None)).otherwise(
        F.struct(F.col("r_name").alias("url"), F.lit("t").alias("text")))
    body = F.to_json(F.struct(F.lit(1).alias("page"), F.coalesce(F.col("total"), F.lit(0)).alias("total"),
                              F.coalesce(data, F.array()).alias("data"), support.alias("support")))
    return j.select(rk.alias("region_id"), body.alias("body"))


def resource_envelopes(part: DataFrame) -> DataFrame:
    """One resource page for each run of ten part keys (``page_num``,
    ``body``). Every seventh page has no ``support``. A ``collect_list``
    group holds ten parts at most, like one API response page."""
    key, page = F.col("p_partkey"), F.expr("p_partkey div 10")
    item = F.struct(key.alias("id"), F.col("p_name").alias("name"), (F.lit(2000) + key % 25).alias("year"),
                    F.col("p_brand").alias("color"), F.col("p_type").alias("pantone_value"))
    pages = (part.groupBy(page.cast("int").alias("page_num"))
             .agg(F.collect_list(item).alias("data"), F.count(F.lit(1)).alias("total")))
    support = F.when(F.col("page_num") % 7 != 0, F.struct(F.lit("https://support").alias("url"),
                                                          F.concat(F.lit("page "), F.col("page_num")).alias("text")))
    return pages.select("page_num", F.to_json(F.struct(
        F.col("page_num").alias("page"), F.lit(10).alias("per_page"), "total", F.lit(1).alias("total_pages"),
        "data", support.alias("support"))).alias("body"))


def run_log(events: DataFrame) -> DataFrame:
    """Append-only run log from ``events``: run = ``user_id``; ``view`` is a
    ``running`` entry, ``purchase`` ``succeeded``, ``error`` ``failed``;
    other event types are informational entries without a status."""
    et = F.col("event_type")
    status = (F.when(et == "view", "running").when(et == "purchase", "succeeded")
               .when(et == "error", "failed"))
    return events.select(
        F.col("user_id").alias("job_inst_id"),
        F.col("event_id").alias("logging_seq"),
        F.col("ts").alias("log_ts"),
        et.alias("task_name"),
        status.alias("task_status"),
        F.col("props").alias("error_msg"),
        (et == "error").alias("is_error"))
