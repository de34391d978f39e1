"""Message-stream sources.

Every message operator works on a *Kafka-shaped* frame ``(topic,
partition, offset, timestamp, key, value)`` with ``value`` as text, so the
same code runs over the Kafka connector (batch or stream), a JSON-lines
file stream, or a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.text import topic_matches
from ..functions.timefmt import synthetic_digits, synthetic_id

MESSAGE_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])


def kafka_source(spark: SparkSession, bootstrap_servers: str, pattern: str,
                 streaming: bool = True, max_offsets_per_trigger: int | None = None) -> DataFrame:
    """A10: subscribe by topic regex, anchored at the start only as in
    :func:`subscribe`, from the earliest offsets; value as text. Needs the spark-sql-kafka connector on the classpath."""
    r = spark.readStream if streaming else spark.read
    r = (r.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
          .option("subscribePattern", f"(?:{pattern}).*").option("startingOffsets", "earliest"))
    if streaming and max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load().select(
        "topic", "partition", "offset", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def subscribe(msgs: DataFrame, pattern: str) -> DataFrame:
    """The messages of topics matching ``pattern`` (anchored at
    the start, like a consumer's pattern subscription)."""
    return msgs.filter(topic_matches(F.col("topic"), pattern))


def generate_messages(ids: DataFrame, id_col: str, n_topics: int = 3,
                      topic_prefix: str = "topic", seed: int = 42) -> DataFrame:
    """Synthetic ``{name, address, transaction_id, amount}`` records --
    one per input id **in each** of ``topic1..topicN`` (so every topic gets
    as many messages as there are ids, the generator's message count).
    Reproducible (seeded hashes instead of random values); ``amount`` has
    at most 5 digits. Output is Kafka-shaped with the record as JSON text;
    the offset within a topic is the id."""
    base = ids.select(F.col(id_col).alias("_i"),
                      F.explode(F.sequence(F.lit(1), F.lit(n_topics))).alias("_k"))
    key = F.concat_ws(":", F.col("_i").cast("string"), F.col("_k").cast("string"))
    name = F.concat(F.lit("name-"), F.lower(F.hex(F.xxhash64(key, F.lit(seed)))).substr(1, 8))
    address = F.concat(synthetic_digits(key, seed + 1, 4).cast("string"), F.lit(" Main St"))
    amount = synthetic_digits(key, seed + 2, 5)
    record = F.to_json(F.struct(name.alias("name"), address.alias("address"),
                                synthetic_id(key, seed).alias("transaction_id"), amount.alias("amount")))
    return base.select(
        F.concat(F.lit(topic_prefix), F.col("_k").cast("string")).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("_i").cast("bigint").alias("offset"),
        F.lit(None).cast("timestamp_ntz").alias("timestamp"),
        F.lit(None).cast("string").alias("key"),
        record.alias("value"),
        amount.alias("amount"))
