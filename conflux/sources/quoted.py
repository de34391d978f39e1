"""Delimited text with quoted line breaks, read in parallel (A3, A4).

A quoted field may hold line breaks, so a reader that starts in the middle of
a file can't tell whether the next line break ends a record; reading such
files with ``multiLine`` makes each file one task. Here they stay splittable:

1. One scan notes for every byte range of every file whether it holds an odd
   or an even number of quotes, and the first line of each file (its header).
   Only these rows are shuffled. The running parity over a file's ranges says
   which of the two places where records could start is the right one.
2. A second scan cuts records. In ranges that start outside quotes and where
   every line has an even number of quotes, each line is a record; these rows
   are not shuffled. The lines of the other ranges are numbered within their
   range and joined to records; what begins in one range and ends in another
   is put together from its parts.

Each file is read by its own header: the table of headers is joined to the
ranges, never looked up file by file. A record with another number of fields
than its header, or with a quote that is never closed, isn't padded or cut: it
is an error, or is kept apart with a reason.

Quotes are as in RFC 4180: around a whole field, doubled inside it. Encodings
in which quotes and line breaks are single ASCII bytes work. A header lies on
one line.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..session import new_path

#: Why a record was kept apart (null: it wasn't), and its text.
REASON, RECORD = "_reject_reason", "_record"
TOO_MANY, TOO_FEW, UNCLOSED = "too many fields", "too few fields", "unclosed quote"
#: Different headers a set of files may have; they make up the plan.
MOST_LAYOUTS = 1000


def _odd_quotes(text: str) -> Column:
    q = F.lit('"')
    return F.when(F.contains(F.col(text), q),
                  (F.length(text) - F.length(F.replace(F.col(text), q, F.lit("")))) % 2).otherwise(0).cast("long")


def _lines(spark: SparkSession, path: str | list[str], encoding: str) -> DataFrame:
    """(file, range, id, value): every line with the byte range it was read
    in; ids rise within a range."""
    raw = spark.read.option("lineSep", "\n").text(path)
    value = F.col("value")
    if encoding.upper().replace("-", "") != "UTF8":
        value = F.decode(value.cast("binary"), encoding)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
                      F.monotonically_increasing_id().alias("id"), value.alias("value"))


def _ranges(lines: DataFrame) -> DataFrame:
    """(file, range, inside, odd, head_id, header): whether a range starts
    inside quotes, whether any of its lines has an odd number of quotes, and its
    file's header."""
    head = F.when((F.col("range") == 0) & (F.trim(F.regexp_replace("value", "^﻿|\r$", "")) != ""),
                  F.struct("id", "value"))
    odd = _odd_quotes("value")
    # the set, an aggregate over objects, keeps this a hash aggregate though it holds a text
    seen = lines.groupBy("file", "range").agg(F.sum(odd).alias("odd"), F.min(head).alias("head"),
                                              F.collect_set(F.lit(0)).alias("_"))
    along = Window.partitionBy("file").orderBy("range")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    return seen.select("file", "range", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).alias("inside"),
                       (F.col("odd") > 0).alias("odd"), F.first("head", True).over(along).alias("head")).select(
        "file", "range", "inside", "odd", F.col("head.id").alias("head_id"),
        F.regexp_replace("head.value", "^﻿|\r$", "").alias("header"))


def _layouts(ranges: DataFrame, sep: str) -> dict[str, list[str]]:
    """The names of each different header."""
    rows = ranges.where("header IS NOT NULL").select("header").distinct().limit(MOST_LAYOUTS + 1).collect()
    if len(rows) > MOST_LAYOUTS:
        raise ValueError(f"more than {MOST_LAYOUTS} different headers")
    for r in rows:
        if r.header.count('"') % 2:
            raise ValueError(f"a header goes on over a line break: {r.header[:200]}")
    return {r.header: next(csv.reader([r.header], delimiter=sep)) for r in rows}


def _whole_records(lines: DataFrame) -> DataFrame:
    """(file, id, record) of the ranges where lines aren't records."""
    along = Window.partitionBy("file", "range").orderBy("id")
    odd = _odd_quotes("value")
    opened = (F.col("inside") + F.coalesce(F.sum(odd).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) % 2
    numbered = (lines.withColumn("begins", (opened == 0).cast("long")).withColumn("odd_line", odd)
                .withColumn("number", F.sum("begins").over(along.rowsBetween(Window.unboundedPreceding, 0))))
    text = lambda parts: F.array_join(F.transform(F.array_sort(parts), lambda x: x["text"]), "\n")
    parts = (numbered.groupBy("file", "range", "number")
             .agg(text(F.collect_list(F.struct("id", F.col("value").alias("text")))).alias("text"),
                  F.min("id").alias("id"), (F.sum("odd_line") % 2 == 1).alias("odd")))
    # number 0 goes on from the range before; an odd record goes on in the next one
    whole = parts.where("number > 0 AND NOT odd").select("file", "id", F.col("text").alias("record"))
    pieces = (parts.where("number = 0 OR odd")
              .withColumn("of", F.sum(F.when(F.col("number") > 0, 1).otherwise(0))
                          .over(Window.partitionBy("file").orderBy("range", "number"))))
    joined = (pieces.groupBy("file", "of")
              .agg(text(F.collect_list(F.struct("range", "number", "text"))).alias("record"),
                   F.min_by("id", F.struct("range", "number")).alias("id")))
    return whole.unionByName(joined.select("file", "id", "record"))


def read_records(spark: SparkSession, path: str | list[str], fields: Sequence[str], sep: str = ",",
                 encoding: str = "UTF-8", by_position: bool = False) -> DataFrame:
    """The records of delimited files, ``fields`` as text, with the columns
    ``_reject_reason`` (null for a good record) and ``_record`` (the text of a
    bad one, whose fields are null).

    Fields are taken by each file's header, whose names match without regard
    to case; one that a file doesn't have is null. With ``by_position`` the
    header is only skipped and the i-th field is the i-th of ``fields``."""
    lines = _lines(spark, path, encoding)
    stage = new_path(spark, "csv-ranges")
    _ranges(lines).write.parquet(stage)
    ranges = spark.read.parquet(stage)          # a row for each byte range
    layouts = _layouts(ranges, sep)
    if not layouts:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType())
                                                       for c in (*fields, REASON, RECORD)]))
    side = ranges.select(F.col("file").alias("_file"), F.col("range").alias("_range"), "inside", "odd", "head_id",
                         "header", F.lit(True).alias("known"))
    found = lines.join(side, (F.col("file") == F.col("_file")) & (F.col("range") == F.col("_range")), "left")
    # both scans have to split files alike
    found = found.where(F.when(F.col("known"), True)
                        .otherwise(F.raise_error(F.lit("a file changed, or was split another way, between two scans"))
                                   .cast("boolean")))
    single = found.where("inside = 0 AND NOT odd").select("file", "id", F.col("value").alias("record"), "head_id", "header")
    if not ranges.where("inside = 1 OR odd").isEmpty():
        heads = ranges.groupBy(F.col("file").alias("_file")).agg(F.max("head_id").alias("head_id"),
                                                                F.max("header").alias("header"))
        several = _whole_records(found.where("inside = 1 OR odd"))
        single = single.unionByName(several.join(heads, F.col("file") == F.col("_file"))
                                    .select("file", "id", "record", "head_id", "header"))
    records = (single.where("head_id IS NULL OR id <> head_id")
               .withColumn("record", F.regexp_replace("record", "\r$", "")).where("record <> ''"))
    return _parsed(records, layouts, fields, sep, by_position)


def _parsed(records: DataFrame, layouts: dict[str, list[str]], fields: Sequence[str], sep: str,
            by_position: bool) -> DataFrame:
    width = max(len(fields), *map(len, layouts.values()))
    schema = ", ".join(f"c{i} string" for i in range(width))
    doc = F.from_csv(F.col("record"), schema, {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    # separators outside quotes; a doubled quote ends one quoted run and starts another
    bare = F.when(F.contains(F.col("record"), F.lit('"')), F.regexp_replace("record", '"[^"]*"', "")).otherwise(F.col("record"))
    n = (F.length("bare") - F.length(F.replace(F.col("bare"), F.lit(sep), F.lit("")))) / len(sep) + 1

    def of(choose):
        """An expression by layout."""
        if by_position or len(layouts) == 1:
            return choose(list(fields) if by_position else next(iter(layouts.values())))
        out = None
        for header, names in sorted(layouts.items()):
            is_it = F.col("header") == header
            out = F.when(is_it, choose(names)) if out is None else out.when(is_it, choose(names))
        return out

    def place(name, names):
        at = next((i for i, c in enumerate(names) if c.strip().lower() == name.lower()), None)
        return F.lit(None).cast("string") if at is None else F.col(f"doc.c{at}")

    wide = of(lambda names: F.lit(len(names)))
    reason = (F.when(_odd_quotes("record") == 1, UNCLOSED).when(F.col("n") > F.col("wide"), TOO_MANY)
              .when(F.col("n") < F.col("wide"), TOO_FEW))
    rows = (records.withColumn("bare", bare).withColumn("n", n.cast("long")).withColumn("wide", wide)
            .withColumn(REASON, reason).withColumn("doc", F.when(F.col(REASON).isNull(), doc)))
    return rows.select(*[of(lambda names, c=c: place(c, names)).alias(c) for c in fields], REASON,
                       F.when(F.col(REASON).isNotNull(), F.col("record")).alias(RECORD))


def strict(records: DataFrame) -> DataFrame:
    """The records of :func:`read_records`; a bad one is an error."""
    text = F.concat(F.col(REASON), F.lit(": "), F.substring(RECORD, 1, 200))
    # an id isn't below 0, but it keeps the test where it is: pushed down, it would see lines that aren't records
    ok = F.when(F.col(REASON).isNull(), F.monotonically_increasing_id() >= 0).otherwise(F.raise_error(text).cast("boolean"))
    return records.where(ok).drop(REASON, RECORD)


def split(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The good records, and (_reject_reason, _record) of the others."""
    return (records.where(F.col(REASON).isNull()).drop(REASON, RECORD),
            records.where(F.col(REASON).isNotNull()).select(REASON, RECORD))
