"""File sources: delimited text, Parquet and JSON documents.

Every reader takes an explicit schema or reads text as text: nothing is
inferred, so a plan never scans a file twice and types never drift between
runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.project import project_fields
from ..session import new_path

TEXT_LAYER_ENCODING = "ISO-8859-1"   # large-file path reads Latin-1
STAGE_DELIMITER = "|"                # delimited staging format
STAGE_ENCODING = "windows-1252"


def text_schema(columns: Sequence[str]) -> T.StructType:
    """All-text schema: the permissive raw layer."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_csv_positional(spark: SparkSession, path: str, columns: Sequence[str],
                        sep: str = ",", encoding: str = "UTF-8", multi_line: bool = False) -> DataFrame:
    """A3: small-file bulk load. Header line skipped, columns taken by
    position into an all-text schema (extra trailing fields are dropped,
    missing trailing fields are null). A quote within quotes is doubled;
    ``multi_line`` reads quoted newlines too (a file is then one task)."""
    return (spark.read.schema(text_schema(columns)).option("quote", '"').option("escape", '"')
            .option("multiLine", multi_line)
            .option("header", True).option("enforceSchema", True)
            .option("sep", sep).option("encoding", encoding)
            .option("mode", "PERMISSIVE").csv(path))


def read_csv_by_header(spark: SparkSession, path: str | list[str], fields: Sequence[str],
                       sep: str = ",", encoding: str = TEXT_LAYER_ENCODING, multi_line: bool = False) -> DataFrame:
    """A4: large-file load. Columns are matched **by header name**; the
    target field list then selects and orders them, and a field absent from
    the header becomes null (C1). Empty text reads as null. Quoted
    delimiters and doubled quotes are honoured, with ``multi_line`` quoted
    newlines too (a file is then one task)."""
    # The column names come from the first file's header; enforceSchema
    # off makes Spark check every other file's header against them, so a
    # folder mixing header orders fails instead of being read by position.
    raw = (spark.read.option("header", True).option("inferSchema", False).option("enforceSchema", False)
           .option("sep", sep).option("encoding", encoding)
           .option("quote", '"').option("escape", '"').option("multiLine", multi_line)
           .option("mode", "PERMISSIVE").csv(path))
    return project_fields(raw, fields)


def write_text_csv(df: DataFrame, path: str, sep: str = ",",
                   encoding: str = TEXT_LAYER_ENCODING) -> str:
    """Land a frame in the text layer: every column cast to text, header on."""
    (df.select([F.col(c).cast("string").alias(c) for c in df.columns])
     .write.mode("errorifexists").option("header", True).option("sep", sep).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("encoding", encoding).csv(path))
    return path


# The characters of windows-1252 outside ASCII and Latin-1.
_CP1252_EXTRA = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"


# What the encoding lacks. The few ranges come first: nearly every character leaves at them, while a negated
# class of all that fits tries each of its parts on each character.
_NOT_CP1252 = rf"[\x80-\x9f\x{{100}}-\x{{10ffff}}&&[^{_CP1252_EXTRA}]]"
#: Types whose text is ASCII on one line.
_PLAIN = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _not_stageable(field: T.StructField, multi_line: bool) -> Column:
    if isinstance(field.dataType, _PLAIN):
        return F.lit(False)
    text = F.col(f"`{field.name}`").cast("string")
    bad = text.rlike(_NOT_CP1252)
    return F.coalesce(bad if multi_line else bad | text.rlike(r"[\r\n]"), F.lit(False))


def split_stageable(df: DataFrame, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """A5's reject mode: the rows that the staging encoding and format can
    hold, and the others."""
    bad = F.lit(False)
    for f in df.schema:
        bad = bad | _not_stageable(f, multi_line)
    return df.filter(~bad), df.filter(bad)


def stage_delimited(df: DataFrame, path: str, multi_line: bool = False) -> str:
    """A5: write a large extract as ``|``-separated windows-1252 text with a
    header (needs ``spark.sql.legacy.javaCharsets=true``). A character that
    the encoding lacks is an error, as is a line break unless the stage will
    be read with ``multi_line``; :func:`split_stageable` keeps such rows
    apart."""
    checked = [F.when(_not_stageable(f, multi_line), F.raise_error(F.lit(f"value of {f.name} can't be staged")))
               .otherwise(F.col(f"`{f.name}`").cast("string")).alias(f.name) for f in df.schema]
    return write_text_csv(df.select(checked), path, sep=STAGE_DELIMITER, encoding=STAGE_ENCODING)


def read_delimited_stage(spark: SparkSession, path: str, schema: T.StructType,
                         multi_line: bool = False) -> DataFrame:
    """A5: bulk load of a staged delimited file into a typed schema."""
    text = read_csv_by_header(spark, path, schema.fieldNames(), sep=STAGE_DELIMITER,
                              encoding=STAGE_ENCODING, multi_line=multi_line)
    return text.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def parquet_shape(spark: SparkSession, path: str) -> DataFrame:
    """``(n_rows, n_cols)`` of a Parquet data set. The row count is a
    distributed count that Parquet answers from footers; the column count
    comes from the schema."""
    df = spark.read.parquet(path)
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")).withColumn(
        "n_cols", F.lit(len(df.columns)).cast("bigint"))


def read_json_records(spark: SparkSession, path: str, schema: T.StructType | str,
                      multi_line: bool = False, mode: str = "FAILFAST") -> DataFrame:
    """Records from JSON files. A line (or, with ``multi_line``, a
    whole file) holding a top-level array yields one row per element. Keep
    one array per line so that files stay splittable; ``multi_line`` is for
    pretty-printed single documents. Malformed text is an error, see
    :func:`read_json_or_reject`."""
    return spark.read.schema(schema).option("multiLine", multi_line).option("mode", mode).json(path)


def read_json_or_reject(spark: SparkSession, path: str, schema: T.StructType | str,
                        multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """A7 with rejects: the records, and one row ``bad_text`` for each line
    (or file) that doesn't parse. The files are parsed once, into a stage
    that both frames read."""
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    stage = new_path(spark, "json-records")
    (spark.read.schema(T.StructType([*fields, T.StructField("bad_text", T.StringType())]))
     .option("multiLine", multi_line).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "bad_text")
     .json(path).write.parquet(stage))
    both = spark.read.parquet(stage)
    return both.filter("bad_text IS NULL").drop("bad_text"), both.filter("bad_text IS NOT NULL").select("bad_text")


def empty_like(df: DataFrame) -> DataFrame:
    """Zero rows with the schema of ``df`` (used to create a target)."""
    return df.limit(0)


def read_csv_files_by_header(spark: SparkSession, path: str | list[str], fields: Sequence[str],
                             sep: str = ",", encoding: str = TEXT_LAYER_ENCODING) -> DataFrame:
    """A4 for a landing folder whose files do not share one header: each file
    is read by its own, as a per-file dict reader does. The headers come from
    the same scan that counts quotes (:mod:`conflux.sources.quoted`), so no
    file is opened on the driver, and quoted line breaks don't make a file one
    task. A record with another number of fields than its header is an error;
    :func:`conflux.sources.quoted.split` keeps such records apart."""
    from .quoted import read_records, strict
    return strict(read_records(spark, path, fields, sep=sep, encoding=encoding))
