"""Raw (text) -> typed conforming and target constraints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import new_path

REJECT_COLUMN = "reject_reason"


def _blank_to_null(c: Column, target: T.DataType) -> Column:
    # Decision: empty text is NULL on every load path (a bulk loader loads
    # it as NULL; a dict reader gives ''), then NOT NULL is checked by C14.
    # Text targets keep whitespace-only values; for typed targets they are
    # as empty as ''.
    empty = (c == "") if isinstance(target, T.StringType) else (F.trim(c) == "")
    return F.when(empty, F.lit(None).cast("string")).otherwise(c)


def conform(df: DataFrame, target: T.StructType, mode: str = "strict") -> DataFrame:
    """Cast text columns to the target types.

    ``strict``: any value that is set but does not convert fails the whole
    load (the query raises, naming column and value), like an
    ``INSERT ... SELECT`` with ``CONVERT``.
    ``reject``: ``try_cast``; a row with a value that is set but does not
    convert gets ``reject_reason`` naming the first such column (null for
    good rows). Split with :func:`split_rejects`.
    """
    srcs = {c.lower(): c for c in df.columns}
    cols, reasons = [], []
    for f in target.fields:
        src = srcs.get(f.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        raw = F.col(f"`{src}`")
        if df.schema[src].dataType == f.dataType and not isinstance(f.dataType, T.StringType):
            cols.append(raw.alias(f.name))       # already the target type: nothing to convert
            continue
        if isinstance(df.schema[src].dataType, T.StringType):
            raw = _blank_to_null(raw, f.dataType)
        typed = raw.try_cast(f.dataType)
        bad = raw.isNotNull() & typed.isNull()
        reason = F.lit(f"bad {f.dataType.simpleString()}: {f.name}")
        if mode == "strict":
            # fails the query whatever spark.sql.ansi.enabled says
            cols.append(F.when(bad, F.raise_error(F.concat(reason, F.lit(" = '"), raw.cast("string"), F.lit("'"))))
                         .otherwise(typed).alias(f.name))
        elif mode == "reject":
            cols.append(typed.alias(f.name))
            reasons.append(F.when(bad, reason))
        else:
            raise ValueError(f"unknown conform mode {mode!r}")
    if mode == "reject":
        cols.append((F.coalesce(*reasons) if reasons else F.lit(None).cast("string")).alias(REJECT_COLUMN))
    return df.select(cols)


def split_rejects(conformed: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = conformed.filter(F.col(REJECT_COLUMN).isNull()).drop(REJECT_COLUMN)
    bad = conformed.filter(F.col(REJECT_COLUMN).isNotNull())
    return good, bad


@dataclass
class Constraints:
    """C14: target table constraints."""
    not_null: Sequence[str] = ()
    primary_key: Sequence[str] = ()
    max_length: Mapping[str, int] = field(default_factory=dict)


VIOLATION_SCHEMA = "rule string, column_name string, key_text string, n_rows bigint"


def _key_text(df: DataFrame, c: str) -> Column:
    kind, col = df.schema[c].dataType, F.col(f"`{c}`")
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(col)
    if isinstance(kind, T.BinaryType):
        return F.hex(col)
    return (col + F.lit(0).cast(kind) if isinstance(kind, T.FractionalType) else col).cast("string")      # -0.0 is 0.0


def _digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """What two rows have in common if and only if they agree in the columns:
    a digest of the values with their lengths."""
    parts = []
    for c in columns:
        text = _key_text(df, c)
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("n")))
    return F.unhex(F.md5(F.concat(*parts).cast("binary")))


def _rules(spec: Constraints) -> list[tuple[str, list[str], int]]:
    not_null = list(dict.fromkeys([*spec.not_null, *spec.primary_key]))   # a key column holds no null either
    return ([("not_null", [c], 0) for c in not_null]
            + ([("primary_key", list(spec.primary_key), 0)] if spec.primary_key else [])
            + [("max_length", [c], n) for c, n in spec.max_length.items()])


def violated(df: DataFrame, spec: Constraints) -> DataFrame:
    """C14 in one scan and one shuffle: ``(rule_no, digest, n_rows)`` of the
    violated rules. Each row gives one cell for each rule it could break (its
    key, a null, a text that is too long), and the cells are counted by rule
    and digest; a text never leaves its task."""
    cells = []
    for i, (rule, columns, most) in enumerate(_rules(spec)):
        key = F.struct(F.lit(i).alias("rule_no"), (F.lit(None).cast("binary") if rule == "not_null" else
                                                   _digest(df, columns)).alias("digest"))
        col = F.col(f"`{columns[0]}`")
        cells.append(key if rule == "primary_key" else F.when(col.isNull(), key) if rule == "not_null"
                     else F.when(F.char_length(col) > most, key))
    keyed = [i for i, (rule, *_) in enumerate(_rules(spec)) if rule == "primary_key"]
    if not cells:
        return df.sparkSession.createDataFrame([], "rule_no int, digest binary, n_rows bigint")
    counted = (df.select(F.explode(F.array_compact(F.array(*cells))).alias("cell")).select("cell.*").groupBy("rule_no", "digest")
               .agg(F.count(F.lit(1)).cast("bigint").alias("n_rows")))
    return counted.filter(~F.col("rule_no").isin(*keyed) | (F.col("n_rows") > 1)) if keyed else counted


def violations(df: DataFrame, spec: Constraints) -> DataFrame:
    """C14: one row per violated rule and offending key/value:
    ``(rule, column_name, key_text, n_rows)``. The rules are checked by
    :func:`violated`; the texts of what it finds are looked up after, by
    digest, and nothing is collected."""
    return _with_texts(df, spec, violated(df, spec))


def _with_texts(df: DataFrame, spec: Constraints, found: DataFrame) -> DataFrame:
    rules = _rules(spec)
    if not rules:
        return df.sparkSession.createDataFrame([], VIOLATION_SCHEMA)
    cells = []
    for i, (rule, columns, most) in enumerate(rules):
        if rule != "not_null":
            text = F.concat_ws(",", *[F.col(f"`{c}`").cast("string") for c in columns])
            cell = F.struct(F.lit(i).alias("no"), _digest(df, columns).alias("of"), text.alias("key_text"))
            cells.append(cell if rule == "primary_key" else F.when(F.char_length(F.col(f"`{columns[0]}`")) > most, cell))
    name = F.element_at(F.array(*[F.lit(",".join(c)) for _, c, _ in rules]), F.col("rule_no") + 1)
    kind = F.element_at(F.array(*[F.lit(r) for r, *_ in rules]), F.col("rule_no") + 1)
    if not cells:
        texts = found.select(F.lit(-1).alias("no"), F.lit(None).cast("binary").alias("of"), F.lit(None).cast("string").alias("key_text"))
    else:
        texts = df.select(F.explode(F.array_compact(F.array(*cells))).alias("cell")).select("cell.*")
    texts = texts.join(found.select("rule_no", "digest"), (F.col("no") == F.col("rule_no")) & (F.col("of") == F.col("digest")),
                       "left_semi").groupBy("no", "of").agg(F.min("key_text").alias("key_text"))
    return (found.join(texts, (F.col("no") == F.col("rule_no")) & (F.col("of") == F.col("digest")), "left")
            .select(kind.alias("rule"), name.alias("column_name"), "key_text", "n_rows"))


class ConstraintViolation(Exception):
    pass


def enforce(df: DataFrame, spec: Constraints) -> DataFrame:
    """Fail the load when any constraint is violated. All violations are
    written to the staging folder, which the error names; its text shows the
    first few only. A clean load is one scan."""
    spark, path = df.sparkSession, new_path(df.sparkSession, "violations")
    violated(df, spec).write.parquet(f"{path}-digests")
    digests = spark.read.schema("rule_no int, digest binary, n_rows bigint").parquet(f"{path}-digests")
    if digests.isEmpty():
        return df
    _with_texts(df, spec, digests).write.parquet(path)
    found = spark.read.schema(VIOLATION_SCHEMA).parquet(path)
    first = found.limit(5).collect()
    if first:
        raise ConstraintViolation("; ".join(
            f"{r.rule} {r.column_name} {r.key_text or ''} x{r.n_rows}" for r in first) + f"; all of them: {path}")
    return df
