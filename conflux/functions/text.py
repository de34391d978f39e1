"""Text scalar functions (C7, C8, I1-I6, I8, I13) as Column expressions.

All built from ``pyspark.sql.functions``: JVM-side, inside whole-stage
codegen, no Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

DEFAULT_SCHEMA = "dbo"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_table_name(name: Column | str) -> Column:
    """``[db.]schema.table`` or ``table`` -> struct(schema, table_name).
    One part gets schema ``dbo``; two or three parts take the last two; more
    than three parts raise an error (as an unrecognised name does)."""
    parts = F.split(_c(name), "[.]")
    n = F.size(parts)
    checked = F.when(n > 3, F.raise_error(F.concat(F.lit("Unrecognized table format: "), _c(name)))
                     ).otherwise(parts)
    schema = F.when(n == 1, F.lit(DEFAULT_SCHEMA)).otherwise(F.try_element_at(checked, F.lit(-2)))
    return F.struct(schema.alias("schema_name"), F.try_element_at(checked, F.lit(-1)).alias("table_name"))


def strip(col: Column | str) -> Column:
    """Remove leading/trailing whitespace of any kind (tabs and newlines
    too, like ``str.strip``; ``trim`` removes spaces only)."""
    return F.regexp_replace(_c(col), r"(?U)^\s+|\s+$", "")


def normalize_upper(col: Column | str) -> Column:
    """Stripped upper-case config text."""
    return F.upper(strip(col))


def normalize_lower(col: Column | str) -> Column:
    """Stripped lower-case config text."""
    return F.lower(strip(col))


def comma_list(col: Column | str) -> Column:
    """``'a, b ,c'`` -> ``['a','b','c']`` (each item stripped)."""
    return F.transform(F.split(_c(col), ","), lambda x: strip(x))


def contains_ci(col: Column | str, fragment: str) -> Column:
    """I4: case-insensitive ``LIKE '%fragment%'``."""
    escaped = fragment.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return _c(col).ilike(f"%{escaped}%")


def classify(col: Column | str, rules: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """First matching case-insensitive substring rule wins, like a
    searched CASE over ``LIKE`` tests."""
    out = None
    for fragment, label in rules:
        cond = contains_ci(col, fragment)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def step_flags(steps: Column | str) -> Column:
    """``run_extract / run_transform / run_load`` = 1 when the step
    string contains E / T / L (case-insensitive), else 0."""
    s = _c(steps)
    return F.struct(*[F.when(s.ilike(f"%{ch}%"), F.lit(1)).otherwise(F.lit(0)).alias(name)
                      for ch, name in (("E", "run_extract"), ("T", "run_transform"), ("L", "run_load"))])


def concat_nullable(*cols: Column | str) -> Column:
    """``+`` on text in T-SQL: any NULL part makes the result NULL."""
    return F.concat(*[_c(c) for c in cols])


def str_padded(num: Column | str, width: int = 10) -> Column:
    """T-SQL ``STR``: the number rounded to a whole one, right-aligned in
    ``width`` characters; asterisks where it does not fit."""
    text = F.round(_c(num).cast("decimal(38,6)"), 0).cast("decimal(32,0)").cast("string")
    return F.when(F.length(text) > width, F.repeat(F.lit("*"), width)).otherwise(F.lpad(text, width, " "))


def thousands(num: Column | str) -> Column:
    """``FORMAT(n, 'n0')`` -> ``1,234``."""
    return F.format_number(_c(num), 0)


# Fixed value: base name and extension of a file name, split at the last
# dot that has a non-dot character before it (leading dots are part of
# the name, as for hidden files).
NAME_EXT = r"^(\.*[^.].*)(\.[^.]*)$"


def archive_file_name(path: Column | str, stamp: Column, failed: Column | bool = False) -> Column:
    """I8: ``[err_]<name>_<stamp><.ext>`` for the last segment of a path."""
    seg = F.regexp_extract(_c(path), r"([^/]*)$", 1)
    has_ext = seg.rlike(NAME_EXT)
    name = F.when(has_ext, F.regexp_extract(seg, NAME_EXT, 1)).otherwise(seg)
    ext = F.when(has_ext, F.regexp_extract(seg, NAME_EXT, 2)).otherwise(F.lit(""))
    fail = failed if isinstance(failed, Column) else F.lit(bool(failed))
    return F.concat(F.when(fail, F.lit("err_")).otherwise(F.lit("")), name, F.lit("_"), stamp, ext)


def topic_matches(topic: Column | str, pattern: str) -> Column:
    """Regex match anchored at the start only (``re.match``)."""
    return _c(topic).rlike(f"^(?:{pattern})")
