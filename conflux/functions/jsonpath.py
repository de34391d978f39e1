"""JSON scalar functions (C2, I11, I12) and the record validity rule.

JSON is kept as text in the raw layer and read with path functions so that
a missing key, an explicit ``null`` and a value of the wrong shape (an
array where an object was expected) are told apart exactly as the source
documents intend.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

KEY_NOT_FOUND = "Key not found"   # fixed value: default of a missing key


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def nested_path(json_text: Column | str, dotted: str) -> Column:
    """Walk ``a.b.c`` through objects; null when a step is missing, is
    null, or is not an object (an array on the way yields null)."""
    return F.get_json_object(_c(json_text), "$." + dotted)


def json_value_or_default(json_text: Column | str, key: str, default: str = KEY_NOT_FOUND) -> Column:
    """``json.loads(s).get(key, default)`` when ``s`` is set, else null."""
    s = _c(json_text)
    return F.when(s.isNull(), F.lit(None).cast("string")).otherwise(
        F.coalesce(F.get_json_object(s, f"$.{key}"), F.lit(default)))


def to_json_record(*cols: Column | str) -> Column:
    """Serialise columns as one JSON object."""
    return F.to_json(F.struct(*[_c(c) for c in cols]))


def dedup_last(m: Column) -> Column:
    """A parsed object whose text repeated a key keeps the key's **last**
    value, as loading it into a dict does (Spark's parser keeps every
    occurrence). Objects without a repeat -- nearly all -- pass as they
    are; reference ``m`` through a column so the parse is not repeated."""
    keys = F.map_keys(m)
    entries = F.map_entries(m)
    last_only = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)),
                                                        lambda x: x["key"] == e["key"]))
    return F.when(F.size(keys) == F.size(F.array_distinct(keys)), m).otherwise(F.map_from_entries(last_only))


_SPACE = " \t\r\n"


def ends_with_object(json_text: Column | str) -> Column:
    """Whether nothing but white space follows the first value of a text that
    starts with an object. A parser that stops behind that value can't tell.

    Most objects have one pair of brackets and end in it. For the others,
    strings become a letter, and of what is left only the brackets are walked
    through: the depth comes to zero once, at the end."""
    text = F.rtrim(_c(json_text), F.lit(_SPACE))
    closing = F.length(text) - F.length(F.replace(text, F.lit("}"), F.lit("")))
    # possessive, so that long strings with many escapes need no stack
    bare = F.regexp_replace(text, r'"[^"\\]*+(?:\\[\s\S][^"\\]*+)*+"', "s")
    brackets = F.split(F.regexp_replace(bare, r"[^{}\[\]]++", ""), "")
    step = lambda c: F.when(c.isin("{", "["), 1).when(c.isin("}", "]"), -1).otherwise(0)
    walked = F.aggregate(
        brackets, F.struct(F.lit(0).alias("depth"), F.lit(0).alias("ends")),
        lambda at, c: F.struct((at["depth"] + step(c)).alias("depth"),
                               (at["ends"] + F.when((step(c) < 0) & (at["depth"] == 1), 1).otherwise(0)).alias("ends")))
    whole = F.endswith(bare, F.lit("}")) & (walked["ends"] == 1) & (walked["depth"] == 0)
    return F.when(~F.endswith(text, F.lit("}")), False).when(closing == 1, True).otherwise(whole)


def parse_json_object(json_text: Column | str) -> Column:
    """JSON text -> ``map<string, variant>`` (repeated keys kept); null for
    anything that is not a single JSON object, also where other text follows
    it or quotes are single."""
    return F.when(ends_with_object(json_text), F.from_json(_c(json_text), "map<string,variant>", {"allowSingleQuotes": "false"}))


def parse_object(json_text: Column | str) -> Column:
    """JSON text -> ``map<string, variant>``; null for anything that is not a
    single JSON object (malformed text, arrays, scalars, empty text); a
    repeated key keeps its last value (:func:`dedup_last`)."""
    return dedup_last(parse_json_object(json_text))


def has_empty_value(obj: Column) -> Column:
    """C9 core: some present value is null, ``""`` or ``[]``. ``0``,
    ``false``, ``" "`` and ``{}`` count as values; a missing key is not a
    violation."""
    return F.exists(F.map_values(obj), lambda v: F.is_variant_null(v) | F.to_json(v).isin('""', "[]"))


def is_valid_record(json_text: Column | str) -> Column:
    """True when the text is an object whose every present value is
    non-empty; null when it is not an object at all."""
    return ~has_empty_value(parse_object(json_text))
