"""Landed API responses.

The HTTP fetch loop is not rebuilt (it is a sequential single-machine
client); responses are landed as files/rows -- one row per page -- and
everything after the fetch is a Spark plan: parse, follow the cursor chain
(F3), explode the results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..operators.chains import BACK, FIRST, MISSING, NO_FIRST, Chains
from ..operators.windows import page_chain

DEFAULT_MAX_PAGES = 2


_BAD = "_bad_text"


def _schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _parsed(body: str, schema: T.StructType) -> Column:
    """The document, with its whole text in ``_BAD`` where it doesn't parse."""
    return F.from_json(F.col(body), T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())]),
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})


def is_malformed(body: str, schema: T.StructType | str = "meta string") -> Column:
    """Whether a text isn't a JSON document of the schema (null and empty
    text aren't either)."""
    doc = _parsed(body, _schema(schema))
    return doc.isNull() | doc[_BAD].isNotNull()


def split_documents(df: DataFrame, body: str, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """Reject mode of A8, A9, D7 and U3: the rows whose document parses
    against the schema, and the others. Both read the input; no row is in
    neither."""
    bad = is_malformed(body, schema)
    return df.filter(~bad), df.filter(bad)


#: A page: its cursor and its results, none of which is typed yet.
PAGE = "meta struct<next_cursor:string>, results array<variant>"
#: Why an element was kept apart (null: it wasn't), and its text.
REASON, ELEMENT, PLACE = "_reject_reason", "_element", "_place"
NOT_AN_OBJECT = "not an object"


class PageError(ValueError):
    """Pages that can't be followed from cursor to cursor."""


def typed_elements(df: DataFrame, results: Column, schema: T.StructType | str) -> DataFrame:
    """One row for each element of a page's results (an array of variants),
    each element typed by itself: the columns of ``df``, the element's place,
    the fields of ``schema``, and for an element that isn't an object or has a
    value that doesn't convert ``_reject_reason`` and ``_element``, its text, with all
    fields null. A missing field or a JSON null is null; no value becomes null
    otherwise."""
    own = [F.col(f"`{c}`") for c in df.columns]
    rows = df.select(*own, F.posexplode(results).alias(PLACE, "_e"))
    e = F.col("_e")
    typed, reason = [], F.when(F.try_variant_get(e, "$", "map<string,variant>").isNull(), F.lit(NOT_AN_OBJECT))
    for f in _schema(schema).fields:
        path, kind = "$['%s']" % f.name, f.dataType.simpleString()
        value, raw = F.try_variant_get(e, path, kind), F.try_variant_get(e, path, "variant")
        bad = raw.isNotNull() & ~F.is_variant_null(raw) & value.isNull()
        if isinstance(f.dataType, T.IntegralType):       # 1.5 is no integer
            bad = bad | (F.try_variant_get(e, path, "double") != value.cast("double"))
        reason = reason.when(bad, F.lit(f"bad {kind}: {f.name}"))
        typed.append((f.name, value))
    rows = rows.withColumn(REASON, reason)
    good = F.col(REASON).isNull()
    return rows.select(*own, PLACE, *[F.when(good, v).alias(n) for n, v in typed], REASON,
                       F.when(~good, F.to_json(e)).alias(ELEMENT))


def strict_elements(rows: DataFrame, *where: str) -> DataFrame:
    """The elements of :func:`typed_elements`; a bad one is an error that
    names the columns ``where``."""
    place = F.concat(F.col(REASON), *[F.concat(F.lit(f", {c} "), F.col(c).cast("string")) for c in (*where, PLACE)],
                     F.lit(": "), F.substring(ELEMENT, 1, 200))
    # an id isn't below 0, but it keeps the test where it is
    ok = F.when(F.col(REASON).isNull(), F.monotonically_increasing_id() >= 0).otherwise(F.raise_error(place).cast("boolean"))
    return rows.where(ok).drop(REASON, ELEMENT, PLACE)


def split_elements(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The good elements, and the others with reason, text and place."""
    good = F.col(REASON).isNull()
    keep = [c for c in rows.columns if c not in (REASON, ELEMENT, PLACE)]
    return rows.where(good).select(*[F.col(f"`{c}`") for c in keep]), rows.where(~good)


def _parsed_pages(pages: DataFrame, body: str, skip_malformed: bool, *where: str) -> DataFrame:
    """The pages with ``_doc``; a malformed one is an error, or its document
    null."""
    doc = _parsed(body, _schema(PAGE))
    if skip_malformed:
        fixed = F.when(F.col("_doc").isNotNull() & F.col(f"_doc.{_BAD}").isNull(), F.col("_doc"))
    else:
        place = F.concat(F.lit("malformed page"), *[F.concat(F.lit(f"{of}"), F.col(c).cast("string")) for of, c in
                                                   zip((" ", " of request "), where)])
        # an id isn't below 0, but it keeps the test behind the filter of the pages
        fixed = (F.when(F.col("_doc").isNull() | F.col(f"_doc.{_BAD}").isNotNull(), F.raise_error(place).cast(doc_type()))
                 .when(F.monotonically_increasing_id() >= 0, F.col("_doc")))
    return pages.withColumn("_doc", doc).withColumn("_doc", fixed)


def doc_type() -> T.StructType:
    return T.StructType([*_schema(PAGE).fields, T.StructField(_BAD, T.StringType())])


def landed_pages(pages: DataFrame, result_schema: T.StructType | str,
                 max_pages: int = DEFAULT_MAX_PAGES, body: str = "body",
                 request: str = "request_id", page_num: str = "page_num", skip_malformed: bool = False) -> DataFrame:
    """Records of each request's pages in the order of their numbers:
    pages up to and including the first with a null/empty
    ``meta.next_cursor``, at most ``max_pages``. One row per result. Pages
    that were landed with the cursor they were fetched with are better read by
    :func:`linked_pages`.

    A malformed page within a chain is an error, as it is for a client that
    follows the cursors, and so is an element of its results that isn't an
    object or has a value that doesn't convert. With ``skip_malformed`` such a
    page gives no records and the chain goes on after it, and such an element
    is left out; :func:`split_documents` of the pages (schema ``meta string,
    results string``) and :func:`element_rejects` give the rejects."""
    return _page_elements(pages, result_schema, max_pages, body, request, page_num, skip_malformed, False)


def element_rejects(pages: DataFrame, result_schema: T.StructType | str,
                    max_pages: int = DEFAULT_MAX_PAGES, body: str = "body",
                    request: str = "request_id", page_num: str = "page_num") -> DataFrame:
    """The elements that :func:`landed_pages` leaves out with
    ``skip_malformed``: request, page, place in its results, reason, text."""
    return _page_elements(pages, result_schema, max_pages, body, request, page_num, True, True)


def _page_elements(pages, result_schema, max_pages, body, request, page_num, skip_malformed, rejects):
    if skip_malformed:
        cursor = F.when(is_malformed(body), F.lit("unknown")) \
            .otherwise(F.get_json_object(F.col(body), "$.meta.next_cursor"))
    else:
        cursor = F.get_json_object(F.col(body), "$.meta.next_cursor")
    parsed = pages.select(request, page_num, cursor.alias("next_cursor"), body)
    kept = page_chain(parsed, request, page_num, F.col("next_cursor"), max_pages).select(request, page_num, body)
    docs = _parsed_pages(kept, body, skip_malformed, page_num, request).select(request, page_num, F.col("_doc.results").alias("_r"))
    rows = typed_elements(docs, F.col("_r"), result_schema).drop("_r")
    if rejects:
        return split_elements(rows)[1].select(request, page_num, PLACE, REASON, ELEMENT)
    return split_elements(rows)[0] if skip_malformed else strict_elements(rows, request, page_num)


def linked_pages(pages: DataFrame, result_schema: T.StructType | str, max_pages: int = DEFAULT_MAX_PAGES,
                 body: str = "body", request: str = "request_id", cursor: str = "cursor",
                 rejects: bool = False) -> DataFrame | tuple[DataFrame, DataFrame, DataFrame]:
    """A8 by cursor: the records of each request's chain, from the page
    fetched with the cursor ``*`` (or none) on, each page the one that its
    predecessor's ``meta.next_cursor`` names; ``page_num`` counts them. Pages
    landed in any order, and again, make no difference (see
    :class:`conflux.operators.chains.Chains`).

    A malformed page or element is an error, and so is a chain that a client
    couldn't have fetched so: a page that is missing, a cursor that leads back,
    a request without a first page, two different pages for one cursor.
    With ``rejects`` the result is (records, rejected elements, problems);
    malformed pages end their chain and are among the problems, as are repeated
    pages, of which one is read."""
    keyed = pages.select(F.col(request).alias(request), F.coalesce(F.col(cursor), F.lit(FIRST)).alias(cursor), F.col(body),
                         F.md5(F.coalesce(F.col(body), F.lit("")).cast("binary")).alias("_key"))
    chains = Chains(keyed, F.get_json_object(F.col(body), "$.meta.next_cursor"), F.col("_key"), max_pages, request, cursor)
    if not rejects:
        different = (keyed.groupBy(request, cursor).agg(F.min("_key").alias("low"), F.max("_key").alias("high"))
                     .where("low <> high").limit(5).collect())
        wrong = chains.problems().where(F.col("reason").isin(MISSING, BACK, NO_FIRST)).limit(5).collect()
        if different or wrong:
            raise PageError("; ".join([f"two different pages for cursor {r[cursor]} of request {r[request]}" for r in different]
                                      + [f"{r['reason']}: cursor {r['cursor']} of request {r['request']}" for r in wrong]))
    place = chains.pages().select(F.col("request").alias("_r"), F.col("cursor").alias("_c"), F.col("key").alias("_k"), "page_num")
    kept = keyed.join(place, (F.col(request).eqNullSafe(F.col("_r"))) & (F.col(cursor) == F.col("_c")) & (F.col("_key") == F.col("_k")))
    kept = kept.dropDuplicates([request, cursor]).select(request, cursor, "page_num", body)
    docs = _parsed_pages(kept, body, rejects, cursor, request)
    rows = typed_elements(docs.select(request, "page_num", F.col("_doc.results").alias("_r")), F.col("_r"), result_schema).drop("_r")
    if not rejects:
        return strict_elements(rows, request, "page_num")
    malformed = kept.where(is_malformed(body, PAGE)).select(
        F.col(request).alias("request"), F.col(cursor).alias("cursor"), F.lit("malformed page").alias("reason"),
        F.lit(1).cast("bigint").alias("n"))
    good, bad = split_elements(rows)
    return good, bad, chains.problems().unionByName(malformed)


def parse_envelope(df: DataFrame, body: str, schema: T.StructType | str, mode: str = "FAILFAST") -> DataFrame:
    """One response document parsed against an explicit schema. Malformed
    text is an error; :func:`split_documents` keeps it apart."""
    return df.withColumn("doc", F.from_json(F.col(body), schema, {"mode": mode}))
