"""Chains of landed pages and the elements of their results."""

import json
import random
from collections import Counter

import pytest

from conflux.operators import chains as C
from conflux.sources import responses as R
from pyspark.sql import functions as F


def walk(pages, max_pages):
    """What a client that follows the cursors gets: {(request, cursor): page_num} and the problems, by plain steps."""
    first, n = {}, Counter()
    for request, cursor, nxt, key in sorted(pages, key=lambda p: (p[0], p[1] or "*", p[3])):
        first.setdefault((request, cursor or "*"), nxt or None)
        n[request, cursor or "*"] += 1
    place, problems = {}, Counter()
    for k, m in n.items():
        if m > 1:
            problems[(*k, C.REPEATED)] += m - 1
    for request in {r for r, _ in first}:
        at = "*"
        if (request, at) not in first:
            problems[request, min(c for r, c in first if r == request), C.NO_FIRST] += 1
            continue
        num = 1
        while at is not None and num <= max_pages:
            if (request, at) in place:
                break
            place[request, at] = num
            if (request, at) not in first:
                problems[request, at, C.MISSING] += 1
                break
            nxt = first[request, at]
            if nxt is not None and (request, nxt) in place:
                problems[request, at, C.BACK] += 1
            at, num = nxt, num + 1
        for r, c in first:
            if r == request and (r, c) not in place:
                problems[r, c, C.NOT_REACHED] += 1
    return {k: v for k, v in place.items() if k in first}, problems


def random_pages(seed):
    rnd, rows = random.Random(seed), []
    for request in range(30):
        n = rnd.choice([1, 2, 3, 7, 8, 9, 33])
        names = [None if rnd.random() < 0.3 else "*", *[f"c{rnd.random()}" for _ in range(n - 1)]]
        for i, c in enumerate(names):
            nxt = names[i + 1] if i + 1 < n else rnd.choice([None, ""])
            if rnd.random() < 0.03:
                nxt = rnd.choice(names[1:] or [None])          # ahead, back or itself
            if rnd.random() < 0.03:
                continue                                       # a gap
            for _ in range(1 if rnd.random() < 0.95 else 3):
                rows.append((request, c, nxt, f"{rnd.random()}"))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("max_pages", [1, 2, 5, 40])
def test_doubling_equals_walking(spark, max_pages):
    rows = random_pages(max_pages)
    frame = spark.createDataFrame(rows, "request_id int, cursor string, next string, key string")
    chains = C.Chains(frame, F.col("next"), F.col("key"), max_pages)
    place, problems = walk(rows, max_pages)
    assert {(r.request, r.cursor): r.page_num for r in chains.pages().collect()} == place
    got = Counter()
    for r in chains.problems().collect():
        got[r.request, r.cursor, r.reason] += r.n
    assert got == problems


def body(nxt, *results):
    return json.dumps({"meta": {"next_cursor": nxt}, "results": list(results)})


SCHEMA = "id bigint, title string, ok boolean"


def test_elements_are_typed_one_by_one(spark):
    text = ('{"meta":{},"results":[{"id":1,"title":"a","ok":true},"oops",{"id":"x7"},{"id":"8"},{"title":"no id"},'
            '{"id":null,"title":null},null,[1],{"id":1.5},{"id":9,"title":{"a":[1]}},{"id":3,"ok":"maybe"},{"id":12345678901234567890}]}')
    pages = spark.createDataFrame([(1, 1, text)], "request_id int, page_num int, body string")
    good = R.landed_pages(pages, SCHEMA, skip_malformed=True).collect()
    assert [(r.id, r.title, r.ok) for r in good] == [(1, "a", True), (8, None, None), (None, "no id", None), (None, None, None),
                                                    (9, '{"a":[1]}', None)]
    bad = R.element_rejects(pages, SCHEMA).collect()
    assert [(r._place, r._reject_reason, r._element) for r in bad] == [
        (1, "not an object", '"oops"'), (2, "bad bigint: id", '{"id":"x7"}'), (6, "not an object", "null"), (7, "not an object", "[1]"),
        (8, "bad bigint: id", '{"id":1.5}'), (10, "bad boolean: ok", '{"id":3,"ok":"maybe"}'),
        (11, "bad bigint: id", '{"id":12345678901234567890}')]
    with pytest.raises(Exception, match="not an object|bad bigint|bad boolean"):
        R.landed_pages(pages, SCHEMA).collect()
    fine = spark.createDataFrame([(1, 1, body(None, {"id": 1}))], "request_id int, page_num int, body string")
    assert [tuple(r) for r in R.landed_pages(fine, SCHEMA).collect()] == [(1, 1, 1, None, None)]


def test_linked_pages_follow_cursors(spark):
    rows = [(1, "b", body("c", {"id": 2})), (1, "*", body("b", {"id": 1})), (1, "c", body(None, {"id": 3})),
            (1, "c", body(None, {"id": 3})), (2, None, body("", {"id": 4}, "oops")), (3, "*", body("gone", {"id": 5})),
            (4, "*", body("x", {"id": 6})), (4, "x", body("*", {"id": 7})), (5, "y", body(None, {"id": 8})), (6, "*", '{"cut'),
            (7, "*", body(None, {"id": 9})), (7, "*", body(None, {"id": 10}))]
    pages = spark.createDataFrame(rows, "request_id int, cursor string, body string")
    good, bad, problems = R.linked_pages(pages, "id int", max_pages=9, rejects=True)
    one = min(9, 10, key=lambda i: __import__("hashlib").md5(body(None, {"id": i}).encode()).hexdigest())
    assert sorted((r.request_id, r.page_num, r.id) for r in good.collect()) == [
        (1, 1, 1), (1, 2, 2), (1, 3, 3), (2, 1, 4), (3, 1, 5), (4, 1, 6), (4, 2, 7), (7, 1, one)]
    assert [(r.request_id, r._place, r._reject_reason) for r in bad.collect()] == [(2, 1, "not an object")]
    assert sorted((r.request, r.cursor, r.reason, r.n) for r in problems.collect()) == [
        (1, "c", C.REPEATED, 1), (3, "gone", C.MISSING, 1), (4, "x", C.BACK, 1), (5, "y", C.NO_FIRST, 1), (6, "*", "malformed page", 1),
        (7, "*", C.REPEATED, 1)]
    strict = lambda *of: R.linked_pages(pages.where(F.col("request_id").isin(*of)), "id int", max_pages=9)
    assert sorted(r.id for r in strict(1).collect()) == [1, 2, 3]
    for request, text in ((3, "missing page"), (4, "goes back"), (5, "no first"), (7, "two different pages")):
        with pytest.raises(R.PageError, match=text):
            strict(request)
    for request in (2, 6):
        with pytest.raises(Exception, match="not an object|malformed page"):
            strict(request).collect()
    assert R.linked_pages(pages.limit(0), "id int").count() == 0
