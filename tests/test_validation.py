"""Record validity, routing and dead-letter shape."""

import json

from hypothesis import given, settings, strategies as st

from conflux.functions.jsonpath import is_valid_record
from conflux.operators.validate import PROCESSING_ERROR, VALIDATION_FAILED, dlq_records, split_valid


def py_is_valid(text):
    """Plain-Python statement of the rule: every present value is not
    None, not '' and not []."""
    try:
        rec = json.loads(text)
    except ValueError:
        return None
    if not isinstance(rec, dict):
        return None
    return all(v not in (None, "", []) for v in rec.values())


CASES = [
    ('{"name":null,"amount":1}', False),
    ('{"name":"a","address":""}', False),
    ('{"name":"a","transaction_id":[]}', False),
    ('{"address":"x","amount":3}', True),     # missing key is fine
    ('{"name":"z","amount":0}', True),        # 0 is a value
    ('{"a":false,"b":" ","c":{}}', True),     # false, blank, {} are values
    ('{"a":"[]"}', True),                     # the string "[]" is a value
    ('{"a":[null]}', True),
    ('{"a":"","a":"x"}', True),               # a repeated key: the last value counts
    ('{"a":"x","a":""}', False),
    ("{bad", None),
    ("[1]", None),
    ("3", None),
    ("", None),
]


def test_is_valid_cases(spark):
    df = spark.createDataFrame([(t,) for t, _ in CASES], "value string")
    got = [r[0] for r in df.select(is_valid_record("value")).collect()]
    assert got == [e for _, e in CASES]


json_values = st.recursive(
    st.none() | st.booleans() | st.integers(-5, 5) | st.sampled_from(["", " ", "x", "[]"]),
    lambda inner: st.lists(inner, max_size=2) | st.dictionaries(st.sampled_from("pq"), inner, max_size=2),
    max_leaves=4)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.sampled_from(["name", "address", "amount", "k"]), json_values, max_size=4))
def test_is_valid_property(spark, rec):
    text = json.dumps(rec)
    got = spark.createDataFrame([(text,)], "value string").select(is_valid_record("value")).first()[0]
    assert got == py_is_valid(text)


def test_split_and_dlq(spark):
    rows = [("t1", 0, i, t) for i, (t, _) in enumerate(CASES)]
    msgs = spark.createDataFrame(rows, "topic string, partition int, offset long, value string")
    good, bad = split_valid(msgs)
    assert good.count() == sum(1 for _, e in CASES if e)
    reasons = {r.offset: r.error_reason for r in bad.collect()}
    for i, (_, e) in enumerate(CASES):
        if e is False:
            assert reasons[i] == VALIDATION_FAILED
        elif e is None:
            assert reasons[i] == PROCESSING_ERROR
    d = {r.offset: json.loads(r.value) for r in dlq_records(bad).collect()}
    assert d[0] == {"bad_record": {"name": None, "amount": 1}, "error_reason": VALIDATION_FAILED}
    i_bad = [t for t, _ in CASES].index("{bad")
    assert d[i_bad] == {"bad_record": {"original_message": "{bad", "error_reason": "value is not a JSON object"},
                        "error_reason": PROCESSING_ERROR}
    i_dup = [t for t, _ in CASES].index('{"a":"x","a":""}')
    assert d[i_dup]["bad_record"] == {"a": ""}          # the repeated key's last value


def test_enrichment_overwrites_keys(spark):
    import datetime as dt
    from conflux.operators.project import enrich_message
    rows = [("t1", 0, 0, '{"name":"a","group_id":""}'), ("t1", 0, 1, '{"name":"","group_id":"x"}')]
    msgs = spark.createDataFrame(rows, "topic string, partition int, offset long, value string")
    enriched = enrich_message(msgs, "g", dt.datetime(2024, 1, 1))
    good, bad = split_valid(enriched)
    assert [r.offset for r in good.collect()] == [0]       # its empty group_id is overwritten
    rec = json.loads(dlq_records(bad).first().value)["bad_record"]
    assert rec == {"name": "", "group_id": "g", "date_created": "2024-01-01 00:00:00", "kafka_topic": "t1"}


def test_land_routed_splits_in_one_write(spark, tmp_path):
    from conflux.operators.validate import land_routed
    rows = [("t1", 0, i, t) for i, (t, _) in enumerate(CASES)]
    msgs = spark.createDataFrame(rows, "topic string, partition int, offset long, value string")
    good, dead = land_routed(msgs, {"name": "string", "amount": "bigint"}, str(tmp_path / "landed"))
    assert sorted(r.offset for r in good.collect()) == [i for i, (_, e) in enumerate(CASES) if e]
    assert sorted(r.offset for r in dead.collect()) == [i for i, (_, e) in enumerate(CASES) if not e]
    z = [r for r in good.collect() if r.offset == 4][0]
    assert (z.name, z.amount) == ("z", 0)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["name", "amount", "k"]), json_values), max_size=5))
def test_is_valid_property_with_repeated_keys(spark, pairs):
    text = "{" + ",".join(f"{json.dumps(k)}:{json.dumps(v)}" for k, v in pairs) + "}"
    got = spark.createDataFrame([(text,)], "value string").select(is_valid_record("value")).first()[0]
    assert got == py_is_valid(text)
