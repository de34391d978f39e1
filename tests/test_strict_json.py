"""The end of a JSON text: nothing may follow its object."""

import json
import random

from conflux.functions.jsonpath import ends_with_object, parse_json_object
from conflux.operators.validate import PROCESSING_ERROR, with_reason
from pyspark.sql import functions as F

PARTS = ["{", "}", "[", "]", '"', "\\", '\\"', ":", ",", "1", "a", " ", "\n", "\t", "null", '"a"', '{"a":1}', '{"k":"}"}', "x", "'", "true",
         '"\\\\"', "é", '{"a":[1,{"b":"]"}]}']


def strict(text):
    try:
        return isinstance(json.loads(text), dict)
    except ValueError:
        return False


def test_random_texts_equal_a_strict_parser(spark):
    rnd = random.Random(8)
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(1, 7))) for _ in range(6000)]
    good = ['{"a":1}', '{"k":"}"}', '{"a":[1,{"b":"]"}]}', "{}", '{"a":{"b":{}}, "c":[[],[{}]]}', '{"s":"\\"} {\\\\"}', '{"t":"a\\\\"}']
    texts += [rnd.choice(["", " ", "\n"]) + rnd.choice(good) + "".join(rnd.choice(["", " ", "\t", "\n", "\r", *PARTS]) for _ in range(rnd.randint(0, 3)))
              for _ in range(6000)]
    texts += ['{"a":1} x', '{"a":1}{"b":2}', '{"a":1} "}"', '{"a":"x"} }', "{'a':1}", '{"a":1}]', "", "  ", "[{}]", "{} {}"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(4)
    got = {r.i: r.ok for r in rows.select("i", parse_json_object("t").isNotNull().alias("ok")).collect()}
    wrong = [(t, got[i]) for i, t in enumerate(texts) if got[i] != strict(t)]
    assert not wrong, wrong[:5]
    assert sum(got.values()) > 2000


def test_long_texts_need_no_stack(spark):
    long = json.dumps({"a": '\\"' * 200_000, "b": [{"c": "}" * 1000}] * 500})
    df = spark.createDataFrame([(long,), (long + " {}",), (long + "\n",)], "t string")
    assert [r[0] for r in df.select(ends_with_object("t")).collect()] == [True, False, True]


def test_text_behind_a_record_is_a_processing_error(spark):
    df = spark.createDataFrame([('{"a":1} x',), ('{"a":1}',), ('{"a":1}{"a":null}',), ('{"a":null} ',)], "value string")
    reasons = [r.error_reason for r in with_reason(df).collect()]
    assert reasons == [PROCESSING_ERROR, None, PROCESSING_ERROR, "Validation failed: null or empty fields"]
    assert df.filter(F.lit(False)).select(ends_with_object("value")).count() == 0
