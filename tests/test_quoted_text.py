"""Delimited text with quoted line breaks in many byte ranges."""

import csv
import io
import random

import pytest

from conflux.sources import quoted as Q
from pyspark.sql import types as T

WORDS = ["plain", "été", "größe", "niño", "日本", "a,b", 'say "hi"', "two\nlines", "\n", "", '""', ",", "x\r\ny", "trail ", " lead",
         'end"', "a|b", "many\n\n\nlines", "long " * 40]


@pytest.fixture()
def small_splits(spark):
    """Files are cut into ranges of a few hundred bytes."""
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def write(path, rows, header=("id", "name", "note"), sep=",", encoding="utf-8", end="\n", quoting=csv.QUOTE_MINIMAL):
    out = io.StringIO()
    w = csv.writer(out, delimiter=sep, lineterminator=end, quoting=quoting)
    w.writerow(header)
    w.writerows(rows)
    path.write_bytes(out.getvalue().encode(encoding))
    return str(path)


def table(seed, n=400):
    rnd = random.Random(seed)
    return [(str(i), rnd.choice(WORDS), "".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 4)))) for i in range(n)]


def text_rows(df):
    return sorted(tuple(r) for r in df.collect())


def nulls(rows):
    return sorted(tuple(v or None for v in r) for r in rows)


def key(r):
    return tuple((v is None, v or "") for v in r)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ranges_of_one_file_equal_multi_line(spark, tmp_path, small_splits, seed):
    rows = table(seed)
    path = write(tmp_path / "a.csv", rows)
    assert Q._lines(spark, path, "UTF-8").rdd.getNumPartitions() > 20
    got = Q.strict(Q.read_records(spark, path, ["id", "name", "note"]))
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted((tuple(v or None for v in r) for r in rows), key=key)
    whole = (spark.read.schema("id string, name string, note string").option("multiLine", True).option("header", True)
             .option("quote", '"').option("escape", '"').option("lineSep", "\n").csv(path))
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted((tuple(r) for r in whole.collect()), key=key)


def test_a_record_over_many_ranges(spark, tmp_path, small_splits):
    """A quoted field longer than several ranges, line breaks in it or not, first, amid and last in the file."""
    huge = "\n".join(f"line {i} with ""quotes"" , and more" for i in range(200))
    rows = [("0", huge, "x" * 2000), ("1", "a", "b"), ("2", 'q"' * 900, huge), ("3", "c\nd", "e"), ("4", "f", "\n" * 1500)]
    path = write(tmp_path / "a.csv", rows)
    assert text_rows(Q.strict(Q.read_records(spark, path, ["id", "name", "note"]))) == sorted(rows)


@pytest.mark.parametrize("encoding, sep, end", [("ISO-8859-1", ",", "\n"), ("windows-1252", "|", "\r\n"), ("UTF-8", ";", "\r\n")])
def test_encodings_separators_and_line_ends(spark, tmp_path, small_splits, encoding, sep, end):
    rows = [(str(i), w, "é|;,\nß") for i, w in enumerate(["café", "naïve", "x", "ü\n"] * 40)]
    path = write(tmp_path / "a.csv", rows, sep=sep, encoding=encoding, end=end)
    assert text_rows(Q.strict(Q.read_records(spark, path, ["id", "name", "note"], sep=sep, encoding=encoding))) == sorted(rows)


def test_files_have_their_own_headers(spark, tmp_path, small_splits):
    rows = table(5, 60)
    write(tmp_path / "a.csv", rows)
    write(tmp_path / "b.csv", [(n, i) for i, n, _ in rows], header=("Name", "ID"))
    write(tmp_path / "c.csv", [(i, "q", "r", n, t) for i, n, t in rows], header=("id", "more, and", "p", "name", "note"))
    (tmp_path / "d.csv").write_text("id,name\n")
    (tmp_path / "e.csv").write_text("\n\n﻿id,note\n7,only\n\n")
    got = Q.strict(Q.read_records(spark, str(tmp_path), ["id", "name", "note"]))
    want = [*rows, *[(i, n, None) for i, n, _ in rows], *rows, ("7", None, "only")]
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted((tuple(v or None for v in r) for r in want), key=key)


def test_other_numbers_of_fields_are_rejects(spark, tmp_path, small_splits):
    good = [(str(i), "a,b", "c\nd") for i in range(100)]
    path = write(tmp_path / "a.csv", good)
    with open(path, "a", newline="") as f:
        f.write('1,a,b,EXTRA\n2\n3,"x\ny","p,q","EX\nTRA"\n\n4,""\n5,a,b\n6,"never closed\n7,a,b\n')
    records = Q.read_records(spark, path, ["id", "name", "note"])
    ok, bad = Q.split(records)
    assert text_rows(ok) == sorted([*good, ("5", "a", "b")])
    assert text_rows(bad) == sorted([(Q.TOO_MANY, "1,a,b,EXTRA"), (Q.TOO_FEW, "2"), (Q.TOO_MANY, '3,"x\ny","p,q","EX\nTRA"'),
                                     (Q.TOO_FEW, '4,""'), (Q.UNCLOSED, '6,"never closed\n7,a,b')])
    with pytest.raises(Exception, match="too many fields|too few fields|unclosed quote"):
        Q.strict(records).collect()


def test_by_position_and_empty_inputs(spark, tmp_path):
    path = write(tmp_path / "a.csv", [("1", "x\ny", "z")])
    assert text_rows(Q.strict(Q.read_records(spark, path, ["a", "b", "c"], by_position=True))) == [("1", "x\ny", "z")]
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "a.csv").write_text("")
    (tmp_path / "empty" / "b.csv").write_text("\n\n")
    none = Q.read_records(spark, str(tmp_path / "empty"), ["a", "b"])
    assert none.count() == 0 and none.columns == ["a", "b", Q.REASON, Q.RECORD]


def test_lines_without_quoted_breaks_are_not_shuffled(spark, tmp_path, small_splits):
    """Such records go from the scan to the parser: the only join is with the table of ranges."""
    from tests.test_plans import forbidden_in, plan_of
    path = write(tmp_path / "a.csv", [(str(i), "a,b", 'q"q') for i in range(200)])
    df = Q.strict(Q.read_records(spark, path, ["id", "name"]))
    assert df.count() == 200
    plan = plan_of(df)
    assert "hashpartitioning" not in plan and "Window" not in plan and "BroadcastHashJoin" in plan and not forbidden_in(df)


def test_flat_file_load_keeps_quoted_newlines(spark, tmp_path, small_splits):
    import datetime as dt

    from conflux.plans.flatfile import load_flat_file
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("name", T.StringType())])
    rows = [("1", "one"), ("2", "two\nlines"), ("3", 'a "b"\n,c')]
    src = tmp_path / "in"
    src.mkdir()
    write(src / "a.csv", rows, header=("id", "name"))
    res = load_flat_file(spark, str(src), schema, str(tmp_path / "t"), 7, dt.datetime(2024, 1, 1))
    assert res.rows == 3
    got = spark.read.parquet(str(tmp_path / "t")).select("id", "name")
    assert text_rows(got) == [(1, "one"), (2, "two\nlines"), (3, 'a "b"\n,c')]
    with open(src / "a.csv", "a") as f:
        f.write("4,x,EXTRA\n5\n6,bad id ok\nsix,y\n")
    with pytest.raises(Exception, match="too many fields|too few fields|bad bigint"):
        load_flat_file(spark, str(src), schema, str(tmp_path / "t"), 8, dt.datetime(2024, 1, 1))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3          # the target stays
    res = load_flat_file(spark, str(src), schema, str(tmp_path / "t"), 9, dt.datetime(2024, 1, 1),
                         reject_path=str(tmp_path / "rejects"))
    assert (res.rows, res.rejected) == (4, 3)
    reasons = sorted(r.route for r in spark.read.parquet(str(tmp_path / "rejects")).select("route").collect())
    assert reasons == ["bad bigint: id", "too few fields", "too many fields"]
    raw = spark.read.parquet(str(tmp_path / "rejects" / "_records"))
    assert text_rows(raw) == [("too few fields", "5"), ("too many fields", "4,x,EXTRA")]
