"""The permissive text layer."""

import os

from pyspark.sql import types as T

from conflux.sources.files import (read_csv_by_header, read_csv_positional, read_delimited_stage,
                                   stage_delimited)


def _write(path, text, encoding):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.csv"), "wb") as f:
        f.write(text.encode(encoding))


def test_latin1_by_header_reordered_extra_absent(spark, tmp_path):
    p = str(tmp_path / "latin1")
    _write(p, 'extra,name,id\nq,"Zoë, Ltd",1\nr,café,2\n', "ISO-8859-1")
    df = read_csv_by_header(spark, p, ["id", "name", "phone"])
    assert df.columns == ["id", "name", "phone"]
    assert [tuple(r) for r in df.orderBy("id").collect()] == [("1", "Zoë, Ltd", None), ("2", "café", None)]


def test_positional_short_row_is_padded(spark, tmp_path):
    p = str(tmp_path / "short")
    _write(p, "a,b,c\n1,2,3\n4,5\n", "UTF-8")
    rows = read_csv_positional(spark, p, ["x", "y", "z"]).orderBy("x").collect()
    assert tuple(rows[1]) == ("4", "5", None)


def test_windows_1252_stage_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "5 €", 2.5), (2, "plain|pipe", None)], "id int, label string, amt double")
    path = stage_delimited(df, str(tmp_path / "stage"))
    raw = b"".join(open(os.path.join(path, f), "rb").read() for f in os.listdir(path) if f.endswith(".csv"))
    assert b"\x80" in raw                                   # euro sign in windows-1252
    back = read_delimited_stage(spark, path, df.schema)
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == [(1, "5 €", 2.5), (2, "plain|pipe", None)]


def test_empty_text_in_int_column_is_null(spark, tmp_path):
    from conflux.operators.conform import conform
    p = str(tmp_path / "empty")
    _write(p, "id,n\n1,\n2,7\n", "UTF-8")
    t = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("n", T.IntegerType())])
    rows = conform(read_csv_by_header(spark, p, ["id", "n"]), t).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, None), (2, 7)]


def test_mixed_header_orders_fail_instead_of_misaligning(spark, tmp_path):
    import pytest
    p = tmp_path / "mixed"
    p.mkdir()
    (p / "a.csv").write_text("id,name\n1,x\n")
    (p / "b.csv").write_text("name,id\ny,2\n")
    with pytest.raises(Exception):
        read_csv_by_header(spark, str(p), ["id", "name"]).collect()
    same = tmp_path / "same"
    same.mkdir()
    (same / "a.csv").write_text("id,name\n1,x\n")
    (same / "b.csv").write_text("id,name\n2,y\n")
    assert read_csv_by_header(spark, str(same), ["id", "name"]).count() == 2


def test_files_read_by_their_own_headers(spark, tmp_path):
    from conflux.sources.files import read_csv_files_by_header
    p = tmp_path / "mixed2"
    p.mkdir()
    (p / "a.csv").write_text("id,name\n1,x\n")
    (p / "b.csv").write_text("name,id,extra\ny,2,z\n")
    (p / "c.csv").write_text("name\nw\n")
    rows = {tuple(r) for r in read_csv_files_by_header(spark, str(p), ["id", "name"]).collect()}
    assert rows == {("1", "x"), ("2", "y"), (None, "w")}
