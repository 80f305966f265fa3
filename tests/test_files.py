"""Delimited files of all forms."""

from pyspark.sql import functions as F

from wasteflow.sources import files


def test_files_of_all_forms(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.csv").write_text("Year,Material,Tons\n2001,zinc,5\n2002,\"lead, old\",7\n")
    (tmp_path / "b.csv").write_bytes("tons;material;year\n1;Münze;1999\n2;Käse;1998\n".encode("latin-1"))
    (tmp_path / "sub" / "c.tsv").write_bytes("material\tyear\nté\t2003\n".encode() + b"b\xffd\t2004\nshort\nlong\t1\t2\n")
    (tmp_path / "d.csv").write_bytes(b"\xef\xbb\xbfyear|material\n2005|tin\n")
    (tmp_path / "e.csv").write_text("year,year,\n1,2,3\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "head.csv").write_text("year,material\n")
    (tmp_path / "_hidden.csv").write_text("x,y\n1,2\n")
    rows = files.read_listing_files(spark, str(tmp_path))
    assert set(rows.columns) == {"year", "material", "tons", "year_2", "column", "source_file", "bad_line"}
    got = sorted((r["material"] or "", r["year"] or "", r["tons"] or "", r["bad_line"] is not None) for r in rows.collect())
    assert got == sorted([("zinc", "2001", "5", False), ("lead, old", "2002", "7", False), ("Münze", "1999", "1", False), ("Käse", "1998", "2", False), ("té", "2003", "", False), ("b�d", "2004", "", False), ("short", "", "", True), ("long", "1", "", True), ("tin", "2005", "", False), ("", "1", "", False)])
    assert sorted(r["bad_line"] for r in files.read_listing_files(spark, str(tmp_path), "only").collect()) == ["long\t1\t2", "short"]
    assert files.read_listing_files(spark, str(tmp_path), "skip").count() == 8
    assert files.read_listing_files(spark, str(tmp_path / "none*")).count() == 0


def test_forms_of_samples():
    assert files.form_of(b"a;b,c;d\n1;2,5;3\n4;5,5;6\n")[0] == ";"
    assert files.form_of(("name\n" + "é" * 3000).encode())[1] == "UTF-8"
    assert files.form_of("﻿a,b\n1,2\n".encode("utf-16-le"))[1:] == ("UTF-16LE", ("a", "b"))
    assert files.form_of(b"") == (",", "UTF-8", ())


def test_json_records(spark):
    texts = ["[]", "[1, 2]", "{}", "3", "nope", "", None, "[1,"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", files.json_records(F.col("t")).alias("n")).orderBy("i").collect()
    assert [r["n"] for r in rows] == [0, 2, 1, 1, None, None, None, None]
