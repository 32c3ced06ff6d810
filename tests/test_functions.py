"""Scalar functions against hand-made rows."""

import pytest
from pyspark.sql import functions as F

from wirelark.functions import citations, dates, tags, text


def values(spark, expression, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], schema).select(expression(F.col("x")).alias("y")).collect()]


def test_na_null(spark):
    assert values(spark, lambda c: text.na_null(c, "To"), ["To: a ", "N/A", " na", "", None, "To:", "b\n"]) == ["a", None, None, None, None, None, "b"]


def test_ranges_merge_and_cut(spark):
    rows = spark.createDataFrame([("abcdefghij", [(7, 9), (0, 2), (2, 3), (8, 10), (5, 5)]), ("", []), ("xy", [(0, 2)])], "t string, r array<struct<s:int,e:int>>")
    got = rows.withColumn("m", text.merge_ranges(F.col("r"))).select(text.strip_ranges(F.col("t"), F.col("m")), F.size("m")).collect()
    assert [tuple(r) for r in got] == [("defg", 2), ("", 0), ("", 1)]


def test_parse_date(spark):
    rows = ["20 JUN 1973", "20-jun-1973 12:00:00 am", "20-JUN-1973", "20/6/1973", "1973-06-20T00:00:00", "1973-06-20", "31 FEB 1973", "n/a", None, " 20  JUN  1973\n"]
    assert values(spark, dates.parse_date, rows) == ["1973-06-20"] * 6 + [None] * 3 + ["1973-06-20"]


def test_dtg_and_filing(spark):
    found = values(spark, dates.dtg_parts, ["X\nO R 2012 12Z J UN 7 3 W\nFM", "NOTHING", None])
    assert found[0].asDict() == {"raw": "O R 2012 12Z J UN 7 3", "precedence_raw": "O R", "dd": "20", "hh": "12", "mm": "12", "mon": "JUN", "yy": "73"}
    assert found[1:] == [None, None]
    rows = spark.createDataFrame([("r", "O Q", "20", "12", "12", "JUN", "73"), ("r", "", "31", "12", "12", "JUN", "73"), ("r", "R", "01", "00", "00", "JAN", "85")], "raw string, precedence_raw string, dd string, hh string, mm string, mon string, yy string")
    parsed = [r[0] for r in rows.select(dates.parse_dtg(F.struct("*"))).collect()]
    assert parsed[0].asDict() == {"raw": "r", "precedence": ["IMMEDIATE", "Q"], "datetime_iso": "1973-06-20T12:12:00Z"} and parsed[1:] == [None, None]
    filed = [r[0] for r in rows.select(dates.filing_stamp(F.lit("210001Z"), F.struct("*"))).collect()]
    assert filed == ["1973-06-21T00:01:00Z", "1973-06-21T00:01:00Z", None]


def test_split_citations(spark):
    raw = "REF: (A) STATE 105386 (NOTAL), B. MOSCOW 4301\n      AND BONN 12, DATED 3 MAY\n\n     C. UNCLAS LIMA 7 PARA 3."
    got = values(spark, citations.split_citations, [raw, None, "", "REFTEL", "None"])
    assert got[0] == ["STATE 105386", "MOSCOW 4301", "BONN 12, DATED 3 MAY", "LIMA 7"] and got[1:] == [[], [], [], []]


def test_match_airgram_of_a_shorter_station(spark):
    variants = {"JAKARTA": [], "JAKART": [], "DIA": []}
    match = lambda s: lambda c: citations.Stations(variants, strict=s).match(c, F.lit("75"))["mrn"]
    assert values(spark, match(True), ["73 JAKARTA 0012", "JAKARTA A-3", "DIA 123456", "DIA 12345", "X 1", None]) == ["73JAKART-A12", "75JAKARTA-A3", None, "75DIA12345", None, None]
    assert values(spark, match(False), ["73 JAKARTA 0012"]) == ["73JAKARTA12"]


def test_tags(spark):
    t = tags.TagDictionary(permanent={"PFOR": "Foreign"}, temporary={}, organizations={"OAS": "States"}, geographic=[{"FR": "France"}, {"FR": "later"}])
    raw = ["PFOR, fr., (DOE, JOHN), (SEE NOTE 1), N/A, PFOR OAS, ZZZZ, TOO LONG", None, "", "A (B, C)), D"]
    frame = spark.createDataFrame([(i, r, "OAS FR, QUUX" if i == 1 else None) for i, r in enumerate(raw)] + [(0, "FR", None)], "k int, x string, y string")
    rows = tags.normalized(frame, t, key="k", attr=F.col("x"), body=F.col("y")).collect()
    got = {r.k: r for r in rows if r.k or len(r.tags) > 1}
    assert [(e.code, e.type, e.name) for e in got[0].tags] == [
        ("PFOR", "permanent", "Foreign"), ("FR", "geographic", "France"), ("DOE, JOHN", "person", "DOE, JOHN"), ("SEE NOTE 1", "annotation", "SEE NOTE 1"),
        ("OAS", "organization", "States"), ("ZZZZ", "unknown", None), ("TOO LONG", "other", None),
    ]
    assert [(e.code, e.type, e.sources) for e in got[1].tags] == [("OAS", "organization", ["body"]), ("FR", "geographic", ["body"]), ("QUUX", "unknown", ["body"])]
    assert got[2].tags is None and [e.code for e in got[3].tags] == ["A (B, C))", "D"] and len(rows) == 5
    assert got[0].counts.asDict() == {"attr": 8, "body": 0, "attr_na": 1, "body_na": 0, "attr_recovered": 1, "body_recovered": 0}
    assert got[1].counts.asDict() == {"attr": 0, "body": 2, "attr_na": 0, "body_na": 0, "attr_recovered": 0, "body_recovered": 1}


def test_dictionaries_from_files(spark, tmp_path):
    (tmp_path / "tags.csv").write_text("permanent,PFOR,Foreign\ntitle,EAGR,Farming\ntitle,AZZZ,Old\ngeographic-2,FR,later\ngeographic-1,FR,France\norganization,OAS,States\n")
    own = tags.TagDictionary.from_csv(str(tmp_path / "tags.csv"))
    units = spark.createDataFrame([(c,) for c in own.codes], "text string")
    got = {r.code: (r.type, r.name) for r in tags.classified(units, own).collect()}  # F20, over the whole dictionary
    assert got == own.codes == {"PFOR": ("permanent", "Foreign"), "EAGR": ("economic", "Farming"), "AZZZ": ("unknown", "Old"), "FR": ("geographic", "France"), "OAS": ("organization", "States")}
    (tmp_path / "bad.csv").write_text("who,X,Y\n")
    with pytest.raises(ValueError):
        tags.TagDictionary.from_csv(str(tmp_path / "bad.csv"))
    (tmp_path / "stations.csv").write_text("PARIS,PARIS EMB\n\nMOSCOW,MOSCO\n,x\n")
    assert citations.Stations.from_csv(str(tmp_path / "stations.csv")).names == {"PARIS": "PARIS", "PARIS EMB": "PARIS", "MOSCOW": "MOSCOW", "MOSCO": "MOSCOW"}


def test_citations_of_a_telegram(spark):
    own = citations.Stations({c: [] for c in ["STATE", "MOSCOW", "PARIS", "BONN", "BAMAKO", "JAKART", "JAKARTA", "ABUDHABI", "AMMAN"]} | {"ABUDHABI": ["ABUDH"]})
    find = lambda c: F.transform(citations.split_citations(c), lambda t: own.match(t, F.lit("73"))["mrn"])
    raw = ["REF: A. STATE 105386, B. MOSCOW 4301; PARIS 0123 AND 74 BONN 55", "BAMAKO A-50", "USCINCRED 311345 Z MAY 73", "73 JAKARTA 1234", "REFS: (A) BONN 5 (NOTAL), (B) UNCLAS PARIS 7 PARA 3, MAY 3, 1974.", "1. STATE 12 DATED; 2) PARIS' S 9"]
    assert values(spark, find, raw) == [["73STATE105386", "73MOSCOW4301", "73PARIS123", "74BONN55"], ["73BAMAKO-A50"], [None], ["73JAKART-A1234"], ["73BONN5", "73PARIS7"], [None, "73PARIS9"]]
    assert values(spark, own.document_number, ["1973AMMAN03057", "1973ABUDH00866", "1973 AMMAN 03057"]) == ["73AMMAN3057", "73ABUDHABI866", None]


def test_tags_are_put_in_order_by_compiled_code(spark):
    """A comparator as a lambda was called for each pair of tags."""
    dictionary = tags.TagDictionary(permanent={"PFOR": "Foreign"}, temporary={}, organizations={}, geographic=[{"FR": "France"}])
    rows = spark.createDataFrame([(1, "PFOR., FR.. , UK..", "FR, ABCD.,"), (2, None, None), (3, ".", "n/a")], "k int, a string, b string")
    got = tags.normalized(rows, dictionary, key="k", attr=F.col("a"), body=F.col("b"))
    assert "array_sort(" not in got._jdf.queryExecution().optimizedPlan().toString().replace("sort_array(", "")
    found = {r.k: r.tags and [(t.code, list(t.sources)) for t in r.tags] for r in got.collect()}
    assert found == {1: [("PFOR", ["attr"]), ("FR", ["attr", "body"]), ("UK", ["attr"]), ("ABCD", ["body"])], 2: None, 3: None}
