"""Names looked up by hash against an alternation of all names, longest first."""

import random
import re

import pytest
from pyspark.sql import functions as F

from wirelark.functions.citations import DATE_SENDERS, STOP_STATIONS, Stations, clean
from wirelark.functions.lookup import Lookup

LIST = {"STATE": [], "MOSCOW": ["MOSCOW EMB"], "JAKART": [], "JAKARTA": [], "ABU DHABI": ["ABUDH"], "USUN 2": [], "FSI12": ["FSI"], "SECSTATE": [], "BONN": ["BONN-A"], "X-A": ["DATED"], "4TH FLEET": []}


def tokens(seed, n):
    r = random.Random(seed)
    names = [*LIST, "MOSCOW EMB", "ABUDH", "FSI", "DATED", "BONN-A", "PARIS", "state"]
    for _ in range(n):
        t = r.choice(["", "75", "75 ", "75-", "7", "  ", "75 - "]) + r.choice(names) + r.choice(["", " ", "-", " - ", "A", "-A ", " A-", " AIRGRAM ", "-A"]) + r.choice(["", "0", "00"]) + str(r.choice([5, 12, 123456, 1234567890, 12345678901]))
        yield "".join(r.choice("75 -A1") if r.random() < 0.2 else c for c in t) if r.random() < 0.2 else t


def brute(token, strict):
    names = {v.upper(): c for c, vs in LIST.items() for v in [c, *vs]}
    one = "|".join(re.escape(n) for n in sorted((n for n in names if n not in STOP_STATIONS), key=lambda n: (-len(n), n)))
    shapes = [(r"(?:-?A|AIRGRAM)[\s-]*", "-A"), ("", "")]
    for middle, mark in shapes if strict else shapes[::-1]:
        m = re.match(rf"(?i)^(?:([0-9]{{2}})[\s-]*)?({one})[\s-]*{middle}([0-9]{{1,10}})$", token)
        if m:
            if len(m[3]) >= 6 and m[2].upper() in DATE_SENDERS:
                return None
            return (m[1] or "76") + names[m[2].upper()] + mark + (m[3].lstrip("0") or "0")
    return None


@pytest.mark.parametrize("strict", [True, False])
def test_stations_are_matched_as_by_an_alternation(spark, strict):
    rows = list(enumerate(tokens(1, 3000)))
    own = Stations(LIST, strict)
    got = spark.createDataFrame(rows, "i int, t string").select("t", own.match(F.col("t"), F.lit("76"))["mrn"].alias("m")).collect()
    assert [(r.t, r.m) for r in got if r.m != brute(r.t, strict)] == [] and sum(r.m is not None for r in got) > 500


def test_canonical_ids_of_names_with_digits(spark):
    own = Stations(LIST)
    ids = ["75FSI123", "75FSI12-A3", "75X-A5", "75X-A-A5", "75USUN 27", "75USUN 2", "75FSI12", "75BONN12345678901234567890", "BONN5", "75PARIS5", None]
    got = spark.createDataFrame([(i,) for i in ids], "m string").select(own.parse(F.col("m")).alias("p")).collect()
    assert [None if r.p is None else (r.p.station, r.p.is_airgram, r.p.sequence) for r in got] == [
        ("FSI12", False, 3), ("FSI12", True, 3), ("X-A", False, 5), ("X-A", True, 5), ("USUN 2", False, 7), None, None, ("BONN", False, None), None, None, None,
    ]


def test_a_lookup_finds_its_keys_alone(spark):
    table = {f"K{i}": str(i) for i in range(3000)} | {"é": "e", "": "none"}
    got = spark.createDataFrame([(k,) for k in [*table, "k1", "K3000", None]], "k string").select("k", Lookup(table)[F.col("k")].alias("v")).collect()
    assert {r.k: r.v for r in got} == table | {"k1": None, "K3000": None, None: None}
    with pytest.raises(ValueError, match="too many"):
        Lookup({str(i): "x" for i in range(70_000)})
    assert spark.range(1).select(Lookup({})[F.lit("a")].alias("v")).first().v is None


def test_any_century_in_front_of_a_year_goes(spark):
    raw = ["1975 PARIS 5", "1975PARIS 5", "2075PARIS5", "REF A. 1876STATE 12", "12345PARIS 6", "75PARIS 1975A"]
    got = spark.createDataFrame([(r,) for r in raw], "r string").select(clean(F.col("r")).alias("c")).collect()
    assert [x.c for x in got] == ["1975 PARIS 5", "75PARIS 5", "75PARIS5", "REF A. 76STATE 12", "12345PARIS 6", "75PARIS 75A"]
