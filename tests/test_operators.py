"""Neighbours, counters, last rows and reports against brute force; the jobs from files to files."""

import json
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wirelark.functions.citations import Stations
from wirelark.operators import estimate, joins, metrics
from wirelark.plans import jobs
from wirelark.plans.extract import extracted
from wirelark.plans.telegram import edits, parse
from wirelark.sources import files

from .test_telegram import ATTRS, BODY, telegram


def test_neighbours_over_the_borders_of_ranges(spark):
    r = np.random.default_rng(0)
    docs = [("A" if i % 3 else "B", "75", False, int(s), f"D{i}", f"R{i}", f"1975-01-{1 + i % 28:02d}") for i, s in enumerate(sorted(set(r.integers(0, 3000, 120).tolist())))]
    asked = [("AB"[i % 2], "75", False, int(s), f"M{i}") for i, s in enumerate(r.integers(-5, 3200, 200))] + [("C", "75", False, 5, "M-alone")]
    frame = spark.createDataFrame(docs, "station string, year string, is_airgram boolean, sequence long, document_number string, document_number_raw string, date string")
    targets = spark.createDataFrame(asked, "station string, year string, is_airgram boolean, sequence long, mrn string")
    got = {x.mrn: (x.prev and x.prev.document_number, x.next and x.next.document_number) for x in estimate.neighbours(targets, frame, width=64).collect()}
    for station, _, _, sequence, mrn in asked:
        own = [(d[3], d[4]) for d in docs if d[0] == station]
        assert got[mrn] == (max((x for x in own if x[0] < sequence), default=(0, None))[1], min((x for x in own if x[0] >= sequence), default=(0, None))[1])
    assert len(got) == len(asked)


def test_counters_next_to_the_aim(spark):
    r = np.random.default_rng(1)
    day = lambda n: str(date(1975, 1, 1) + timedelta(int(n)))
    counters = [(day(d), int(c)) for d, c in zip(r.integers(0, 100, 3000), r.integers(0, 20000, 3000))]
    brackets = []
    for i in range(300):
        p, n, a, b = int(r.integers(0, 90)), int(r.integers(0, 60)), int(r.integers(0, 18000)), int(r.choice([0, 1, 3, 40, 900, 7000]))
        brackets.append((f"m{i}", day(p), day(p + n - 5), a, a + b, a + b * float(r.random())))
    frame = spark.createDataFrame(brackets, "mrn string, p_date string, n_date string, p_counter long, n_counter long, aim double")
    got = {x.mrn: (tuple(x.low), tuple(x.high)) for x in estimate.refined(frame, spark.createDataFrame(counters, "date string, counter long")).collect()}
    want = {}
    for mrn, p, n, a, b, aim in brackets:
        inside = [(c, d) for d, c in counters if p <= d <= n and a <= c <= b] if b > a and p <= n else []
        low, high = max((x for x in inside if x[0] < aim), default=None), min((x for x in inside if x[0] >= aim), default=None)
        if low and high:
            want[mrn] = (low, high)
    assert got == want and len(want) > 50


def test_estimates_take_the_last_of_repeated_rows(spark):
    docs = spark.createDataFrame(
        [("75BONN10", "r10", "1975-01-01", 1), ("75BONN20", "r20", "1975-03-01", 1), ("75BONN14", "r14", "1975-02-20", 1), ("75BONN14", "r14", "1975-01-25", 2), ("75BONN16", "r16", "1975-02-05", 1)],
        "document_number string, document_number_raw string, date string, file int",
    )
    counters = spark.createDataFrame([("r10", 100, 1), ("r20", 200, 1), ("r14", 999, 1), ("r14", 140, 2), ("r16", 160, 1), ("r16", None, 2)], "document_number_raw string, counter int, file int")
    missing = spark.createDataFrame([("75BONN15",), ("zz",)], "mrn string")
    got = {r.mrn: r for r in estimate.estimates(missing, docs.where("document_number not in ('75BONN14', '75BONN16')").unionByName(docs.where("document_number_raw in ('r14', 'r16')").withColumn("document_number", F.lit("x"))), counters, Stations({"BONN": []}), order=["file"]).collect()}
    assert (got["75BONN15"].estimate_type, got["75BONN15"].estimated_date, got["75BONN15"].accuracy_days) == ("interpolated_refined", "1975-01-31", 11)  # six days, 5.5 rounded to even, behind the 25th of the last rows
    assert got["zz"].estimate_type == "unparseable" and len(got) == 2


def test_value_distribution_as_sorted_by_hand(spark):
    rows = [("a", f"v{i}") for i in range(50) for _ in range(1 + i % 7)] + [("b", f"w{i}") for i in range(10)]
    got = sorted((r.attribute, r.value, r.times, r.top) for r in metrics.value_distribution(spark.createDataFrame(rows, "attribute string, value string"), 5).collect())
    want = []
    for name in "ab":
        times = {v: sum(x == (name, v) for x in rows) for n, v in rows if n == name}
        ranked = sorted(times, key=lambda v: (-times[v], v))
        want += [(name, v, times[v], i + 1) for i, v in enumerate(ranked) if len(ranked) <= 10 or i < 5 or i >= len(ranked) - 5]
    assert got == sorted(want)


def test_last_wins_takes_a_later_null(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 1, "y")], "k string, o int, v string")
    assert {r.k: r.v for r in joins.last_wins(rows, "k", ["o"]).collect()} == {"a": None, "b": "y"}


def test_edits():
    assert [edits(a, b) for a, b in [("", "AB"), ("AB", "BA"), ("SUBEJCT", "SUBJECT"), ("KITTEN", "SITTING"), ("SUBJ", "SUBJ")]] == [2, 1, 1, 3, 0]


def test_missing_paths_are_skipped(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x")
    with pytest.warns(UserWarning, match="missing"):
        rows = files.text_files(spark, [str(tmp_path / "nowhere"), str(tmp_path)])
    assert [r.text for r in rows.collect()] == ["x"]
    with pytest.warns(UserWarning):
        assert files.text_files(spark, [str(tmp_path / "nowhere")]).count() == 0


def test_strict_records_say_where_they_fail(spark, tmp_path):
    schema = StructType.fromDDL("a int, b string")
    (tmp_path / "r.json").write_text("".join(f'{{"a": {i}}}\n' + "\n" * (i % 2) for i in range(2000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = {r.a: r.line for r in files.records_strict(spark, [str(tmp_path / "r.json")], schema).collect()}
        assert got == {i: 1 + i + i // 2 for i in range(2000)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    (tmp_path / "bad.json").write_text('{"a": 1}\n\nnot json\n')
    with pytest.raises(Exception, match="bad.json:3"):
        files.records_strict(spark, [str(tmp_path / "bad.json")], schema).collect()


def fails_on_markers(text, markings):
    if "FAIL" in text:
        raise RuntimeError("no")
    return parse(text, markings)


def test_a_failing_text_is_a_row(spark):
    rows = spark.createDataFrame([("good", telegram()), ("bad", "FAIL"), ("null", None)], "file string, text string")
    good, bad = files.split_errors(extracted(rows, read=fails_on_markers))
    assert {r.file for r in good.collect()} == {"good", "null"} and [(r.file, r.error) for r in bad.collect()] == [("bad", "RuntimeError: no")]


def test_jobs_from_files_to_files(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    (tmp_path / "in").mkdir()
    for i in range(6):
        body = BODY.replace("STATE 105386", f"PARIS {i * 10 + 5}")
        (tmp_path / f"in/{i}.txt").write_text(telegram(body, ATTRS.replace("1973PARIS00123", f"1973PARIS000{i * 10 + 10}") + "Draft Date: 20 JUN 1973\nTAGS: PFOR\n"))
    (tmp_path / "stations.csv").write_text("PARIS\nMOSCOW\n")
    (tmp_path / "tags.csv").write_text("permanent,PFOR,Foreign\ngeographic-1,FR,France\n")
    assert jobs.extract(spark, at("records"), at("in")).count() == 6 and jobs.extract(spark, at("two"), at("in"), limit="2").count() == 2
    assert jobs.coverage(spark, at("records")).first().unmatched == 0
    dates = jobs.normalize_dates(spark, at("records"), at("stations.csv"), at("dates")).collect()
    assert {r.document_number for r in dates} == {f"73PARIS{n}" for n in range(10, 70, 10)} and {r.dates.draft_date for r in dates} == {"1973-06-20"}
    cited = jobs.normalize_citations(spark, at("records"), at("stations.csv"), at("cited"))
    assert sorted(x for r in cited.collect() for x in r.extracted_references) == sorted(f"73PARIS{n}" for n in range(5, 65, 10))
    tagged = jobs.normalize_tags(spark, at("records"), at("stations.csv"), at("tags.csv"), at("tagged"))
    assert {json.dumps([t.code for t in r.tags]) for r in tagged.collect()} == {'["PFOR", "FR"]'}
    assert jobs.join(spark, at("cited"), at("tagged"), at("joined")).where("size(tags) = 2").count() == 6
    found = {r.mrn: r.estimate_type for r in jobs.estimate_missing(spark, at("cited"), at("records"), at("stations.csv"), at("estimates")).collect()}
    assert found["73PARIS5"] == "extrapolated" and found["73PARIS15"] == "interpolated" and len(found) == 6
    assert jobs.merge(spark, at("joined"), at("estimates"), at("merged")).count() == 12
    assert jobs.quality(spark, at("records"), at("quality")).count() == 0
    assert jobs.main([]) == 1 and jobs.main(["nothing"]) == 1
