"""Places, percentiles and reports without a task that holds all rows; the estimate job's last rows."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from wirelark.operators import metrics
from wirelark.operators.estimate import refined
from wirelark.operators.ranges import numbered
from wirelark.plans import jobs


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [0, 1, 500])
def test_places_are_those_of_one_sort(spark, n):
    r = random.Random(n)
    rows = [(r.choice([None, "a", "b", "c"]), r.randrange(40), i) for i in range(n)]
    frame = spark.createDataFrame(rows, "s string, k int, i int").repartition(5)
    got = numbered(frame, F.col("s").isNull(), "s", F.desc("k"), "i", name="at").collect()
    want = sorted(rows, key=lambda x: (x[0] is None, x[0] or "", -x[1], x[2]))
    assert [x[:3] for x in sorted(map(tuple, got), key=lambda x: x[3])] == want and sorted(x.at for x in got) == list(range(1, n + 1))


def brute_ranks(values, shares):
    values = sorted(values)
    return {s: values[min(len(values) - 1, int(len(values) * s))] for s in shares}


def test_nearest_ranks_need_no_window_over_everything(spark):
    r, shares = random.Random(4), [0.0, 0.5, 0.9, 0.99, 1.0]
    rows = [(r.choice(["x", "y", None]), r.choice([None, *range(30)]) if r.random() < 0.9 else r.randrange(10_000)) for _ in range(3000)]
    frame = spark.createDataFrame(rows, "g string, v int").repartition(6)
    whole = metrics.nearest_ranks(frame, "v", shares)
    assert "Window" in plan(whole) and "SinglePartition" not in plan(whole)
    assert {x.share: x.percentile for x in whole.collect()} == brute_ranks([v for _, v in rows if v is not None], shares)
    got = {}
    for x in metrics.nearest_ranks(frame, "v", shares, ["g"]).collect():
        got.setdefault(x.g, {})[x.share] = x.percentile
    assert got == {g: brute_ranks([v for h, v in rows if h == g and v is not None], shares) for g in ("x", "y", None)}
    assert metrics.nearest_ranks(frame.limit(0), "v", shares).collect() == []


COVERAGE = "k string, load int, coverage struct<total:int,matched:int,blank:int,unmatched:int>, a string, b string"


def test_states_of_parts_merge_to_the_state_of_the_whole(spark):
    r = random.Random(2)
    rows = []
    for i in range(300):
        matched, blank, rest = r.randrange(50), r.randrange(5), r.choice([0, 0, r.randrange(30)])
        rows.append((f"d{i:03}", i % 4, (matched + blank + rest, matched, blank, rest), r.choice([None, "x"]), "y"))
    frame, fields = spark.createDataFrame(rows, COVERAGE), {"a": F.col("a"), "b": F.col("b")}
    whole = metrics.report_state(frame, "k", fields, n=7).first()
    parts = metrics.report_state(frame, "k", fields, "load", n=7)
    halves = [metrics.merged_state(parts.where(f"load {x} 2"), 7) for x in ("<", ">=")]
    for merged in (metrics.merged_state(parts, 7), metrics.merged_state(halves[0].unionByName(halves[1]), 7)):
        assert merged.first() == whole
    share = lambda c: 100.0 * (c[1] + c[2]) / c[0] if c[0] else 100.0
    assert [(w.covered, w.key) for w in whole.worst] == sorted((share(c), k) for k, _, c, _, _ in rows)[:7]
    totals, report = metrics.character_totals(frame).first(), metrics.state_report(metrics.merged_state(parts)).first()
    assert all(totals[c] == report[c] for c in totals.asDict()) and report.fields.a == sum(x[3] is not None for x in rows)


def test_the_report_of_nothing(spark):
    none = spark.createDataFrame([], COVERAGE)
    state = metrics.report_state(none, "k", {"a": F.col("a")}).first()
    assert (state.documents, state.total, state.fields.a, state.worst) == (0, 0, 0, [])
    assert metrics.state_report(metrics.merged_state(metrics.report_state(none, "k", {"a": F.col("a")}, "load"))).first().documents == 0


def test_the_estimate_job_takes_the_last_row_of_a_number(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    cited = [
        ("75BONN10", "r10", "1975-01-10", None, "a"), ("75BONN20", "r20", "1975-01-20", ["75BONN15"], "a"), ("x", "r17", "1975-01-16", None, "a"),
        ("x", "r12", "1975-01-18", None, "a"), ("x", "r12", "1975-01-12", None, "b"),  # the last is not the greatest
    ]
    spark.createDataFrame(cited, "document_number string, document_number_raw string, date string, extracted_references array<string>, file string").write.parquet(at("cited"))
    counters = [("r10", 100, "a"), ("r20", 200, "a"), ("r12", 199, "a"), ("r12", 149, "b"), ("r17", 151, "a")]
    records = [({"Document Number": raw}, (None, n, None, None), file) for raw, n, file in counters]
    spark.createDataFrame(records, "attrs map<string,string>, dash_counters struct<raw:string,counter:int,filing_time:string,copies:int>, file string").write.parquet(at("records"))
    (tmp_path / "stations.csv").write_text("BONN\n")
    got = jobs.estimate_missing(spark, at("cited"), at("records"), at("stations.csv"), at("out")).first()
    assert (got.mrn, got.estimated_date, got.estimate_type, got.accuracy_days) == ("75BONN15", "1975-01-14", "interpolated_refined", 4)


def test_counters_of_brackets_are_found_without_pairs(spark):
    """J9 against brute force: brackets of one day to years, aims outside them, ranges of three counters."""
    rnd = random.Random(9)
    day = lambda n: str(datetime.date(1973, 12, 20) + datetime.timedelta(n))
    counters = [(day(rnd.randrange(900)), rnd.randrange(300)) for _ in range(600)]
    brackets = []
    for i in range(300):
        first, low = rnd.randrange(900), rnd.randrange(300)
        last, high = first + rnd.choice([0, 1, 5, 31, 64, 700]), low + rnd.choice([1, 3, 40, 200])
        brackets.append((f"B{i}", day(first), day(last), low, high, rnd.choice([low + rnd.random() * (high - low), low - 2.5, high + 2.5, float(high), float(low)])))
    want = {}
    for mrn, p, n, a, b, aim in brackets:
        inside = [(c, d) for d, c in counters if p <= d <= n and a <= c <= b]
        low, high = max((x for x in inside if x[0] < aim), default=None), min((x for x in inside if x[0] >= aim), default=None)
        if low and high:
            want[mrn] = low, high
    frame = spark.createDataFrame(brackets, "mrn string, p_date string, n_date string, p_counter long, n_counter long, aim double")
    got = refined(frame, spark.createDataFrame(counters, "date string, counter long"), width=3)
    assert {r.mrn: (tuple(r.low), tuple(r.high)) for r in got.collect()} == want
    joined = [x for x in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x]
    assert joined and not any("p_counter" in x or "p_date" in x for x in joined)
