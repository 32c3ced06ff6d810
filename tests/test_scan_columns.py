"""Scans as columns agree with the scans in Python, span for span."""

import random
import re

import pytest
from pyspark.sql import functions as F

from wirelark.functions.spans import EDGE, heads, spans
from wirelark.plans import lines, queries, telegram
from wirelark.plans.rules import CONTENT, RAW, Rule
from wirelark.functions.text import merge_ranges, strip_ranges
from wirelark.plans.scan_columns import HEADER, KEY_LINE, routing, scanned
from wirelark.plans.scan_columns import RAW as BODY_SCANS

from .test_telegram import ATTRS, BODY
from .test_telegram import telegram as whole

SF = "/root/testdata/sf0.001"


def _raw(b, found):
    b.record["_raw"] = (b.start, {name: [(*m.span(), m[0]) for m in b.found[name]] for name in BODY_SCANS})


def _header(b, found):
    scans = {name: [(*m.span(), m[0]) for m in telegram.SCANS[name].finditer(b.text)] for name in ("section", "dtg", "from", "dash")}
    for name, read in (("tags_line", lambda x: lines.tags_line(x) is not None), ("handling", lines.handling_line)):
        scans[name] = [(at, at + len(line), line) for at, line in lines.lines_of(b.text) if read(line)]
    b.record["_header"] = (b.text, scans)


# addressees as R16 leaves them: R22 takes designators off their ends later
WATCHED = telegram.DEFAULT.without_rule("handling").with_rule(Rule("raw", _raw, priority=RAW)).with_rule(Rule("header", _header, priority=CONTENT, after=("content",)))


def by_python(text):
    record = telegram.parse(text, rules=WATCHED)
    start, inside = record.get("_raw", (None, None))
    header, scans = record.get("_header", (None, None))
    out = {f"body_{n}": inside[n] for n in BODY_SCANS} if inside else {}
    out |= {f"header_{n}": scans[n] for n in HEADER} if scans else {}
    heads = [[(*m.span(), m[0]) for m in head.finditer(text)] for head in telegram._HEADS]
    behind = heads[1][0][1] if heads[1] else 0
    keys = [(behind + m.start(), behind + m.end(), m[0]) for m in re.finditer("^" + telegram._KEY_LINE.pattern, text[behind:], re.M)]
    marks = [(*m.span(), m[0]) for m in telegram._any_of(telegram.MARKINGS).finditer(text)]
    return out | {"attrs": record["attrs"], "to": record.get("to"), "info": record.get("info"), "region_start": start, "header": header, "text_head": heads[0], "attribute_head": heads[1], "attribute_keys": keys, "markings": marks, "artifacts": [(*m.span(), m[0]) for m in telegram._ARTIFACT.finditer(text)]}


def agree(frame):
    plan = scanned(frame, "k")
    assert "Python" not in plan._jdf.queryExecution().toString() and "Arrow" not in plan._jdf.queryExecution().toString()
    texts = dict(map(tuple, frame.select("k", "text").collect()))
    for row in plan.collect():
        want = by_python(texts[row.k])
        for name, value in want.items():
            got = row[name]
            if isinstance(got, list):
                got = [(s.start, s.end, s.value) for s in got]
            assert got == value, (name, texts[row.k])
        if row.region_start is None:
            assert row.header is None and row.header_dtg is None
    return len(texts)


@pytest.mark.parametrize("shape", [queries.rendered, queries.varied, queries.inlined])
def test_both_read_rendered_telegrams_alike(spark, shape):
    assert agree(shape(spark, SF).where("k % 5 < 2")) > 100


LINES = [
    "TO SECSTATE", "to x", "INFO BONN", "  MORE", "FM  BONN", "To: a", "Review Markings: b", "TAGS: c", "Type: n/a", " more", "\tmore", "Status: ", "Subject:d",
    "CONFIDENTIAL", "C O N F I D E N T I A L", "SECRET  PARIS 123A", "PAGE 02  X", "page 3", "NNN", "NNNN", "NNNNMAFVVZCZ", "<< END OF DOCUMENT >>", "*** Current Classification *** X", "UNCLAS SECTION 1 OF 2 PARIS 5", "", "", "  ", "¿¿", "¿ ¿ ¿ text", "é¿ é",
    "                     --------------------- 054819", "     ---------- 201212Z 054819 /7 x", "R 201212Z JUN 73", "O R 20 1212Z  J U N E 73 ZZ", "FM PARIS", "TAGS: A", "TAGS", "TAG x", "taga", "TAGGED", "LIMDIS", " EXDIS, NODIS ", "EXDIS X", "TEXT", telegram.MARKINGS[0], f"x {telegram.MARKINGS[1]} y", "Message Text", "Type: TE", "Subject: é",
]


def test_both_read_random_telegrams_alike(spark):
    r = random.Random(3)
    rows = []
    for k in range(250):
        body = [r.choice(LINES) for _ in range(r.randint(0, 14))] if k % 2 else BODY.split("\n")
        for _ in range(r.randint(0, 4)):
            body.insert(r.randint(0, len(body)), r.choice(LINES))
        rows.append((k, r.choice(["", "¿¿\n", "¿\n\n"]) + whole("\n".join(body) + "\n", "\n".join(r.choice(LINES) for _ in range(r.randint(0, 12))) + ATTRS + r.choice(["", "To: x\n¿\n"])) + r.choice(["", "\n¿ ¿"])))
    agree(spark.createDataFrame([*rows, (900, ""), (901, "no marks")], "k int, text string"))


def test_spans_of_any_pattern(spark):
    text = "aé😀b aab\n\nab"
    frame = spark.createDataFrame([(text,), (None,), ("",)], "text string")
    for pattern in (r"a+", r"^a", r"\n+", "b", "zz", ".$"):
        got = frame.select(spans(F.col("text"), re.compile(pattern, re.M)).alias("s")).collect()
        assert [(s.start, s.end, s.value) for s in got[0].s] == [(*m.span(), m[0]) for m in re.finditer(pattern, text, re.M)] and got[1].s == [] == got[2].s


def test_spans_of_empty_matches_and_of_texts_with_an_edge(spark):
    texts = ["ab", f"a{EDGE}b", f"{EDGE}{EDGE}", f"ab{EDGE}\nab"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    for pattern in (r"b*", r"a|b", rf"{EDGE}", r"^a"):
        got = frame.select(spans(F.col("text"), re.compile(pattern, re.M)).alias("s")).collect()
        for text, row in zip(texts, got):
            if EDGE not in text or pattern != "b*":
                assert [(s.start, s.end, s.value) for s in row.s] == [(*m.span(), m[0]) for m in re.finditer(pattern, text, re.M)]


def test_telegrams_with_an_edge_are_read_alike(spark):
    rows = [(k, whole(f"FM {EDGE}PARIS\nTO {EDGE}\n{EDGE}NNN\nNNN\n", f"To: {EDGE}b\n" + ATTRS)) for k in range(2)]
    agree(spark.createDataFrame(rows, "k int, text string"))


def test_keys_by_their_first_letters():
    words = [*telegram.KEYS, "Reviewer", "to", "Typed", "", "TAGSA"]
    plain = KEY_LINE.replace(r"\Q", "").replace(r"\E", "")
    for word in words:
        assert bool(re.fullmatch(plain, word + ":")) == bool(re.fullmatch(telegram._KEY_LINE, word + ":"))


def test_attributes_are_folded_over_lines_only_where_values_cross_blank_lines(spark):
    """A text without such a key is read by one search; all shapes agree with the reader in Python."""
    pieces = ["Type: TE", "Subject: a", "  b", "", "  ", "c", "\x0b", "TAGS: x", "To: z", "Type: ", "n/a", "\tq", "\u2003", "Status:", "¿"]
    r = random.Random(11)
    rows = [(k, whole("FM A\nTO B\n", "\n".join(r.choice([p for p in pieces if k % 3 or p != "To: z"]) for _ in range(r.randint(0, 9))) + r.choice(["", "\n"]))) for k in range(200)]
    agree(spark.createDataFrame(rows, "k int, text string"))


def test_heads_by_their_words(spark):
    words, pattern = "Message Text", telegram._HEADS[0]
    texts = ["", "Message Text", " \tMessage Text \nx", "é\n Message Text\n", "x Message Text\n", "Message Text x", "Message Text\nMessage Text\n", "Message Texts\n Message Text", "😀\nMessage Text\r\n", f"{EDGE}\nMessage Text"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    for text, row in zip(texts, frame.select(heads(F.col("text"), words, pattern).alias("s")).collect()):
        assert [(s.start, s.end, s.value) for s in row.s] == [(*m.span(), m[0]) for m in pattern.finditer(text)], text


def test_ranges_that_touch_are_cut_alike(spark):
    frame = spark.createDataFrame([([(0, 2), (2, 4)],), ([(3, 5), (0, 1)],), ([(0, 4), (1, 2), (4, 4)],), ([],)], "r array<struct<s:int,e:int>>")
    got = [(list(map(tuple, a)), list(map(tuple, b)), c, d) for a, b, c, d in frame.select(merge_ranges(F.col("r")), merge_ranges(F.col("r"), touching=False), strip_ranges(F.lit("abcdef"), merge_ranges(F.col("r"))), strip_ranges(F.lit("abcdef"), merge_ranges(F.col("r"), touching=False))).collect()]
    assert [x[0] for x in got] == [[(0, 4)], [(0, 1), (3, 5)], [(0, 4)], []]
    assert [x[1] for x in got] == [[(0, 2), (2, 4)], [(0, 1), (3, 5)], [(0, 4)], []]
    assert [x[2] for x in got] == [x[3] for x in got] == ["ef", "bcf", "ef", "abcdef"]


def test_addressees_are_told_apart_once(spark):
    """A line's label was worked out anew wherever it was named, a dozen times a line."""
    lines_ = spark.createDataFrame([("FM A\nTO B\n C\nINFO D\n\nTO E",)], "header string")
    plan = lines_.select(routing(F.col("header")).alias("r"))
    assert tuple(plan.collect()[0].r) == ("B C", "D")
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("INFO ") <= 2
