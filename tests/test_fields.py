"""Records by the fields that are asked for, and scans at the places where their first letters stand."""

from __future__ import annotations

import random
import time

from wirelark.plans import lines
from wirelark.plans import telegram as T
from wirelark.plans.extract import extracted
from wirelark.plans.queries import PHONES, p3_report
from wirelark.plans.rules import Rule

TEXT = "\n".join([
    "¿¿ ¿", "Message Text", "", "CONFIDENTIAL", "", "PAGE 01        PARIS 00012  201212Z", "", "ACTION EUR-12", "INFO  OCT-01  ISO-00  /013 W", "", "DRAFTED BY EUR/X:SMITH:5", "EXT 12345",
    "APPROVED BY EUR:DOE:5", "                     --------------------- 000012 201300Z /7", "R 201210Z JAN 75", "FM AMEMBASSY PARIS", "TO SECSTATE WASHDC 12", "INFO AMEMBASSY BONN", "LIMDIS", "",
    "E.O. 11652: GDS", "TAGS: PFOR, FR", "SUBJCT: VISIT OF DELEGATION", "", "REF: A. STATE 12", "", "1. TEXT.", "C O N F I D E N T I A L SECTION 2 OF 2 PARIS 12", "*** Current Classification *** CONFIDENTIAL",
    "SECRET", "NNNN", "Message Attributes", "", "Document Number: 1975PARIS12", "Subject: VISIT", "  OF DELEGATION", "Locator: TEXT ON-LINE",
])
WORDS = ["SECRET", "C O N F", "UNCLAS SECTION 1 OF 2 X 1", "PAGE 2", "NNN", "----------", "    ---------- 123456", "FM\nX", "R 12131\n4Z JAN 75", "*** Current X", "¿", "é", "ſ", "\r", "\x0b", " ", "\n", "\n\n\n\n", "TAGSUBJ: X", "sub", "5:"]


def _odd(seed: int) -> str:
    rnd, text = random.Random(seed), TEXT
    for _ in range(rnd.randrange(12)):
        at = rnd.randrange(len(text) + 1)
        text = text[:at] + (rnd.choice(["", "\n"]) + rnd.choice(WORDS) if rnd.random() < 0.7 else text[at : at + 20].swapcase()) + text[at + rnd.randrange(4) :]
    return text


def test_scans_find_what_finditer_finds():
    for seed in range(400):
        text = _odd(seed)
        for name, pattern in T.SCANS.items():
            got = [m.span() for m in T._scan(name, text, lines.capitals(text))]
            assert got == [m.span() for m in pattern.finditer(text)], (name, text)
        assert T._artifacts(text) == [m.span() for m in T._ARTIFACT.finditer(text)]


def test_labels_are_found_in_every_line_or_in_hinted_ones():
    for seed in range(400):
        text = _odd(seed)
        assert lines.subject_candidates(text, lines.capitals(text)) == lines.subject_candidates(text)


def test_fields_asked_for_are_those_of_the_whole_record():
    fields = [f for r in T.DEFAULT.rules for f in r.gives] + ["attrs", "coverage"]
    for seed in range(60):
        text = _odd(seed)
        whole = T.parse(text)
        for field in fields:
            assert T.parse(text, fields=frozenset({field})).get(field) == whole.get(field), (field, text)


def test_a_field_runs_the_rules_it_needs_alone(spark):
    assert {r.name for r in T.DEFAULT.giving(["dash_counters"]).rules} == {"classification", "page_break", "end", "content", "dash"}
    assert not T.DEFAULT.giving(["attrs"]).rules
    mine = T.DEFAULT.with_rule(Rule("mine", lambda b, found: None))
    assert mine.giving(["attrs"]) == mine  # it may lean on anything
    rows = spark.createDataFrame([(1, TEXT), (2, "no telegram")], "k long, text string")
    got = extracted(rows, "k", columns=["dash_counters", "has_body"]).orderBy("k").collect()
    assert got[0].asDict().keys() == {"k", "dash_counters", "has_body"}
    assert (got[0].dash_counters.counter, got[0].has_body, got[1].has_body) == (12, True, False)


def test_many_marks_of_an_artifact_before_a_word_take_no_time():
    began = time.time()
    assert T._artifacts("¿" * 26 + "x") == []
    assert time.time() - began < 1


def test_the_report_on_dates_reads_stored_records(spark):
    plan = p3_report(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "cells-" in plan and "MapInArrow" not in plan


def test_an_added_rule_that_says_what_it_gives_leaves_others_out():
    run = {r.name for r in PHONES.giving({"phone", "subject"}).rules}
    assert {"phone", "drafting", "subject"} <= run and not run & {"tags", "handling", "removal"}


def test_readings_of_short_lines_are_kept_and_long_ones_are_not():
    for read, line in ((lines.order_line, "E.O. 11652: GDS"), (lines.tags_line, "TAGS: PFOR"), (lines.handling_line, "LIMDIS, NOFORN"), (lines._first_label, "SUBJCT: VISIT")):
        assert read(line) is not None and read(line) == read.__wrapped__(line)
        assert read(line + " " * 200) == read.__wrapped__(line + " " * 200)
        assert read.__wrapped__ is not read


def test_of_the_dashes_the_first_alone_are_read():
    text = "\n".join(["    ---------- 123456 /1", "", "    ----------- 222222 ---------- 3", "     ---------- 123457Z"])
    caps = lines.capitals(text)
    assert [m.span() for m in T._scan("dash", text, caps)] == [m.span() for m in T.SCANS["dash"].finditer(text)]
    assert len(T._scan("dash", text, caps, 1)) == 1 == len(T._scan("dash", text, None, 1))


def test_lines_that_begin_like_a_class_by_two_letters_alone_are_not_tried():
    words = ["SECSTATE", "TO X", "LIST", "COPY", "UNESCO", "SECRET", "T O P  S E C R E T", "UNCLAS", "LIMITED OFFICIAL USE", "  CONFIDENTIAL", "C O N F I D E N T I A L"]
    caps = lines.capitals("\n".join(["X", *words]))
    assert [caps[at + 1 :].strip().split("\n")[0].strip() for at in T._class_places(caps)] == [w.strip() for w in words[5:]]


def test_scans_whose_words_begin_no_line_are_not_run(monkeypatch):
    ran = []
    scan = T._scan
    monkeypatch.setattr(T, "_scan", lambda name, *more: ran.append(name) or scan(name, *more))
    assert T.parse("Message Text\n1. TEXT.\nFM PARIS\nMessage Attributes\nTo: X\n\nY\n", fields=frozenset({"from", "attrs"}))["from"] == "PARIS"
    assert ran == ["from"]
    assert T._common(T.MARKINGS) in T.MARKINGS[0] and len(T._common(T.MARKINGS)) > 60 and T._common(("AB", "CD")) == T._common(()) == ""


def test_handling_asks_for_the_header_only_where_its_end_matters(monkeypatch):
    read, asked = lines.order_line, []
    monkeypatch.setattr(lines, "order_line", lambda line: asked.append(line) or read(line))
    fields = frozenset({"handling_restrictions"})
    assert T.parse(TEXT, fields=fields)["handling_restrictions"] == ["LIMDIS"] and not asked
    apart = TEXT.replace("LIMDIS\n", "LIMDIS\n\nWORDS\nEXDIS\n")
    assert T.parse(apart, fields=fields)["handling_restrictions"] == ["LIMDIS", "EXDIS"] and asked


def test_rules_that_are_asked_for_are_held_back_unless_a_field_needs_them():
    assert {"subject", "tags", "executive_order"} <= T.DEFAULT.giving(["handling_restrictions"]).held
    assert not T.DEFAULT.giving(["handling_restrictions", "subject", "tags", "executive_order"]).held & {"subject", "tags", "executive_order"}
    assert not T.DEFAULT.held


def test_behind_a_plain_subject_no_other_label_is_read(monkeypatch):
    read, lines_read = lines._first_label, []
    monkeypatch.setattr(lines, "_first_label", lambda line: lines_read.append(line) or read(line))
    text = TEXT.replace("SUBJCT: VISIT", "SUBJECT: VISIT")
    assert T.parse(text, fields=frozenset({"subject"}))["subject"] == "VISIT OF DELEGATION"
    assert lines_read == ["SUBJECT: VISIT OF DELEGATION"]
    assert T.parse(TEXT, fields=frozenset({"subject"}))["subject"] == "VISIT OF DELEGATION" and len(lines_read) > 2


def test_drafting_lines_in_ascii_read_as_others_do():
    rnd = random.Random(5)
    for _ in range(3000):
        line = "".join(rnd.choice(["DRAFTED", "APPROVED", "epproved", "DISTRIBUTION", "DESIRED DISTB", " ", "\t", "Y", "BY", "B", "7", ":", "=", "-", "_"]) for _ in range(rnd.randrange(1, 6)))
        other = line + "\ré"  # one line's text beyond ASCII is read word by word
        assert lines.ends_drafting(line) == lines.ends_drafting(other), line
        for kind in lines.DRAFTING:
            assert lines.drafting_value(line, kind) == lines.drafting_value(other, kind), line
