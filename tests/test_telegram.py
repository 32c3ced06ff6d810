"""Whole telegrams."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wirelark.plans.telegram import MARKINGS, label_tier, merged, parse, without

BODY = """PAGE 01        PARIS 00123  201212Z

54
ACTION EUR-12

INFO  OCT-01  ISO-00  /013 W
                     --------------------- 054819
R 201212Z JUN 73
FM AMEMBASSY PARIS
TO SECSTATE WASHDC 1234
INFO AMEMBASSY MOSCOW

LIMDIS

E.O. 11652: GDS
TAGS: N/A
TAGS: PFOR, FR
SUBJECT: TEST SUBJECT
     LINE

REF: A. STATE 105386

1. BODY TEXT.

CONFIDENTIAL
NNN

"""
ATTRS = """
Document Number: 1973PARIS00123
Review Markings: first

 
declassified
second
Locator: TEXT ON-LINE
Enclosure: n/a
"""


def telegram(body=BODY, attrs=ATTRS):
    return f"Message Text\n{body}Message Attributes\n{attrs}"


def test_fields():
    r = parse(telegram())
    assert r["dtg"] == {"raw": "R 201212Z JUN 73", "precedence_raw": "R", "dd": "20", "hh": "12", "mm": "12", "mon": "JUN", "yy": "73"}
    assert (r["from"], r["to"], r["info"]) == ("AMEMBASSY PARIS", "SECSTATE WASHDC 1234", "AMEMBASSY MOSCOW")
    assert r["distribution"]["sum_check"] == {"expected": 13, "actual": 13, "valid": True} and r["distribution"]["unknown_num"] == 54
    assert (r["tags"], r["subject"], r["executive_order"]) == ("PFOR, FR", "TEST SUBJECT LINE", "E.O. 11652: GDS")
    assert r["reference"] == "REF: A. STATE 105386" and r["handling_restrictions"] == ["LIMDIS"]
    assert r["classification_marker"] == ["CONFIDENTIAL"] and r["page_break"][0]["page"] == 1
    assert "BODY TEXT" in r["message_content"] and "NNN" not in r["message_content"] and "SECSTATE" not in r["message_content"]
    assert r["attrs"]["Enclosure"] is None and r["attrs"]["Review Markings"] == "first\ndeclassified\nsecond"


def test_sections_repeat_headers():
    again = BODY.replace("1. BODY TEXT.", "1. BODY TEXT.\n\nACTION EUR-12\n                     --------------------- 054820\nR 201213Z JUN 73\nFM AMEMBASSY PARIS\n\nCONFIDENTIAL SECTION 2 OF 2 PARIS 00123\nMORE")
    r = parse(telegram(again))
    assert r["section_marker"][0]["section"] == 2 and r["section_marker"][0]["mrn"] == "PARIS 00123" and r["dtg"]["mm"] == "13"
    assert "ACTION" not in r["message_content"] and "MORE" in r["message_content"]


@pytest.mark.parametrize("text", ["", "Message Text\n", "Message Attributes\nType: TE", "no marks at all", telegram() + "Message Text\n", "Message Attributes\n" + telegram()])
def test_incomplete_texts_have_no_body(text):
    assert "message_content" not in parse(text)


def test_counters_tell_filing_time():
    r = parse(telegram(BODY.replace("--------------------- 054819", "--------------------- 201300Z 054819 /12")))
    assert r["dash_counters"] == {"raw": "--------------------- 201300Z 054819 /12", "counter": 54819, "filing_time": "201300Z", "copies": 12}


def test_markings_are_cut_with_their_line():
    r = parse(telegram(BODY.replace("1. BODY TEXT.", "1. BODY TEXT.\n\nDeclassified by X 2006\n\nREST")), markings=("Declassified by X",))
    assert "Declassified" not in r["message_content"] and "REST" in r["message_content"]


@pytest.mark.parametrize("mark", MARKINGS)
def test_declassification_lines_are_known(mark):
    assert len(MARKINGS) == 6
    inside = BODY.replace("1. BODY TEXT.", f"1. BODY TEXT.\n\n{mark}\n\nREST")
    plain, r = parse(telegram()), parse(f"{mark}\n{telegram(inside)}\n{mark}\n")
    assert mark not in r["message_content"] and "REST" in r["message_content"] and r["attrs"] == plain["attrs"]
    assert r["coverage"]["unmatched"] == plain["coverage"]["unmatched"]
    # between attributes, and in a text without a body
    assert parse(telegram(attrs=ATTRS.replace("declassified", f"{mark}\ndeclassified")))["attrs"] == plain["attrs"]
    assert parse(f"{mark}\nno marks")["coverage"]["matched"] == len(mark)


def test_label_tiers():
    assert [label_tier(x) for x in ("SUBJECT", "S U B J", "SUBEJCT", "SUBJEC", "STATE")] == [0, 0, 1, 1, 4]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="AEN O.:-/\n1¿", max_size=200), st.text(alphabet="TypeLocator: \nx", max_size=80))
def test_any_text_is_parsed_and_counted(body, attrs):
    c = parse(telegram(body, attrs))["coverage"]
    assert c["matched"] + c["blank"] + c["unmatched"] == c["total"] == len(telegram(body, attrs))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 20)), max_size=8))
def test_cutting_ranges(ranges):
    text = "abcdefghijklmnopqrst"
    left = "".join(c for i, c in enumerate(text) if not any(s <= i < e for s, e in ranges))
    assert without(text, ranges) == left and all(a[1] < b[0] for a, b in zip(merged(ranges), merged(ranges)[1:]))
