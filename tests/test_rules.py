"""Rules of one's own, their order, and the readers of lines."""

import pytest

from wirelark.functions.labels import LabelAutomaton, label_tier
from wirelark.plans import lines
from wirelark.plans.extract import extracted
from wirelark.plans.rules import GROUP, RAW, Rule, Rules, ordered, pattern_scan
from wirelark.plans.telegram import DEFAULT, parse

from .test_telegram import BODY, telegram


def nothing(body, found):
    pass


def names(*rules):
    return [r.name for r in ordered(rules)]


def test_rules_run_by_priority_then_by_what_they_name():
    a, b, c, d = Rule("a", nothing, after=("c",)), Rule("b", nothing), Rule("c", nothing, after=("b",)), Rule("d", nothing, priority=RAW)
    assert names(a, b, c, d) == ["d", "b", "c", "a"] == names(d, c, a, b)
    assert names(Rule("x", nothing), Rule("y", nothing)) == ["x", "y"]  # else as registered
    assert [r.name for r in DEFAULT.order][:4] == ["classification", "page_break", "end", "content"] and DEFAULT.order[-1].name == "removal"


@pytest.mark.parametrize(
    "rules, told",
    [
        ([Rule("a", nothing, after=("b",)), Rule("b", nothing, after=("c",)), Rule("c", nothing, after=("a",)), Rule("d", nothing)], "wait for each other: a, b, c"),
        ([Rule("a", nothing, after=("a",))], "wait for each other: a"),
        ([Rule("a", nothing, after=("gone",))], "gone, which is not registered"),
        ([Rule("a", nothing, priority=GROUP, after=("b",)), Rule("b", nothing)], "cannot run after b"),
    ],
)
def test_rules_without_an_order_are_refused(rules, told):
    with pytest.raises(ValueError, match=told):
        Rules(rules=tuple(rules))


def test_names_are_registered_once():
    for again in (lambda: DEFAULT.with_rule(Rule("subject", nothing)), lambda: DEFAULT.with_field("x", "int").with_field("x", "int"), lambda: DEFAULT.with_scan(pattern_scan("s", "a")).with_scan(pattern_scan("s", "b"))):
        with pytest.raises(ValueError, match="registered twice"):
            again()


def _first(body, found):
    body.record["post"] = found[0][1]
    body.add("handling", *found[0].span())  # goes with the header


def _seen(body, found):
    body.record["seen"] = sorted(body.spans)


def test_own_scans_rules_and_fields(spark):
    mine = DEFAULT.with_scan(pattern_scan("post", r"^TO (\w+)")).with_rule(Rule("post", _first, when=lambda b: b.matches("post"), after=("handling",))).with_field("post", "string")
    mine = mine.with_rule(Rule("early", _seen, after=("reference",))).with_field("seen", "array<string>")
    plain, got = parse(telegram()), parse(telegram(), rules=mine)
    assert got["post"] == "SECSTATE" and {"reference", "tags_line"} <= set(got["seen"])
    assert {k: v for k, v in got.items() if k not in ("post", "seen")} == plain
    rows = spark.createDataFrame([(1, telegram()), (2, "no body"), (3, None)], "k int, text string")
    r = {x.k: x for x in extracted(rows, "k", rules=mine).collect()}
    assert (r[1].post, r[2].post, r[3].post) == ("SECSTATE", None, None) and r[1].subject == "TEST SUBJECT LINE"
    assert "handling_restrictions" not in parse(telegram(), rules=DEFAULT.without_rule("handling"))
    with pytest.raises(ValueError, match="after reference, which is not registered"):
        DEFAULT.without_rule("reference")


def test_raw_scans_see_the_body_uncut():
    mine = DEFAULT.with_scan(pattern_scan("pages", r"^PAGE .*$", raw=True)).with_rule(Rule("pages", lambda b, f: b.record.update(pages=len(f)), when=lambda b: b.matches("pages"), priority=RAW))
    assert parse(telegram(), rules=mine)["pages"] == 1
    late = DEFAULT.with_scan(pattern_scan("pages", r"^PAGE .*$")).with_rule(Rule("pages", lambda b, f: b.record.update(pages=len(f)), when=lambda b: b.matches("pages")))
    assert "pages" not in parse(telegram(), rules=late)


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute_tier(word):
    d = min(plain_distance(word, w) for w in ("SUBJECT", "SUBJ"))
    exchanged = any(word == w[:i] + w[i + 1] + w[i] + w[i + 2 :] for w in ("SUBJECT", "SUBJ") for i in range(len(w) - 1))
    return 1 if exchanged and d > 1 else min(d, 5)


def edited(word):
    for i in range(len(word) + 1):
        for c in "SUBJECTX4":
            yield word[:i] + c + word[i:]
            if i < len(word):
                yield word[:i] + c + word[i + 1 :]
        if i < len(word):
            yield word[:i] + word[i + 1 :]
            if i + 1 < len(word):
                yield word[:i] + word[i + 1] + word[i] + word[i + 2 :]


def test_the_automaton_has_the_tiers_of_all_labels_within_two_edits():
    one = {x for w in ("SUBJECT", "SUBJ") for x in edited(w)}
    every = one | {y for x in one for y in edited(x)} | {"", "X", "STATE", "REFERENCE"}
    assert len(every) > 10_000 and [w for w in every if label_tier(w) != brute_tier(w)] == []
    own = LabelAutomaton(("AB",), 2)
    assert [own.distance(w) for w in ("AB", "BA", "B", "ABAB", "")] == [0, 1, 1, 2, 2] and len(own.states) < 30


@pytest.mark.parametrize(
    "line, label, tier, value",
    [
        ("SUBJECT: A", "SUBJECT", 0, "A"), ("  S U B J : A", "SUBJ", 0, "A"), ("SUBJECTW/W A", "SUBJECT", 0, "W/W A"), ("SUBJ A", "SUBJ", 0, "A"), ("SUBECT A", "SUBECT", 1, "A"),
        ("SUBJECTS A", None, 0, ""), ("SUBJECTS: A", "SUBJECTS", 1, "A"), ("SUBJ8 A", "SUBJ8", 1, "A"), ("SXBJX: A", "SXBJX", 2, "A"), ("SXBJX A", None, 0, ""), ("SU*JECT: A", "SU*JECT", 1, "A"),
        ("SUBJ - A", "SUBJ", 0, "- A"), ("SUBJECT- A", "SUBJECT", 0, "A"), ("SUBEJCT- A", None, 0, ""), ("S X SUBJ: A", "SUBJ", 0, "A"), ("TAGSSUBJECT: A", "SUBJECT", 0, "A"), ("SXXJE:5: A", "SXXJE:5", 2, "A"), ("ABCDE: A", None, 0, ""),
    ],
)
def test_subject_labels(line, label, tier, value):
    found = lines.subject_candidates(line)
    assert [(f.label, t, line[f.value_at : f.end]) for f, t in found] == ([(label, tier, value)] if label else [])


@pytest.mark.parametrize("line, value", [("TAGS: A", "A"), (" TAGA. A", "A"), ("TAG A", "A"), ("TAGSX: A", "A"), ("TAGSX A", "X A"), ("TAGS:", ":"), ("TAGS", None), ("TA: A", None)])
def test_tags_lines(line, value):
    at = lines.tags_line(line)
    assert (None if at is None else line[at:]) == value


@pytest.mark.parametrize("line, bare, whole", [("E.O. 11652: GDS", False, True), ("EO 11652 GDS", False, False), ("E.O.: 11652: GDS", False, False), ("E. O.. GDS", True, False), ("E.O. N/A", True, False), ("E.O. 12065:", False, False)])
def test_order_lines(line, bare, whole):
    assert lines.order_line(line) == lines.OrderLine(bare, whole)


def test_lines_that_are_none():
    assert lines.order_line("E.O. GDSX") is None and lines.order_line("EARLY") is None and lines.stated_sum("a/b 3", 0, 5) is None and lines.dash_line("   ----------", 0) is None
    assert not lines.handling_line("LIMDIS X") and lines.handling_line("  LIMDIS, NOFORN ") and lines.begins_body("12. A") and not lines.begins_body("SUMMARYX")
    assert lines.reference_candidates("PREF A\nREFX\nXREF") == [] or [f.label for f, _ in lines.reference_candidates("PREF A\nREFX\nXREF")] == ["REFX"]


def test_a_subject_below_which_a_reference_but_no_blank_line_comes():
    body = BODY.replace("SUBJECT: TEST SUBJECT\n     LINE\n\nREF: A. STATE 105386\n\n1. BODY TEXT.\n\nCONFIDENTIAL\nNNN\n\n", "SUBJECT: TEST\nREF: A. STATE 1\n1. TEXT\n")
    assert parse(telegram(body))["subject"] == "TEST"
