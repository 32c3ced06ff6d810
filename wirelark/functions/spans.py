"""Places of all matches of a pattern, as columns: no Python worker reads the text."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import disjoint, let

SHAPE = "array<struct<start:int,end:int,value:string>>"
#: Set around matches, to split a text by; a text that holds it is split by the pattern itself.
EDGE = "\x01"


def java(pattern: re.Pattern) -> str:
    """A pattern in Spark's syntax: case and lines as compiled, and a newline alone ends a line."""
    flags = "".join(letter for letter, flag in (("i", re.IGNORECASE), ("m", re.MULTILINE), ("s", re.DOTALL)) if pattern.flags & flag)
    return f"(?{flags}d){pattern.pattern}"


def _parts(body: Column, own: Column, edged: Column) -> Column:
    """What stands before the first match, the match, what stands up to the next one, and so on, to the text's end.

    Splitting by a pattern compiles it for every text, which costs more than the search. Replacing keeps it compiled, and a
    single character needs no pattern.
    """
    gaps = F.split(body, own, -1)
    pairs = F.flatten(F.zip_with(gaps, F.regexp_extract_all(body, own, F.lit(0)), lambda gap, m: F.array(gap, m)))
    marked = F.regexp_replace(body, own, F.lit(f"{EDGE}$0{EDGE}"))
    return F.when(edged, F.slice(pairs, 1, 2 * F.size(gaps) - 1)).otherwise(F.split(marked, EDGE, -1))


def spans(text: Column, pattern: str | re.Pattern, edged: Column | None = None, held: Column | None = None) -> Column:
    """(start, end, value) of all matches, none over another, in code points from 0; null texts have none.

    A place is the sum of the lengths of all parts before it. ``edged``: whether the text may hold an ``EDGE``; who takes
    spans of many patterns, or of parts of a text, looks for it once. ``held``: whether the text has what every match
    holds; a text without it is not searched.
    """
    own = F.lit(java(pattern) if isinstance(pattern, re.Pattern) else pattern)
    body = F.coalesce(text, F.lit(""))

    def one(parts: Column, m: Column, i: Column) -> Column:
        before = F.aggregate(F.slice(parts, 1, 2 * i + 1), F.lit(0), lambda a, part: a + F.length(part))
        return let(before, lambda start: F.struct(start.alias("start"), (start + F.length(m)).alias("end"), m.alias("value")))

    def placed(parts: Column) -> Column:
        found = F.filter(parts, lambda part, i: i % 2 == 1)
        only = let(F.length(F.get(parts, 0)), lambda start: F.array(F.struct(start.alias("start"), (start + F.length(F.get(parts, 1))).alias("end"), F.get(parts, 1).alias("value"))))
        return F.when(F.size(parts) == 1, F.array().cast(SHAPE)).when(F.size(parts) == 3, only).otherwise(F.transform(found, lambda m, i: one(parts, m, i)))

    found = let(_parts(body, own, body.contains(EDGE) if edged is None else edged), placed)
    return found if held is None else F.when(held, found).otherwise(F.array().cast(SHAPE))


def heads(text: Column, words: str, pattern: str | re.Pattern, edged: Column | None = None) -> Column:
    """``spans`` of a pattern for a line that holds some words alone, blanks around them. Words that stand in a text once are
    found without the pattern.
    """
    blanks = F.lit(" \t")

    def once(at: Column) -> Column:
        before, rest = F.substring(text, F.lit(1), at - 1), F.substring(text, at + len(words), F.length(text))
        return let(F.struct(F.substring_index(before, "\n", -1).alias("lead"), F.substring_index(rest, "\n", 1).alias("tail")), lambda around: line(at, around["lead"], around["tail"]))

    def line(at: Column, lead: Column, tail: Column) -> Column:
        start, end = at - 1 - F.length(lead), at - 1 + len(words) + F.length(tail)
        found = F.array(F.struct(start.alias("start"), end.alias("end"), F.concat(lead, F.lit(words), tail).alias("value")))
        return F.when((F.ltrim(lead, blanks) == "") & (F.ltrim(tail, blanks) == ""), found).otherwise(F.array().cast(SHAPE))

    def placed(at: Column) -> Column:
        return F.when(at == 0, F.array().cast(SHAPE)).when(F.locate(words, F.substring(text, at + 1, F.length(text))) == 0, once(at)).otherwise(spans(text, pattern, edged))

    return let(F.coalesce(F.locate(words, text), F.lit(0)), placed)


def longest(found: Mapping[str, Column]) -> Column:
    """Of overlapping spans of different scans the longer, then the earlier one: (start, end, value, name) by place.

    Spans that lie apart, as nearly always, are only put in order.
    """
    shape = "array<struct<start:int,end:int,value:string,name:string>>"

    def named(name: str, c: Column) -> Column:
        return F.transform(c, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), F.lit(name).alias("name")))

    def ranked(s: Column) -> Column:
        return F.struct((s["start"] - s["end"]).alias("short"), s["start"].alias("start"), s["name"].alias("name"), s["end"].alias("end"), s["value"].alias("value"))

    def add(kept: Column, s: Column) -> Column:
        meets = F.exists(kept, lambda k: (k["start"] < s["end"]) & (s["start"] < k["end"]))
        more = F.concat(kept, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), s["name"].alias("name"))))
        return F.when(meets, kept).otherwise(more).cast(shape)

    def resolved(every: Column) -> Column:
        return F.sort_array(F.aggregate(F.sort_array(F.transform(every, ranked)), F.array().cast(shape), add))

    every = F.sort_array(F.concat(*[named(n, c) for n, c in found.items()]))
    return let(every, lambda all_: F.when(disjoint(all_, "end", "start"), all_).otherwise(resolved(all_)))


def of_name(resolved: Column, name: str) -> Column:
    return F.filter(resolved, lambda s: s["name"] == name)


def ranges(found: Column) -> Column:
    """As ``merge_ranges`` takes them."""
    return F.transform(found, lambda s: F.struct(s["start"].alias("s"), s["end"].alias("e")))
