"""Scalar text functions: stripping, null markers, previews, spans of characters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Blanks that a strip takes: ASCII blanks, separators U+001C-1F, NEL, NBSP and the Unicode spaces.
SPACES = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0                　"


def let(value: Column, then) -> Column:
    """``then`` of a value that is computed once, however often ``then`` names it."""
    return F.get(F.transform(F.array(value), lambda v: then(v)), 0)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def is_na(c: Column) -> Column:
    """null, or ``n/a``, ``na`` or nothing in any case."""
    return marks_null(strip(c))


def marks_null(value: Column) -> Column:
    """Of a stripped value; only a short one can be a marker, and is put in lower case."""
    return value.isNull() | ((F.length(value) <= 3) & F.lower(value).isin("n/a", "na", ""))


def na_null(c: Column, name: str | None = None) -> Column:
    """the stripped value without its ``name:``; null markers are null."""
    value = strip(c)
    if name:
        value = F.when(value.startswith(f"{name}:"), strip(F.substring(value, len(name) + 2, 1 << 30))).otherwise(value)
    return F.when(marks_null(value), F.lit(None)).otherwise(value)


def preview(c: Column, lines: int = 100) -> Column:
    """the first lines."""
    return F.substring_index(c, "\n", lines)


def disjoint(ranges: Column, end: str = "e", start: str = "s", touching: bool = True) -> Column:
    """Whether sorted ranges with integer ends lie apart; ``touching``: whether they may touch."""
    most, least = F.lit(2**31 - 1), F.lit(-(2**31))
    meets = lambda upto, r: (r[start] < upto) if touching else (r[start] <= upto)
    return F.aggregate(ranges, least, lambda upto, r: F.when(meets(upto, r), most).otherwise(r[end])) != most


def merge_ranges(ranges: Column, touching: bool = True) -> Column:
    """array of (s, e), overlapping or touching ones as one, in order. Empty ranges go.

    ``touching``: whether ranges that touch have to be one, which those that are cut out need not. Ranges that lie apart are
    only put in order.
    """
    shape = "array<struct<s:int,e:int>>"
    cast = F.transform(F.filter(ranges, lambda r: r["e"] > r["s"]), lambda r: F.struct(r["s"].cast("int").alias("s"), r["e"].cast("int").alias("e")))

    def add(done: Column, r: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        longer = F.struct(last["s"].alias("s"), F.greatest(last["e"], r["e"]).alias("e"))
        return F.when((F.size(done) > 0) & (r["s"] <= last["e"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(r)))

    return let(F.sort_array(cast), lambda all_: F.when(disjoint(all_, touching=not touching), all_).otherwise(F.aggregate(all_, F.array().cast(shape), add)))


def strip_ranges(text: Column, merged: Column) -> Column:
    """The text without merged ranges (as of ``merge_ranges``)."""

    def kept(merged: Column) -> Column:
        ends = F.concat(F.array(F.lit(0)), F.transform(merged, lambda r: r["e"]))
        starts = F.concat(F.transform(merged, lambda r: r["s"]), F.array(F.length(text)))
        return F.array_join(F.zip_with(ends, starts, lambda a, b: F.substring(text, a + 1, b - a)), "")

    return let(merged, kept)


def coverage(text: Column, merged: Column) -> Column:
    """(total, matched, blank, unmatched) characters; blanks outside the ranges are forgiven."""
    rest = strip_ranges(text, merged)
    blank = F.length(rest) - F.length(F.translate(rest, SPACES, ""))
    total = F.length(text)
    return F.struct(total.alias("total"), (total - F.length(rest)).alias("matched"), blank.alias("blank"), (F.length(rest) - blank).alias("unmatched"))
