"""X1-X13, X15, X18 as columns: regions, spans of the body, the cut body and the spans of its header, all in the JVM.

The same patterns as ``telegram`` uses, by ``functions.spans``; what needs places in Python is then only the choice among
candidates (X14, X16, X17 and the rules). A text without exactly one mark of each region has no body and null spans.
What carries on from line to line (attributes, addressees) is a fold over a text's lines with a small state.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.spans import EDGE, heads, java, longest, of_name, ranges, spans
from ..functions.text import SPACES, let, marks_null, merge_ranges, na_null, strip, strip_ranges
from . import telegram as T
from .lines import DESIGNATORS

_ANY = "|".join(DESIGNATORS)
#: Lines that ``lines`` reads word by word, as patterns; a letter of a longer label is never given back.
TAGS_LINE = r"(?imd)^[ \t]*TAG[SA]?+[ \t]*[^\s].*$"
HANDLING_LINE = rf"(?imd)^[ \t]*(?:{_ANY})(?:[ \t,;/+\-]+(?:{_ANY}))*[ \t]*$"
#: Any end holds one of them.
_LEAST_ENDS = [e for e in T.ENDS if not any(o != e and o in e for o in T.ENDS)]
RAW = ("classification", "page_break", "end", "footer", "section")
HEADER = {**{name: java(T.SCANS[name]) for name in ("section", "dtg", "from", "dash")}, "tags_line": TAGS_LINE, "handling": HANDLING_LINE}


def _markings(markings: tuple[str, ...]) -> str:
    """Any of them; only places with a first letter of one are tried."""
    if not markings:
        return "(?!)"
    first = "".join(rf"\x{{{ord(m[0]):x}}}" for m in markings if m)
    return f"(?d){f'(?=[{first}])' if all(markings) else ''}(?:" + "|".join(rf"\Q{m}\E" for m in markings) + ")"


def _by_letter(words: list[str]) -> str:
    """Any of some words, told apart by their first letters; none may be the beginning of another one and a colon."""
    rest: dict[str, list[str]] = {}
    for word in sorted(words, key=len, reverse=True):
        rest.setdefault(word[0], []).append(rf"\Q{word[1:]}\E")
    return "|".join(f"{letter}(?:{'|'.join(more)})" for letter, more in rest.items())


KEY_LINE = rf"({_by_letter(T.KEYS)}):"


def scanned(texts: DataFrame, key: str, text: str = "text", markings: tuple[str, ...] = T.MARKINGS) -> DataFrame:
    """key, then arrays of (start, end, value): artifacts, heads and markings in the text, attribute keys behind the second
    head; the body's region, its spans (``body_*``, overlaps resolved), the cut body ``header`` and the spans in it.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    first, second = (java(h) for h in T._HEADS)
    at = lambda part, pattern, held=None: spans(part, pattern, F.col("edged"), held)
    has = lambda part, *words: reduce(or_, [part.contains(w) for w in words])
    head = lambda words, pattern: heads(F.col("whole"), words, pattern, F.col("edged"))
    marked = F.col("whole").contains(T._common(markings)) if markings else F.lit(False)
    found = texts.select(F.col(key).alias("key"), whole.alias("whole"), whole.contains(EDGE).alias("edged")).select(
        "key", "whole", "edged", at(F.col("whole"), T._ARTIFACT, has(F.col("whole"), "¿")).alias("artifacts"), head("Message Text", first).alias("text_head"), head("Message Attributes", second).alias("attribute_head"),
        at(F.col("whole"), _markings(markings), marked).alias("markings"),
    )
    start, end = F.get("text_head", 0)["end"], F.get("attribute_head", 0)["start"]
    one = (F.size("text_head") == 1) & (F.size("attribute_head") == 1) & (start < end)
    behind = F.coalesce(F.get("attribute_head", 0)["end"], F.lit(0))
    found = found.withColumn("region_start", F.when(one, start)).withColumn("region_end", F.when(one, end)).withColumn("raw", F.when(one, _part(F.col("whole"), start, end)))
    keys = F.transform(at(F.substring(F.col("whole"), behind + 1, F.length("whole")), "(?md)^" + KEY_LINE), lambda s: F.struct((s["start"] + behind).alias("start"), (s["end"] + behind).alias("end"), s["value"].alias("value")))
    raw, caps = F.col("raw"), F.col("caps")
    holds = {"page_break": has(caps, "PAGE"), "end": has(raw, *_LEAST_ENDS), "footer": has(raw, "*** Current "), "section": has(caps, "SECTION")}
    found = found.withColumn("caps", F.upper("raw")).withColumn("attribute_keys", keys).withColumn("inside", F.when(one, longest({name: at(raw, T.SCANS[name], holds.get(name)) for name in RAW})))
    found = found.withColumn("valid", _valid(raw, F.col("inside")))
    found = found.withColumn("header", F.when(raw.isNotNull(), _cut()))
    inside = [of_name(F.col("inside"), name).alias(f"body_{name}") for name in RAW]
    holds = {"section": holds["section"], "dash": has(F.col("header"), "-" * 10), "from": has(F.col("header"), "FM"), "tags_line": has(caps, "TAG")}
    header = [F.when(F.col("header").isNotNull(), at(F.col("header"), pattern, holds.get(name))).alias(f"header_{name}") for name, pattern in HEADER.items()]
    covered = F.concat(ranges(F.col("artifacts")), ranges(F.col("text_head")), ranges(F.col("attribute_head")), ranges(F.col("markings")), F.when(one, F.array(F.struct(F.col("region_start").alias("s"), F.col("region_end").alias("e")))).otherwise(F.array().cast("array<struct<s:int,e:int>>")))
    found = found.withColumn("attrs", attributes(F.col("whole"), behind, merge_ranges(covered)))
    found = found.withColumn("routed", routing(F.col("header")))
    return found.select(F.col("key").alias(key), "attrs", F.col("routed")["to"].alias("to"), F.col("routed")["info"].alias("info"), "artifacts", "text_head", "attribute_head", "markings", "attribute_keys", "region_start", "region_end", *inside, "valid", "header", *header)


def _part(text: Column, start: Column, end: Column) -> Column:
    return F.substring(text, start + 1, end - start)


_LINES = "array<string>"


def _line_fold(text: Column, start: Column, step, begin: Column) -> Column:
    """``step(state, line, place)`` over the lines of a text from a place on; the state has a field ``at``."""
    lines = F.split(F.substring(text, start + 1, F.length(text)), "\n", -1)
    return F.aggregate(lines, begin, step)


#: A blank line's characters; a key's own lines, indented ones too; and behind blank lines those up to the next blank one or key.
_BLANK = "[" + "".join(rf"\x{{{ord(c):x}}}" for c in SPACES if c != "\n") + "]*+"
_OWN = r"([^\n]*+(?:\n[ \t][^\n]*+)*+)"
_BELOW = rf"(?:\n{_BLANK}(?=\n|\z))*+((?:\n(?!{_BLANK}(?:\n|\z)|(?:{KEY_LINE[1:-2]}):)[^\n]*+)*+)"
ATTRIBUTE = rf"(?md)^{KEY_LINE}{_OWN}{_BELOW}"
_ACROSS_LINE = rf"(?md)^(?:{'|'.join(sorted(T.ACROSS_BLANKS))}):"


def attributes(text: Column, start: Column, noise: Column) -> Column:
    """Map of the attributes from a place on, as ``telegram`` reads them; the last of a name counts.

    One pattern finds a key with its lines. Where a value may go on across blank lines, which ranges of ``noise`` do not end,
    lines are folded instead.
    """
    own = lambda told: F.regexp_extract(told, rf"^{_OWN}", 1)
    below = lambda told: F.regexp_extract(told, rf"^{_OWN}{_BELOW}", 2)

    def pairs(found: Column) -> Column:
        names = F.transform(found, lambda x: F.substring_index(x, ":", 1))
        return let(names, lambda names: let(F.zip_with(found, names, value), lambda values: mapped(names, F.concat(_but_last(values), F.transform(F.slice(found, -1, 1), last)))))

    def value(x: Column, name: Column) -> Column:
        # blank lines in front and behind go, and only where there are several lines can some stand in between
        told = F.substring(x, F.length(name) + 2, F.length(x))
        lines = lambda bare: F.when(bare.contains("\n"), let(told, lambda t: strip(F.concat(own(t), below(t))))).otherwise(bare)
        return let(let(strip(told), lines), lambda v: F.when(~marks_null(v), v))

    def last(x: Column) -> Column:
        """Lines below count for all keys but the last one."""
        told = F.substring(x, F.length(F.substring_index(x, ":", 1)) + 2, F.length(x))
        return let(strip(own(told)), lambda v: F.when(~marks_null(v), v))

    def mapped(names: Column, values: Column) -> Column:
        every = F.transform(names, lambda n, i: F.struct(n.alias("key"), F.get(values, i).alias("value")))
        later = F.filter(every, lambda x, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), x["key"]))
        return F.when(F.size(F.array_distinct(names)) == F.size(names), F.map_from_arrays(names, values)).otherwise(F.map_from_entries(later))

    tail = F.substring(text, start + 1, F.length(text))
    plain = let(F.regexp_extract_all(tail, F.lit(ATTRIBUTE), F.lit(0)), lambda found: F.when(F.size(found) > 0, pairs(found)).otherwise(F.create_map().cast("map<string,string>")))
    return F.when(tail.rlike(_ACROSS_LINE), let(noise, lambda ranges_: _folded(text, start, ranges_))).otherwise(plain)


def _but_last(values: Column) -> Column:
    return F.slice(values, 1, F.greatest(F.size(values) - 1, F.lit(0)))


def _folded(text: Column, start: Column, noise: Column) -> Column:
    """``attributes`` by a fold over lines, for texts with keys whose values go on across blank lines.

    The state is the key that is open, its indented lines, the lines below those, and whether more can come. Lines below
    count for all keys but the last one.
    """
    shape = f"struct<at:int,name:string,own:{_LINES},below:{_LINES},phase:int,done:array<struct<name:string,own:{_LINES},below:{_LINES}>>>"
    across = lambda name: name.isin(*sorted(T.ACROSS_BLANKS))
    none = F.array().cast(_LINES)

    def closed(s: Column) -> Column:
        return F.when(s["name"].isNull(), s["done"]).otherwise(F.concat(s["done"], F.array(F.struct(s["name"].alias("name"), s["own"].alias("own"), s["below"].alias("below")))))

    def state(at, name, own, below, phase, done) -> Column:
        return F.struct(at.alias("at"), name.alias("name"), own.alias("own"), below.alias("below"), phase.cast("int").alias("phase"), done.alias("done")).cast(shape)

    def step(s: Column, line: Column) -> Column:
        at, end = s["at"], s["at"] + F.length(line)
        key = F.when(line.contains(":"), F.regexp_extract(line, "^" + KEY_LINE, 1)).otherwise("")
        indented = line.startswith(" ") | line.startswith("\t")
        blank = strip(line) == ""
        seen = F.size(s["below"]) > 0
        skipped = across(s["name"]) & F.exists(noise, lambda r: (r["s"] <= at) & (end <= r["e"]))
        add = lambda held: F.concat(held, F.array(line))
        place = end + 1
        own, below, phase = s["own"], s["below"], s["phase"]
        more = (
            F.when(s["name"].isNull() | (phase == 2), state(place, s["name"], own, below, phase, s["done"]))
            .when((phase == 0) & indented, state(place, s["name"], add(own), below, phase, s["done"]))
            .when(blank, state(place, s["name"], own, below, F.when(seen & ~across(s["name"]), 2).otherwise(1), s["done"]))
            .when(skipped, state(place, s["name"], own, below, F.lit(1), s["done"]))
            .otherwise(state(place, s["name"], own, add(below), F.lit(1), s["done"]))
        )
        return F.when(key != "", state(place, key, F.array(line), none, F.lit(0), closed(s))).otherwise(more)

    begin = F.struct(start.cast("int").alias("at"), F.lit(None).cast("string").alias("name"), none.alias("own"), none.alias("below"), F.lit(0).alias("phase"), F.array().cast(f"array<struct<name:string,own:{_LINES},below:{_LINES}>>").alias("done")).cast(shape)
    # the last key is closed without the lines below it
    folded = _line_fold(text, start, step, begin)
    every = let(folded, lambda s: F.when(s["name"].isNull(), s["done"]).otherwise(F.concat(s["done"], F.array(F.struct(s["name"].alias("name"), s["own"].alias("own"), none.alias("below"))))))

    def pairs(all_: Column) -> Column:
        value = lambda x: let(F.substring(F.array_join(F.concat(x["own"], x["below"]), "\n"), F.length(x["name"]) + 2, F.length(text)), na_null)
        final = F.filter(all_, lambda x, i: ~F.exists(F.slice(all_, i + 2, F.size(all_)), lambda y: y["name"] == x["name"]))
        return F.map_from_entries(F.transform(final, lambda x: F.struct(x["name"].alias("key"), value(x).alias("value"))))

    return let(every, pairs)


#: From the first sender's line to the first empty line.
ROUTING = r"(?md)^FM(?=\s)(?:[^\n]++|\n(?!\s*\n))*+"


def routing(header: Column) -> Column:
    """(to, info) of the lines from the first sender to the first empty line; one without a label carries on."""
    shape = f"struct<now:string,to:{_LINES},info:{_LINES}>"

    def told(bare: Column) -> Column:
        labelled = lambda first: F.when(first.startswith("TO "), "to").when(first.startswith("INFO "), "info")
        value = lambda label: F.when(label.isNotNull(), strip(F.substring(bare, F.length(label) + 2, F.length(bare)))).otherwise(bare)
        return let(let(F.upper(F.substring(bare, 1, 5)), labelled), lambda label: F.struct(label.alias("label"), value(label).alias("value")))

    def step(s: Column, line: Column) -> Column:
        now = F.coalesce(line["label"], s["now"])
        held = lambda name: F.when(now == name, F.concat(s[name], F.array(line["value"]))).otherwise(s[name])
        return F.struct(now.alias("now"), held("to").alias("to"), held("info").alias("info")).cast(shape)

    lines = F.filter(F.transform(F.split(F.regexp_extract(header, ROUTING, 0), "\n", -1), strip), lambda bare: bare != "")
    begin = F.struct(F.lit(None).cast("string").alias("now"), F.array().cast(_LINES).alias("to"), F.array().cast(_LINES).alias("info")).cast(shape)
    joined = lambda held: F.when(F.size(held) > 0, F.array_join(held, " "))
    return let(F.aggregate(F.transform(lines, told), begin, step), lambda s: F.struct(joined(s["to"]).alias("to"), joined(s["info"]).alias("info")))


_SPACE = " \n\r\t\x0b\x0c"


def _next_to(raw: Column, inside: Column, chosen) -> Column:
    """``chosen(classification lines, test)``; the test is whether one is next to a page break, before an end mark, or
    near the end of the body.
    """
    blank = lambda x: F.ltrim(x, F.lit(_SPACE)) == ""
    near = lambda a, b: (b - a >= 0) & (b - a < 500) & blank(_part(raw, a, b))

    def one(m: Column, pages: Column, ends: Column) -> Column:
        left = F.length(raw) - m["end"]
        lines = F.size(F.filter(F.split(F.substring(raw, m["end"] + 1, left), "\n"), lambda x: ~blank(x)))
        page = F.exists(pages, lambda p: near(m["end"], p["start"]) | near(p["end"], m["start"]))
        return F.exists(ends, lambda e: near(m["end"], e["start"])) | page | ((left > 0) & (left < 1500) & (lines <= 4))

    of = F.struct(of_name(inside, "page_break").alias("pages"), of_name(inside, "end").alias("ends"))
    return let(of, lambda of: chosen(of_name(inside, "classification"), lambda m: one(m, of["pages"], of["ends"])))


def _valid(raw: Column, inside: Column) -> Column:
    return _next_to(raw, inside, F.filter)


def _cut() -> Column:
    """The body without what is cut out of it; footers and markings go with the line ends around them.

    Spans of the body are in order and apart, so where nothing else is cut they are cut as they stand.
    """
    raw, inside = F.col("raw"), F.col("inside")
    any_valid = _next_to(raw, inside, lambda found, test: F.exists(F.reverse(found), test))  # the last one is the likeliest
    kinds = lambda classed: F.filter(inside, lambda s: s["name"].isin("page_break", "end", *classed))
    plain = F.when(any_valid, kinds(["classification"])).otherwise(kinds([]))
    footers = of_name(inside, "footer")
    within = F.filter("markings", lambda m: (m["start"] >= F.col("region_start")) & (m["start"] < F.col("region_end")))
    artifacts = raw.contains("¿")

    def every(plain: Column) -> Column:
        wide = F.concat(ranges(footers), F.transform(within, _line_of))
        more = F.concat(plain, F.transform(wide, lambda r: _with_line_ends(raw, r)), ranges(spans(raw, T._ARTIFACT, F.col("edged"), artifacts)))
        return merge_ranges(more, touching=False)

    alone = ~artifacts & (F.size("markings") == 0) & ~F.exists(inside, lambda s: s["name"] == "footer")
    return strip_ranges(raw, let(ranges(plain), lambda r: F.when(alone, r).otherwise(every(r))))


def _line_of(m: Column) -> Column:
    """The lines of a marking, their last newline too, in places of the body."""
    raw = F.col("raw")
    start, end = m["start"] - F.col("region_start"), m["end"] - F.col("region_start")
    before = F.length(F.substring_index(F.substring(raw, F.lit(1), start), "\n", -1))
    rest = F.substring(raw, end + 1, F.length(raw))
    behind = F.length(F.substring_index(rest, "\n", 1))
    return F.struct((start - before).alias("s"), F.least(end + behind + 1, F.length(raw)).alias("e"))


#: Line ends around a range are looked for among so many characters first.
_NEAR = 32


def _with_line_ends(raw: Column, r: Column) -> Column:
    """A range and the line breaks around it, all but the first one before it."""
    ends = F.lit("\n\r")

    def run(near: Column, whole: Column, trim) -> Column:
        kept = lambda x: F.length(trim(x, ends))
        return let(near, lambda x: let(kept(x), lambda n: F.when((n > 0) | (F.length(x) == 0), F.length(x) - n).otherwise(let(whole, lambda w: F.length(w) - kept(w)))))

    first = F.greatest(r["s"] - _NEAR, F.lit(0))
    above = run(F.substring(raw, first + 1, r["s"] - first), F.substring(raw, F.lit(1), r["s"]), F.rtrim)
    below = run(F.substring(raw, r["e"] + 1, F.lit(_NEAR)), F.substring(raw, r["e"] + 1, F.length(raw)), F.ltrim)
    return F.struct((r["s"] - F.greatest(above - 1, F.lit(0))).alias("s"), (r["e"] + below).alias("e"))
