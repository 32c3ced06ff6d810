"""What telegrams' lines say (X14-X18 and the lines that R13, R17 and R20 look for), read word by word.

Every reader takes a text or a line and gives places in it. Blanks are spaces and tabs; letters count in either case
unless a reader says otherwise.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache, wraps
from typing import NamedTuple

from ..functions.labels import label_tier

# Labels, order numbers, tokens of order lines, designators, and the longest value of a reference.
REFERENCE_LABELS = {"REF", "REFS", "REFTEL", "RETEL", "RETELS", "REFERENCE", "REFERENCES"}
ORDERS = ("11652", "11653", "12065")
ORDER_TOKENS = {"NA", "GDS", "XGDS", "NGDS", "RDS", "XDS", "GS", "GDA", "DECLAS"}
DESIGNATORS = ["EXDIS", "NODIS", "LIMDIS", "NOFORN", "FOUO", "NESCO", "STADIS", "ONLY", "LOU"]
PLAIN_SUBJECT = {"SUBJECT", "SUBJT", "SUBJ8", "SUBJ4", "SUBJ", "SUB", "SUJ"}
REFERENCE_LENGTH = 200
#: Characters beside letters and digits that a garbled subject label may hold.
GARBLE = "/'*?$-"

BLANKS, MARKS = " \t", ":;/.,-"
#: How many short lines' readings a worker keeps: many a line of a header stands in very many telegrams.
KEPT_LINES, SHORT = 1 << 12, 100
_LETTERS = re.compile(r"[A-Za-z]+")
_TOKEN = re.compile(r"[A-Za-z0-9]+")
_EMPTY_LINE = re.compile(r"\n[ \t]*\n")


def lines_of(text: str, start: int = 0, end: int | None = None) -> Iterator[tuple[int, str]]:
    """(place, line) without line ends; the first line begins at ``start``."""
    at = start
    for line in (text[start:end] if start or end is not None else text).split("\n"):
        yield at, line
        at += len(line) + 1


def _kept(read: Callable) -> Callable:
    """A reader of one line that keeps what it read of short lines."""
    held = lru_cache(maxsize=KEPT_LINES)(read)
    return wraps(read)(lambda line: held(line) if len(line) <= SHORT else read(line))


def capitals(text: str) -> str | None:
    """A line end and the text in capitals, to look for words in: what stands at a line's start is found behind a line end
    whose place is that of the word in the text. Null if a letter beyond ASCII might count as one of a word.
    """
    plain = text if text.isascii() else text.replace("¿", "?")
    return "\n" + plain.upper() if plain.isascii() else None


def beginning(caps: str, *words: str) -> list[int]:
    """Places of the lines that begin with one of some words, in order."""
    out = []
    for word in words:
        at = caps.find("\n" + word)
        while at >= 0:
            out.append(at)
            at = caps.find("\n" + word, at + 1)
    return sorted(out) if len(words) > 1 else out


def containing(caps: str, word: str) -> list[int]:
    """Places of the lines that hold a word, in order."""
    out, at = [], caps.find(word)
    while at >= 0:
        out.append(caps.rfind("\n", 0, at))
        end = caps.find("\n", at)
        at = caps.find(word, end) if end >= 0 else -1
    return out


def end_of_line(text: str, at: int) -> int:
    end = text.find("\n", at)
    return len(text) if end < 0 else end


def past_blanks(line: str, at: int) -> int:
    while at < len(line) and line[at] in BLANKS:
        at += 1
    return at


def before_blanks(text: str, at: int) -> int:
    while at and text[at - 1] in BLANKS:
        at -= 1
    return at


class Found(NamedTuple):
    """A labelled line or part of one: from the blanks before the label to the end of the value."""

    start: int
    label_at: int
    end: int
    label: str
    separator: str
    value_at: int


# ---------------------------------------------------------------- X14: references


def reference_candidates(text: str) -> list[tuple[Found, bool]]:
    """(label and value, whether other words stand before it on its line). What a value takes in is not looked at again."""
    out, upto = [], 0
    upper = text.upper() if text.isascii() else "".join(c.upper() if c.isascii() else c for c in text)
    at = _next_of(upper, ("REF", "RET"), 0)
    while at >= 0:
        before = before_blanks(text, at)
        if at >= upto and (before < at or not at or text[at - 1] == "\n") and before >= upto - (before < at):
            word = _LETTERS.match(upper, at)[0]
            end = at + len(word)
            known = word in REFERENCE_LABELS or (len(word) == 4 and word.startswith("REF"))
            closed = lambda e: e == len(text) or text[e] in BLANKS + MARKS + "\n"
            if known and text[end : end + 1] == "." and closed(end + 1):
                end += 1
            if known and closed(end):
                value = past_blanks(text, end)
                if text[value : value + 1] == ":":
                    value = past_blanks(text, value + 1)
                stop = _EMPTY_LINE.search(text, value)
                last = min(value + REFERENCE_LENGTH, len(text), stop.start() if stop else len(text))
                begin = max(before, upto)
                inline = begin > 0 and bool(text[text.rfind("\n", 0, at) + 1 : at].strip())
                cut = min(last, end_of_line(text, at)) if inline else last
                out.append((Found(begin, at, cut, text[at:end], text[end:value], value), inline))
                upto = last
        at = _next_of(upper, ("REF", "RET"), at + 1)
    return out


def _next_of(text: str, words: tuple[str, ...], at: int) -> int:
    places = [p for p in (text.find(w, at) for w in words) if p >= 0]
    return min(places, default=-1)


# ---------------------------------------------------------------- X15: tags


@_kept
def tags_line(line: str) -> int | None:
    """Where the value of a line of tags begins: behind TAGS, TAGA or TAG, a letter stuck to it, and a mark."""
    at = len(line) - len(line.lstrip(BLANKS))
    if line[at : at + 3].upper() != "TAG":
        return None
    at += 3 + (line[at + 3 : at + 4].upper() in {"S", "A"})
    if line[at : at + 1].isascii() and line[at : at + 1].isalpha() and line[at + 1 : at + 2] in tuple(MARKS):
        at += 1
    at = past_blanks(line, at)
    if line[at : at + 1] in tuple(MARKS):
        value = past_blanks(line, at + 1)
        at = value if line[value:].strip() else at  # a mark alone is the value
    return at if line[at : at + 1].strip() else None


# ---------------------------------------------------------------- X16: executive orders


class OrderLine(NamedTuple):
    """A line of an executive order: whether it gives a bare value, and whether number, colon and value are all there."""

    bare: bool
    whole: bool


def has_order_token(text: str) -> bool:
    upper = text.upper()
    words = list(_LETTERS.finditer(upper))
    if any(w[0] in ORDER_TOKENS for w in words):
        return True
    return any(a[0] == "N" and b[0] == "A" and upper[a.end() : b.start()] == "/" for a, b in zip(words, words[1:]))


@_kept
def order_line(line: str) -> OrderLine | None:
    """``E.O. 11652: GDS`` and its like; without a number, a value with a known token."""
    at = len(line) - len(line.lstrip(BLANKS))
    if line[at : at + 1] not in ("E", "e") or "\r" in line:
        return None
    at = past_blanks(line, at + 1)
    for _ in range(2):
        at += line[at : at + 1] == "."
    at = past_blanks(line, at)
    if line[at : at + 1].upper() != "O":
        return None
    at = past_blanks(line, at + 1)
    at = past_blanks(line, at + (line[at : at + 1] == "."))
    number = past_blanks(line, at + 1) if line[at : at + 1] == ":" else at
    if line.startswith(ORDERS, number):
        mark = past_blanks(line, number + 5)
        value = past_blanks(line, mark + 1) if line[mark : mark + 1] in tuple(":;,/.'$-") else mark
        return OrderLine(False, number == at and line[mark : mark + 1] == ":" and bool(line[value:].strip(BLANKS)))
    return OrderLine(True, False) if has_order_token(line[at:]) else None


# ---------------------------------------------------------------- X17: subjects


def _spaced(line: str, at: int, word: str) -> int | None:
    """The end of a word whose letters may stand apart."""
    for k, letter in enumerate(word):
        at = past_blanks(line, at) if k else at
        if line[at : at + 1].upper() != letter:
            return None
        at += 1
    return at


def _colon_follows(line: str, at: int) -> bool:
    return line.startswith(":", past_blanks(line, at))


@lru_cache(maxsize=1 << 16)
def _plain_tier(token: str) -> tuple[int, bool] | None:
    """(tier, whether a mark has to follow) of a word in capitals at most one edit from a whole label, else None."""
    if token in PLAIN_SUBJECT:
        return label_tier(token), False
    if len(token) > 8 or label_tier(token) > 1:
        return None
    return 1, any(token[:-1] == w and token[-1] != w[-1] for w in ("SUBJECT", "SUBJ"))


@lru_cache(maxsize=1 << 16)
def _far(token: str) -> bool:
    """A word that is no label by itself, and before which none begins that ends behind it."""
    return "BJ" not in token.upper() and label_tier(token) > 4


def _plain_reading(line: str, at: int, end: int) -> tuple[int, int] | None:
    found = _plain_tier(line[at:end].upper())
    if found and (not found[1] or line.startswith((":", ".", ";"), past_blanks(line, end))):
        return end, found[0]
    return None


def _readings(line: str, at: int, end: int, colon: int) -> Iterator[tuple[int, int]]:
    """(end, tier) of the labels that may begin with the token from ``at`` to ``end``, the likeliest first.

    ``colon``: the next one behind the place, or -1.
    """
    may_begin = line[at] in "Ss"
    if may_begin and (end - at == 1 or line[at + 1] in "Uu"):
        for word in ("SUBJECT", "SUBJ"):
            if whole := _spaced(line, at, word):
                yield whole, 0
    if found := _plain_reading(line, at, end):
        yield found
    if line[end - 1 : end + 2].upper() == "W/W" and end - 1 > at and (found := _plain_reading(line, at, end - 1)):
        yield found
    if colon < 0:
        return
    if may_begin and 2 < colon - at <= 9 and all(c.isascii() and (c.isalnum() or c in GARBLE) for c in line[at:colon]) and line[colon + 1 : colon + 2] == "5" and _colon_follows(line, colon + 2):
        yield colon + 2, 2
    if 3 <= end - at <= 10 and _colon_follows(line, end):
        yield end, label_tier(line[at:end])
    if may_begin:
        last = before_blanks(line, colon)
        inside = line[at:last]
        if 3 <= len(inside) <= 15 and inside[-1].isascii() and inside[-1].isalnum() and all(c.isascii() and (c.isalnum() or c in BLANKS + GARBLE) for c in inside):
            yield last, _garbled_tier(inside)


def _garbled_tier(label: str) -> int:
    """Blanks inside count as letters too many; a label that runs into a second one is none."""
    parts = label.upper().split()
    if len(parts) > 1 and parts[-1].startswith("SUBJ"):
        return 9
    return label_tier(label.upper().translate({32: "_", 9: "_"}))


def _behind(line: str, end: int) -> tuple[str, int] | None:
    """(separator, place of the value) behind a label."""
    at = past_blanks(line, end)
    tries = []
    if line[at : at + 1] in tuple(":;/.,"):
        tries.append(past_blanks(line, at + 1))
    if line[end : end + 1] == "-":
        tries.append(past_blanks(line, end + 1))
    if at > end:
        tries.append(at)
    if line[end : end + 3].upper() == "W/W":
        tries.append(end)
    value = next((v for v in tries if line[v : v + 1].strip()), None)
    return None if value is None else (line[end:value], value)


#: Where a label may begin: at the line's start, behind blanks, behind a colon or behind TAGS; with an S and a colon near
#: enough or a letter of SUBJ behind it, else as a word before a colon or one with a BJ. Nothing else is within reach of a label.
_LABEL_PLACE = re.compile(
    r"(?:(?<![^ \t:])|(?<=TAGS))(?:S(?=[^:]{0,14}[ \t]*:|[ \t]*U|[A-Z0-9]*[UB])|(?!S)[A-Z0-9](?=[A-Z0-9]{2,9}[ \t]*:|[A-Z0-9]*BJ))",
    re.IGNORECASE | re.ASCII,
)
#: What a line with such a place holds, in capitals, if neither a colon nor BJ.
_LABEL_HINT = re.compile(r"S(?:(?<=[ \t\n]S)|(?<=TAGSS))(?=[ \t]*U|[A-Z0-9]*[UB])")


def _label_lines(text: str, caps: str | None) -> Iterator[tuple[int, str]]:
    """(place, line) of the lines in which a label may begin."""
    if caps is None:
        yield from lines_of(text)
        return
    places = {*containing(caps, ":"), *containing(caps, "BJ"), *[caps.rfind("\n", 0, m.end()) for m in _LABEL_HINT.finditer(caps)]}
    for start in sorted(places):
        yield start, text[start : end_of_line(text, start)]


def subject_candidates(text: str, caps: str | None = None) -> list[tuple[Found, int]]:
    """(label and value, tier) of the first label of each line that is near enough; one that is not hides no later one.

    ``caps``: the text's ``capitals``, if they are there.
    """
    out = []
    for start, line in _label_lines(text, caps):
        if label := _first_label(line):
            before, at, plain, separator, value, tier = label
            out.append((Found(start + before, start + at, start + len(line), plain, separator, start + value), tier))
    return out


def plain_subject(found: Found) -> bool:
    """A plain label with a colon, no blanks before it."""
    return found.label in PLAIN_SUBJECT and ":" in found.separator and found.start == found.label_at


_SUBJECT_LINE = re.compile(r"\n(?=S[ \t]*U)")


def first_plain_subject(text: str, caps: str) -> tuple[Found, int] | None:
    """Of ``subject_candidates``, the first plain one at the start of a line; its label begins with SU."""
    for m in _SUBJECT_LINE.finditer(caps):
        start = m.start()
        line = text[start : end_of_line(text, start)]
        if (label := _first_label(line)) and not label[1]:
            _, _, plain, separator, value, tier = label
            found = Found(start, start, start + len(line), plain, separator, start + value)
            if plain_subject(found):
                return found, tier
    return None


@_kept
def _first_label(line: str) -> tuple[int, int, str, str, int, int] | None:
    """(place of the blanks before it, place, label, separator, place of the value, tier) of a line's first label."""
    for place in _LABEL_PLACE.finditer(line):
        at = place.start()
        token, colon = _TOKEN.match(line, at).end(), line.find(":", at)
        if line[at] not in "Ss":
            if _far(line[at:token]):
                continue
        elif colon == token > at + 1 and line[at + 1] not in "Uu" and line[colon + 1 : colon + 2] != "5" and _far(line[at:token]):
            continue
        read = next(((e, tier, told) for e, tier in _readings(line, at, token, colon) if (told := _behind(line, e))), None)
        if read is None:
            continue
        end, tier, (separator, value) = read
        label = line[at:end].upper()
        if separator.startswith("-") and label not in ("SUBJECT", "SUBJ"):
            continue
        if tier < 4 or (tier == 4 and len(label) >= 6):
            return before_blanks(line, at), at, "".join(label.split()) if tier == 0 else label, separator, value, tier
    return None


def begins_body(line: str) -> bool:
    """A numbered paragraph, or a summary."""
    bare = line.lstrip(BLANKS)
    digits = len(bare) - len(bare.lstrip("0123456789"))
    if digits and bare[digits : digits + 1] in (".", ")"):
        return True
    rest = bare[7:]
    return bare[:7].upper() == "SUMMARY" and (not rest or rest.lstrip(BLANKS)[:1] in (":", ".", ";"))


# ---------------------------------------------------------------- X18: designators


@_kept
def handling_line(line: str) -> bool:
    """A line of designators and marks between them alone."""
    first = _LETTERS.match(line, len(line) - len(line.lstrip(BLANKS)))
    if not first or first[0].upper() not in DESIGNATORS:
        return False
    bare = line.strip(BLANKS)
    words = bare.translate(dict.fromkeys(map(ord, ",;/+-\t"), " ")).upper().split()
    return bool(words) and bare[0].isalpha() and bare[-1].isalpha() and all(w in DESIGNATORS for w in words) and "\r" not in bare


# ---------------------------------------------------------------- R13: distribution


def distribution_start(text: str, start: int = 0, end: int | None = None) -> tuple[int, int, str] | None:
    """(start of the line, end of the word, word) of the first line that begins with ACTION or ORIGIN in capitals."""
    end = len(text) if end is None else end
    best = None
    for name in ("ACTION", "ORIGIN"):
        word = text.find(name, start, end)
        while word >= 0:
            line, after = before_blanks(text, word), text[word + len(name) : min(word + len(name) + 1, end)]
            if line >= start and (not line or text[line - 1] == "\n") and not (after.isalnum() or after == "_"):
                if best is None or line < best[0]:
                    best = line, word + len(name), name
                break
            word = text.find(name, word + 1, end)
    return best


def stated_sum(text: str, start: int, end: int) -> tuple[int, int] | None:
    """(place behind its line and the empty lines below, sum) of the first line that ends with a slash and a number.

    A letter R or W may stand behind the number.
    """
    at = text.find("/", start, end)
    while at >= 0:
        digits = at + 1
        while digits < end and text[digits].isspace():
            digits += 1
        last = digits
        while last < end and text[last].isdecimal():
            last += 1
        letter = last
        while letter < end and text[letter].isspace():
            letter += 1
        if letter > last and text[letter : letter + 1] in ("R", "W") and not text[letter + 1 : min(end_of_line(text, letter + 1), end)].strip():
            eol = min(end_of_line(text, letter + 1), end)
        else:
            eol = min(end_of_line(text, last), end)
            letter = last - 1
        if last > digits and not text[letter + 1 : eol].strip():
            here = eol
            while here < end and text[here].isspace():
                here += 1
            if here < end:
                here = text.rfind("\n", 0, here)
            return text.find("\n", min(here, end)) + 1 or len(text), int(text[digits:last])
        at = text.find("/", at + 1, end)
    return None


def dash_line(text: str, start: int, end: int | None = None) -> int | None:
    """Where a line of ten dashes or more behind four blanks or more begins, empty lines above it taken in."""
    end = len(text) if end is None else end
    at = text.find("-" * 10, start, end)
    while at >= 0:
        space = start + len(text[start:at].rstrip())
        begin = space if not space or text[space - 1] == "\n" else text.find("\n", space, at) + 1
        if (begin or not space) and begin >= start and at - begin >= 4:
            return begin
        while at < end and text[at] == "-":
            at += 1
        at = text.find("-" * 10, at, end)
    return None


# ---------------------------------------------------------------- R17: drafters


def _drafted_ends(line: str) -> Iterator[int]:
    """Ends of the label of a drafter's line: DRAFTED, with BY (Y BY) or one or two characters behind it, longest first."""
    if line[:7].upper() != "DRAFTED":
        return
    word = past_blanks(line, 8)
    if line[7:8].upper() == "Y" and word > 8 and line[word : word + 2].upper() == "BY":
        yield word + 2
    word = past_blanks(line, 7)
    if line[word : word + 2].upper() == "BY":
        yield word + 2
    if word > 7:
        for size in (2, 1):
            if len(short := line[word : word + size]) == size and short.isascii() and short.isalnum():
                yield word + size
    yield 7


def _approved_ends(line: str) -> Iterator[int]:
    if line[:8].upper() not in ("APPROVED", "EPPROVED"):
        return
    word = past_blanks(line, 8)
    if line[word : word + 2].upper() == "BY" and (line[0] in "Aa" or word > 8):
        yield word + 2
    if line[0] in "Aa":
        yield 8


def _strictly_drafted(line: str) -> Iterator[int]:
    word = past_blanks(line, 7)
    if line[:7].upper() == "DRAFTED" and word > 7 and line[word : word + 2].upper() == "BY":
        yield word + 2


DRAFTING = {"drafted": _drafted_ends, "approved": _approved_ends, "strictly drafted": _strictly_drafted}


#: The same in one search, for lines in ASCII: labels in the order tried, then a mark or blanks, or the next block's first words.
_DRAFTED = r"DRAFTED(?:Y[ \t]+BY|[ \t]*BY|[ \t]+[A-Z0-9]{2}|[ \t]+[A-Z0-9]|)"
_APPROVED = r"(?:APPROVED(?:[ \t]*BY|)|EPPROVED[ \t]+BY)"
_VALUE = {
    kind: re.compile(label + r"(?:[ \t]*[:=-][ \t]*|[ \t]+)", re.IGNORECASE | re.ASCII)
    for kind, label in (("drafted", _DRAFTED), ("approved", _APPROVED), ("strictly drafted", r"DRAFTED[ \t]+BY"))
}
_NEXT_BLOCK = re.compile(rf"(?:{_DRAFTED}|{_APPROVED}|DESIRED DISTRIBUTION|DESIRED DISTB|DISTRIBUTION)(?!\w)", re.IGNORECASE | re.ASCII)


def drafting_value(line: str, kind: str) -> int | None:
    """Where the value of a drafter's or approver's line begins: behind a mark or blanks."""
    if line.isascii():
        m = _VALUE[kind].match(line)
        return m and m.end()
    for end in DRAFTING[kind](line):
        mark = past_blanks(line, end)
        if line[mark : mark + 1] in (":", "=", "-"):
            return past_blanks(line, mark + 1)
        if mark > end:
            return mark
    return None


def ends_drafting(line: str) -> bool:
    """A line that begins the next block: a drafter, an approver or a distribution."""
    if line.isascii():
        return _NEXT_BLOCK.match(line) is not None
    ends = [*DRAFTING["drafted"](line), *DRAFTING["approved"](line)]
    ends += [len(w) for w in ("DESIRED DISTRIBUTION", "DESIRED DISTB", "DISTRIBUTION") if line[: len(w)].upper() == w]
    return any(not (line[e : e + 1].isalnum() or line[e : e + 1] == "_") for e in ends)
