"""Dates of attributes, date-time groups and filing times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# Date formats in the order tried, month names, precedence letters, plausible years.
FORMATS = ["d MMM yyyy", "d-MMM-yyyy h:mm:ss a", "d-MMM-yyyy", "d/M/yyyy", "yyyy-M-d'T'H:m:s", "yyyy-M-d"]
#: What a text of each format holds; another one is not tried, since a failed try costs far more than this.
_SHAPES = ["% % %", "%-%-% %:%:%", "%-%-%", "%/%/%", "%-%-%:%:%", "%-%-%"]
_WITH_LETTERS = {"d MMM yyyy", "d-MMM-yyyy h:mm:ss a", "d-MMM-yyyy", "yyyy-M-d'T'H:m:s"}
MONTHS = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]
PRECEDENCE = {"Z": "FLASH", "O": "IMMEDIATE", "P": "PRIORITY", "R": "ROUTINE"}
FIRST_YEAR, LAST_YEAR = 1973, 1979
_WHOLE = ["JANUARY", "FEBRUARY", "MARCH", "APRIL", "JUNE", "JULY", "AUGUST", "SEPTEMBER", "OCTOBER", "NOVEMBER", "DECEMBER"]


def _apart(word: str) -> str:
    """A pattern of a word whose letters may stand apart."""
    return r"\s*".join(word)


#: One or two letters of precedence, day, hour, minute, month and year at the start of a line, characters perhaps
#: apart; for Python and for Spark, multi-line.
DTG = r"^[ \t]*([ZOPR](?:[ \t]*[ZOPR])?)[ \t]+" + r"\s*".join([r"(\d\s*\d)"] * 3) + rf"\s*Z?\s*({'|'.join(map(_apart, _WHOLE + MONTHS))})\s*(\d\s*\d)(?!\d)"


def parse_date(raw: Column) -> Column:
    """ISO date of an attribute's date, whatever its format; null if no format fits."""
    text = F.regexp_replace(strip(raw), r"\s+", " ")
    may = lambda f, shape: text.like(shape) & text.rlike(r"\p{L}") if f in _WITH_LETTERS else text.like(shape)
    return F.date_format(F.coalesce(*[F.when(may(f, shape), F.try_to_timestamp(text, F.lit(f))) for f, shape in zip(FORMATS, _SHAPES, strict=True)]), "yyyy-MM-dd")


def full_year(yy: Column) -> Column:
    """00-05 are of this century."""
    y = yy.try_cast("int")
    return F.when(y <= 5, 2000 + y).otherwise(1900 + y)


def stamp(yy: Column, mon: Column, dd: Column, hh: Column, mm: Column, first: int = FIRST_YEAR, last: int = LAST_YEAR) -> Column:
    """ISO date and time, if it is on the calendar and in the years; else null."""
    month = F.array_position(F.lit(MONTHS), mon)
    year = full_year(yy)
    day, hour, minute = (c.try_cast("int") for c in (dd, hh, mm))
    ok = year.between(first, last) & month.between(1, 12) & day.between(1, 31) & hour.between(0, 23) & minute.between(0, 59)
    made = F.try_make_timestamp_ntz(year, month.cast("int"), day, hour, minute, F.lit(0).cast("decimal(16,6)"))
    return F.when(ok, F.date_format(made, "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def precedences(raw: Column) -> Column:
    """Names of precedence letters; other letters stay as they are, nothing gives an empty array."""
    names = F.create_map(*[F.lit(x) for pair in PRECEDENCE.items() for x in pair])
    letters = F.filter(F.split(F.coalesce(raw, F.lit("")), r"\s+"), lambda p: p != "")
    return F.transform(letters, lambda p: F.coalesce(names[p], p))


def parse_dtg(dtg: Column) -> Column:
    """(raw, precedence, datetime_iso) of a group's parts, or null."""
    at = stamp(dtg["yy"], dtg["mon"], dtg["dd"], dtg["hh"], dtg["mm"])
    return F.when(at.isNotNull(), F.struct(dtg["raw"].alias("raw"), precedences(dtg["precedence_raw"]).alias("precedence"), at.alias("datetime_iso")))


def dtg_parts(raw: Column) -> Column:
    """The parts of a date-time group in raw text whose characters may be apart; null if there is none."""
    pattern = f"(?m){DTG}"
    part = lambda i: F.regexp_replace(F.regexp_extract(raw, pattern, i), r"\s+", "")
    whole = F.regexp_replace(strip(F.regexp_extract(raw, pattern, 0)), r"\s+", " ")
    letters = F.array_join(F.split(part(1), ""), " ")
    found = F.struct(
        whole.alias("raw"), letters.alias("precedence_raw"), part(2).alias("dd"), part(3).alias("hh"), part(4).alias("mm"),
        F.substring(part(5), 1, 3).alias("mon"), part(6).alias("yy"),
    )
    return F.when(raw.rlike(pattern), found)


def filing_stamp(filing: Column, dtg: Column) -> Column:
    """F8: ISO date and time of DDHHMMZ with the group's month and year."""
    part = lambda i: F.regexp_extract(filing, r"^(\d{2})(\d{2})(\d{2})Z$", i)
    return F.when(filing.rlike(r"^\d{6}Z$"), stamp(dtg["yy"], dtg["mon"], part(1), part(2), part(3)))


def resolve_date(dtg: Column, draft: Column, sent: Column) -> Column:
    """(date, date_source): the group's, else the draft date's, else the sent date's; both empty if none parses."""
    a, b, c = F.substring(parse_dtg(dtg)["datetime_iso"], 1, 10), parse_date(draft), parse_date(sent)
    source = F.when(a.isNotNull(), "dtg").when(b.isNotNull(), "draft").when(c.isNotNull(), "sent").otherwise("")
    return F.struct(F.coalesce(a, b, c, F.lit("")).alias("date"), source.alias("date_source"))
