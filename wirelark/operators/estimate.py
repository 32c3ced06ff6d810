"""Dates of cited documents that are missing, from their neighbours in a station's numbering.

A numbering (station, year, airgram) is cut in ranges of numbers; one window over a range's documents and targets finds
both neighbours there, and a second one over the ranges' ends carries them past borders, so no task holds a numbering.
The nearest counters of a bracket are found in the same way, in blocks of days that make up the bracket's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .joins import last_wins
from .ranges import numbered  # noqa: F401 - J12's places

GROUP = ["station", "year", "is_airgram"]


def representatives(documents: DataFrame) -> DataFrame:
    """One document a number: of documents with one number, in order of date, the one in the middle.

    ``documents``: GROUP, sequence, document_number, document_number_raw, date. Ties of date go by id. Adds ``ties``.
    """
    same = W.partitionBy(*GROUP, "sequence")
    ranked = documents.withColumn("_rn", F.row_number().over(same.orderBy("date", "document_number", "document_number_raw"))).withColumn("ties", F.count(F.lit(1)).over(same))
    return ranked.where(F.col("_rn") == F.floor(F.col("ties") / 2) + 1).drop("_rn")


def neighbours(targets: DataFrame, documents: DataFrame, width: int = 4096) -> DataFrame:
    """Targets (mrn, GROUP, sequence) with ``prev`` (greatest smaller number) and ``next`` (least not smaller).

    ``width``: numbers in a range. A range's task holds as many documents, and the targets among them.
    """
    shape = F.struct("document_number", "document_number_raw", "sequence", "date")
    return nearest(targets.select(*GROUP, "sequence", "mrn"), documents.select(*GROUP, "sequence", shape.alias("doc")), GROUP, "sequence", width)


def nearest(asked: DataFrame, documents: DataFrame, group: list[str], place: str, width: int = 4096) -> DataFrame:
    """Rows of ``asked`` (group, place, others that are not all null) with ``prev`` and ``next``, the ``doc`` of their group
    at the greatest smaller place and at the least one not smaller.
    """
    part, kind = F.floor(F.col(place) / width).alias("_part"), documents.schema["doc"].dataType
    own = [c for c in asked.columns if c not in (*group, place)]
    docs = documents.select(*group, place, part, *[F.lit(None).cast(asked.schema[c].dataType).alias(c) for c in own], "doc", F.lit(False).alias("_asked"))
    both = docs.unionByName(asked.select("*", part, F.lit(None).cast(kind).alias("doc"), F.lit(True).alias("_asked")))
    ranges = [*group, "_part"]
    # the ends of each range, and of the nearest ranges on either side that have documents
    ends = both.groupBy(*ranges).agg(F.max_by("doc", F.when(F.col("doc").isNotNull(), F.col(place))).alias("_high"), F.min_by("doc", F.when(F.col("doc").isNotNull(), F.col(place))).alias("_low"))
    parts = W.partitionBy(*group)
    ends = ends.withColumns({
        "_before": F.last("_high", ignorenulls=True).over(parts.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)),
        "_behind": F.last("_low", ignorenulls=True).over(parts.orderBy(F.desc("_part")).rowsBetween(W.unboundedPreceding, -1)),
    }).select(*ranges, "_before", "_behind")
    below = W.partitionBy(*ranges).orderBy(place).rangeBetween(W.unboundedPreceding, -1)
    # from the top down: a frame that grows is kept up to date, one that shrinks is computed anew for each row
    above = W.partitionBy(*ranges).orderBy(F.desc(place)).rangeBetween(W.unboundedPreceding, W.currentRow)
    found = both.withColumns({"prev": F.last("doc", ignorenulls=True).over(below), "next": F.last("doc", ignorenulls=True).over(above)})
    found = found.where("_asked").drop("doc", "_asked").join(ends, ranges)
    return found.withColumns({"prev": F.coalesce("prev", "_before"), "next": F.coalesce("next", "_behind")}).drop("_part", "_before", "_behind")


def _days(a: Column, b: Column) -> Column:
    return F.datediff(F.to_date(b), F.to_date(a))


def _between(a: Column, b: Column, fraction: Column) -> Column:
    """The date at a fraction of the way, days rounded half to even."""
    return F.date_format(F.date_add(F.to_date(a), F.bround(_days(a, b) * fraction).cast("int")), "yyyy-MM-dd")


def _binary_blocks(first: Column, last: Column, levels: int) -> Column:
    """(level, block) of the fewest blocks of days, 2 ** level each, that make up the days from ``first`` to ``last``."""
    blocks = []
    for level in range(levels):
        low, high = F.shiftright(first + ((1 << level) - 1), level), F.shiftright(last + 1, level)
        odd = F.pmod(low, F.lit(2))
        one = lambda block, level=level: F.struct(F.lit(level).alias("level"), block.alias("block"))
        blocks += [F.when((odd == 1) & (low < high), one(low)), F.when((F.pmod(high, F.lit(2)) == 1) & (low + odd < high), one(high - 1))]
    return F.filter(F.array(*blocks), lambda x: x.isNotNull())


def refined(brackets: DataFrame, counters: DataFrame, width: int = 4096) -> DataFrame:
    """For brackets (mrn, p_date, n_date, p_counter, n_counter, aim) the nearest counters on either side of ``aim``.

    ``counters`` (date, counter): dated documents. Both lie in the bracket's dates and counters. Adds ``low`` and
    ``high`` (counter, date); a bracket without both gives no row. A bracket's days are cut in blocks of powers of two, two
    a level at most, and a document stands in one block a level; in a block the nearest counters are the neighbours of the
    aim, so work grows with brackets and documents and not with the pairs of them. Of documents with one counter in a block
    the first and the last date are kept. ``width``: counters in a range of a block.
    """
    day = lambda c: F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date"))
    usable = brackets.where("p_counter IS NOT NULL AND n_counter > p_counter AND p_date <= n_date AND aim IS NOT NULL")
    usable = usable.withColumns({"_first": day(F.col("p_date")), "_last": day(F.col("n_date"))})
    longest = usable.agg(F.max(F.col("_last") - F.col("_first"))).first()[0] or 0  # one number
    levels = (longest + 1).bit_length()
    place = F.least(F.greatest(F.ceil("aim"), F.col("p_counter")), F.col("n_counter") + 1).cast("long").alias("_place")
    asked = usable.select("mrn", "p_counter", "n_counter", place, F.explode(_binary_blocks(F.col("_first"), F.col("_last"), levels)).alias("b"))
    asked = asked.select(F.col("b")["level"].alias("_level"), F.col("b")["block"].alias("_block"), "_place", "mrn", "p_counter", "n_counter")
    dated = counters.where("date IS NOT NULL AND counter IS NOT NULL").select("date", "counter", F.posexplode(F.array(*[F.shiftright(day(F.col("date")), n) for n in range(levels)])).alias("_level", "_block"))
    dated = dated.groupBy("_level", "_block", "counter").agg(F.min("date").alias("first"), F.max("date").alias("last"))
    dated = dated.select("_level", "_block", F.col("counter").cast("long").alias("_place"), F.struct("counter", "first", "last").alias("doc"))
    found = nearest(asked, dated, ["_level", "_block"], "_place", width)
    pair = lambda side, date: F.struct(F.col(side)["counter"].alias("counter"), F.col(side)[date].alias("date"))
    near = found.groupBy("mrn").agg(
        F.max(F.when(F.col("prev")["counter"] >= F.col("p_counter"), pair("prev", "last"))).alias("low"),
        F.min(F.when(F.col("next")["counter"] <= F.col("n_counter"), pair("next", "first"))).alias("high"),
    )
    return near.where("low IS NOT NULL AND high IS NOT NULL")


def estimates(missing: DataFrame, documents: DataFrame, counters: DataFrame | None, stations, order: list[str] | None = None) -> DataFrame:
    """One row a missing id: neighbours, estimated date, its type and accuracy.

    ``documents``: document_number, document_number_raw, date; ``counters``: document_number_raw, counter. Of ids that
    repeat in either the last row by ``order`` (columns of both tables, as the file) counts, J11; without it the greatest value.
    """
    parsed = missing.select("mrn", stations.parse(F.col("mrn")).alias("p"))
    known = documents.where("date <> ''").select("*", stations.parse(F.col("document_number")).alias("p")).where("p IS NOT NULL")
    known = known.select("p.*", "document_number", "document_number_raw", "date")
    asked = parsed.where("p IS NOT NULL").select("mrn", "p.*")
    rows = neighbours(asked, representatives(known)).withColumnRenamed("next", "nxt")
    p, n = F.col("prev"), F.col("nxt")
    span = n["sequence"] - p["sequence"]
    rows = rows.withColumn("fraction", F.when(span == 0, 0.5).otherwise((F.col("sequence") - p["sequence"]) / span))
    if counters is not None:
        # of ids that repeat, the last row counts
        last = lambda t, c: last_wins(t.select("document_number_raw", c, *(o for o in order or [] if o != c)), "document_number_raw", order or [c]).select("document_number_raw", c)
        counters = last(counters.where("document_number_raw IS NOT NULL AND counter IS NOT NULL"), "counter")
        side = lambda k: counters.select(F.col("document_number_raw").alias(f"{k}_raw"), F.col("counter").alias(f"{k}_counter"))
        brackets = rows.where("prev IS NOT NULL AND nxt IS NOT NULL").select("mrn", "fraction", p["date"].alias("p_date"), n["date"].alias("n_date"), p["document_number_raw"].alias("p_raw"), n["document_number_raw"].alias("n_raw"))
        brackets = brackets.join(side("p"), "p_raw").join(side("n"), "n_raw")
        brackets = brackets.withColumn("aim", F.col("p_counter") + (F.col("n_counter") - F.col("p_counter")) * F.col("fraction"))
        dated = last(documents.where("document_number_raw <> '' AND date <> ''"), "date").join(counters, "document_number_raw")
        rows = rows.join(refined(brackets, dated).join(brackets.select("mrn", "aim"), "mrn"), "mrn", "left")
    else:
        rows = rows.withColumns({"low": F.lit(None).cast("struct<counter:bigint,date:string>"), "high": F.lit(None).cast("struct<counter:bigint,date:string>"), "aim": F.lit(None).cast("double")})
    low, high = F.col("low"), F.col("high")
    gap = high["counter"] - low["counter"]
    local = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.when(gap == 0, 0.5).otherwise((F.col("aim") - low["counter"]) / gap)))
    two, fine = p.isNotNull() & n.isNotNull(), low.isNotNull()
    days = F.when(fine, _days(low["date"], high["date"])).when(two, _days(p["date"], n["date"]))
    brief = lambda d: F.when(d.isNotNull(), F.struct(d["document_number"].alias("document_number"), d["sequence"].alias("sequence"), d["date"].alias("date")))
    done = rows.select(
        "mrn", "station", "year", "is_airgram", "sequence",
        F.when(fine, _between(low["date"], high["date"], local)).when(two, _between(p["date"], n["date"], F.col("fraction"))).otherwise(F.coalesce(p["date"], n["date"])).alias("estimated_date"),
        F.when(fine, "interpolated_refined").when(two, "interpolated").when(p.isNotNull() | n.isNotNull(), "extrapolated").otherwise("unresolvable").alias("estimate_type"),
        F.abs(days).alias("accuracy_days"), F.coalesce(days < 0, F.lit(False)).alias("date_order_inverted"),
        brief(p).alias("prev_known"), brief(n).alias("next_known"),
    )
    odd = parsed.where("p IS NULL").select("mrn", F.lit("unparseable").alias("estimate_type"), F.lit(False).alias("date_order_inverted"))
    return done.unionByName(odd, allowMissingColumns=True)


ORDER = ["station", "year", "is_airgram", "sequence", "mrn"]


def in_order(rows: DataFrame) -> DataFrame:
    """Parseable ids by numbering and number, then the others by id."""
    return rows.orderBy(F.col("station").isNull(), *ORDER)
