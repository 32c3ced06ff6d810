"""Coverage and quality reports (A1-A10, F26). All combine before the shuffle; lists of examples are bounded by ``n``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import FIRST_YEAR, LAST_YEAR
from ..functions.text import is_na, strip
from ..shared import stored
from .ranges import before, ranged

# Attributes and the body fields that repeat them, and a locator that says the text is there.
BODY_OF = {
    "Current Classification": "classification_marker", "Drafter": "drafted_by", "Executive Order": "executive_order",
    "From": "from", "Handling Restrictions": "handling_restrictions", "Reference": "reference", "Subject": "subject",
    "TAGS": "tags", "To": "to",
}
ON_LINE = r"(?i)TEXT\s+ON[-\s]*LINE"


def rate(part: Column, whole: Column, digits: int = 2) -> Column:
    """A2: percentage, rounded; 0 of nothing is 0."""
    return F.round(F.coalesce(F.try_divide(100.0 * part, whole), F.lit(0.0)), digits)


def character_totals(rows: DataFrame, coverage: str = "coverage", *by: str) -> DataFrame:
    """A1, A2: sums of characters of all documents (or of each group), documents fully covered, and rates."""
    c = F.col(coverage)
    sums = {k: F.sum(c[k].cast("long")) for k in ("total", "matched", "blank", "unmatched")}
    out = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("documents"), F.sum((c["unmatched"] == 0).cast("long")).alias("fully_covered"), *[F.coalesce(v, F.lit(0).cast("long")).alias(k) for k, v in sums.items()])
    return out.withColumn("covered_rate", rate(F.col("matched") + F.col("blank"), F.col("total"))).withColumn("full_rate", rate(F.col("fully_covered"), F.col("documents")))


def report_state(rows: DataFrame, key: str, fields: dict[str, Column], *by: str, n: int = 50, coverage: str = "coverage") -> DataFrame:
    """A1-A3, J15 of some documents, in one row a load (columns ``by``) that others can be merged with.

    Sums of characters and documents, the documents that have each field, and the n least covered documents.
    """
    c = F.col(coverage)
    share = F.coalesce(F.try_divide(100.0 * (c["matched"] + c["blank"]), c["total"]), F.lit(100.0))
    sums = [F.coalesce(F.sum(c[k].cast("long")), F.lit(0).cast("long")).alias(k) for k in ("total", "matched", "blank", "unmatched")]
    had = F.struct(*[F.count_if(v.isNotNull()).alias(k) for k, v in fields.items()])
    # a task's n least are chosen first, so a group gathers n for each task
    least = rows.select(*by, F.struct(share.alias("covered"), F.col(key).cast("string").alias("key")).alias("_s"))
    least = first_n(least, list(by), ["_s"], n).groupBy(*by).agg(F.array_sort(F.collect_list("_s")).alias("worst")) if by else least.orderBy("_s").limit(n).agg(F.array_sort(F.collect_list("_s")).alias("worst"))
    state = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum((c["unmatched"] == 0).cast("long")), F.lit(0).cast("long")).alias("fully_covered"), *sums, had.alias("fields"))
    return state.join(least, list(by)) if by else state.crossJoin(least)  # one row each


def merged_state(states: DataFrame, n: int = 50) -> DataFrame:
    """The state of all documents of some states."""
    sums = ["documents", "fully_covered", "total", "matched", "blank", "unmatched"]
    names = states.schema["fields"].dataType.names
    had = F.struct(*[F.coalesce(F.sum(F.col("fields")[f]), F.lit(0).cast("long")).alias(f) for f in names])
    worst = F.slice(F.array_sort(F.flatten(F.collect_list("worst"))), 1, n)
    return states.agg(*[F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(c) for c in sums], had.alias("fields"), worst.alias("worst"))


def state_report(state: DataFrame) -> DataFrame:
    """A1, A2 of a state, with its fields and its least covered documents."""
    out = state.withColumn("covered_rate", rate(F.col("matched") + F.col("blank"), F.col("total"))).withColumn("full_rate", rate(F.col("fully_covered"), F.col("documents")))
    return out.select("documents", "fully_covered", "total", "matched", "blank", "unmatched", "covered_rate", "full_rate", "fields", "worst")


def worst_covered(rows: DataFrame, key: str, n: int, coverage: str = "coverage") -> DataFrame:
    """The n documents with the lowest covered share, then by key."""
    c = F.col(coverage)
    share = F.coalesce(F.try_divide(100.0 * (c["matched"] + c["blank"]), c["total"]), F.lit(100.0))
    return rows.select(key, share.alias("covered")).orderBy("covered", key).limit(n)


def field_counts(rows: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """A3: of each field, the documents that have it and their share."""
    pairs = F.array(*[F.struct(F.lit(k).alias("field"), v.isNotNull().cast("long").alias("has")) for k, v in fields.items()])
    out = rows.select(F.explode(pairs).alias("p")).groupBy("p.field").agg(F.sum("p.has").alias("documents"), F.count(F.lit(1)).alias("_all"))
    return out.withColumn("field_rate", rate(F.col("documents"), F.col("_all"))).drop("_all")


def parse_rates(rows: DataFrame, fields: dict[str, tuple[Column, Column]], order: str, n: int = 10) -> DataFrame:
    """A4: of each field (raw, parsed): documents with a raw value, parsed ones, their rate, and the first n failures.

    Values and whether they parse are stored: counts and failures both read them, and ``rows`` are made once.
    """
    cell = lambda raw, parsed: [F.when(strip(raw) != "", raw), parsed.isNotNull()]
    wide = rows.select(F.col(order).alias("_o"), *[c.alias(f"{kind}_{i}") for i, f in enumerate(fields.values()) for kind, c in zip(("raw", "ok"), cell(*f), strict=True)])
    wide = stored(wide, "cells")
    cells = F.array(*[F.struct(F.lit(k).alias("field"), F.col(f"raw_{i}").alias("raw"), F.col(f"ok_{i}").alias("ok")) for i, k in enumerate(fields)])
    flat = wide.select("_o", F.explode(cells).alias("c")).select("_o", "c.*")
    sums = flat.groupBy("field").agg(F.count("raw").alias("present"), F.count_if(F.col("raw").isNotNull() & F.col("ok")).alias("parsed"))
    failed = first_n(flat.where("raw IS NOT NULL AND NOT ok"), ["field"], ["_o"], n).groupBy("field").agg(F.sort_array(F.collect_list(F.struct("_o", "raw"))).alias("f"))
    return sums.join(failed, "field", "left").select("field", "present", "parsed", rate(F.col("parsed"), F.col("present")).alias("parse_rate"), F.coalesce(F.transform("f", lambda x: x["raw"]), F.array().cast("array<string>")).alias("failures"))


def first_n(rows: DataFrame, by: list[str], order: list, n: int, rank: str | None = None) -> DataFrame:
    """The first n rows of each group, with their rank if it has a name; Spark cuts each task's share to n a group before the shuffle."""
    kept = rows.withColumn(rank or "_rn", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col(rank or "_rn") <= n)
    return kept if rank else kept.drop("_rn")


def citation_totals(rows: DataFrame) -> DataFrame:
    """A5: documents, with tokens, with matches, without tokens; tokens, matches, airgrams, cables, and the match rate."""
    matched = F.coalesce(F.size("extracted_references"), F.lit(0))
    matched = F.when(F.col("extracted_references").isNull(), 0).otherwise(matched).cast("long")
    tokens, air = F.col("n_tokens").cast("long"), F.col("n_airgrams").cast("long")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("long"))
    out = rows.agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(tokens > 0).alias("with_tokens"), F.count_if(matched > 0).alias("with_matches"), F.count_if(tokens == 0).alias("skipped"),
        total(tokens).alias("tokens"), total(matched).alias("matched"), total(air).alias("airgrams"), total(matched - air).alias("cables"),
    )
    return out.withColumn("match_rate", rate(F.col("matched"), F.col("tokens")))


def failed_tokens(rows: DataFrame, order: str, n: int = 500, width: int = 120) -> DataFrame:
    """A5: the first n tokens that matched nothing, cut to ``width`` characters."""
    return rows.select(order, F.posexplode("failed").alias("at", "token")).orderBy(order, "at").limit(n).select(order, "at", F.substring("token", 1, width).alias("token"))


def tag_types(rows: DataFrame, tags: str = "tags") -> DataFrame:
    """Of each type: tags, tags with a name, and tags that only one source has."""
    t = rows.select(F.explode(tags).alias("t"))
    return t.groupBy("t.type").agg(F.count(F.lit(1)).alias("tags"), F.count("t.name").alias("named"), F.count_if(F.size("t.sources") == 1).alias("single_source"))


def tag_totals(rows: DataFrame, attr: Column, body: Column) -> DataFrame:
    """Documents, those with tags of either source, tokens, placeholders and tokens taken apart by source, entries, and rates.

    ``rows``: what ``tags.normalized`` gives, with the raw tags of both sources.
    """
    t = F.coalesce("tags", F.array().cast(rows.schema["tags"].dataType))
    sums = {f"tokens_{k}": F.sum(F.col("counts")[k]) for k in ("attr", "body", "attr_na", "body_na", "attr_recovered", "body_recovered")}
    some = lambda test: F.sum(F.size(F.filter(t, test)).cast("long"))
    sums |= {
        "entries": F.sum(F.size(t).cast("long")), "single_source": some(lambda x: F.size(x["sources"]) == 1), "named": some(lambda x: x["name"].isNotNull()),
        "classified": some(lambda x: ~x["type"].isin("unknown", "other")),
    }
    out = rows.agg(F.count(F.lit(1)).alias("documents"), F.count_if(strip(attr) != "").alias("with_attr"), F.count_if(strip(body) != "").alias("with_body"), *[F.coalesce(v, F.lit(0).cast("long")).alias(k) for k, v in sums.items()])
    return out.withColumns({"named_rate": rate(F.col("named"), F.col("entries")), "classified_rate": rate(F.col("classified"), F.col("entries"))})


def top_unknown(rows: DataFrame, n: int = 30, tags: str = "tags") -> DataFrame:
    """The n most frequent codes that are unknown and have no name; ties by code."""
    t = rows.select(F.explode(tags).alias("t")).where("t.type = 'unknown' AND t.name IS NULL")
    return t.groupBy("t.code").agg(F.count(F.lit(1)).alias("times")).orderBy(F.desc("times"), "code").limit(n)


def estimate_types(rows: DataFrame) -> DataFrame:
    """Estimates by type and airgram, with totals of either (null), inversions and the share."""
    known = rows.where("estimate_type <> 'unparseable'")
    return known.cube("estimate_type", "is_airgram").agg(F.count(F.lit(1)).alias("estimates"), F.count_if("date_order_inverted").alias("inverted"), F.grouping_id().alias("level"))


def estimate_totals(estimates: DataFrame, documents: DataFrame, cited: DataFrame, representatives: DataFrame) -> DataFrame:
    """Known documents, cited ids, missing ids, those of years outside 73-79, and numbers given more than once.

    ``documents`` (document_number), ``cited`` (mrn, distinct), ``representatives`` (ties): one row a number.
    """
    first, last = (str(y % 100) for y in (FIRST_YEAR, LAST_YEAR))
    known = estimates.where("estimate_type <> 'unparseable'")
    parts = [
        documents.where("document_number <> ''").agg(F.countDistinct("document_number").alias("known")), cited.agg(F.count(F.lit(1)).alias("cited")),
        known.agg(F.count(F.lit(1)).alias("missing"), F.count_if(~F.col("year").between(first, last)).alias("out_of_range")),
        representatives.agg(F.coalesce(F.sum(F.col("ties") - 1), F.lit(0)).cast("long").alias("collisions")),
    ]
    out = parts[0].withColumn("_one", F.lit(1))
    for p in parts[1:]:
        out = out.join(p.withColumn("_one", F.lit(1)), "_one")  # one row each
    return out.drop("_one")


def nearest_ranks(rows: DataFrame, value: str, shares: list[float], by: list[str] | None = None) -> DataFrame:
    """Nearest-rank percentiles: of n sorted values the one at min(n - 1, floor(n * share)).

    Values are counted, dealt by ranges and summed up within a range, behind what the ranges before it hold: no task has
    more than its range of the distinct values.
    """
    by = by or []
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    kept = ranged(counts, *by, value)
    here = F.sum("_n").over(W.partitionBy("_range", *by).orderBy(value))
    if by:
        sums = kept.groupBy(*by, "_range").agg(F.sum("_n").alias("_here"))  # a group's ranges are few
        sums = sums.withColumns({"_before": F.coalesce(F.sum("_here").over(W.partitionBy(*by).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)), "_all": F.sum("_here").over(W.partitionBy(*by))})
        sums = sums.toDF(*[f"_of_{c}" for c in by], "_of_range", "_here", "_before", "_all")
        same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by] + [F.col("_range") == F.col("_of_range")]
        upto = kept.join(sums, same).select(*by, value, "_n", "_range", "_before", "_all").withColumn("_upto", here + F.col("_before"))
    else:
        total = kept.agg(F.sum("_n")).first()[0] or 0
        upto = kept.withColumn("_upto", here + before(kept, F.sum("_n"))).withColumn("_all", F.lit(total))
    wanted = F.explode(F.array(*[F.lit(float(s)) for s in shares]))
    ranked = upto.withColumn("share", wanted).withColumn("_k", F.least(F.col("_all") - 1, F.floor(F.col("_all") * F.col("share"))))
    return ranked.where((F.col("_upto") > F.col("_k")) & (F.col("_upto") - F.col("_n") <= F.col("_k"))).select(*by, "share", F.col(value).alias("percentile"))


def has_body(content: Column, locator: Column) -> Column:
    """whether the document's text is there."""
    return F.coalesce(locator.rlike(ON_LINE) & (strip(content) != ""), F.lit(False))


def missing_body(attrs: Column, fields: dict[str, Column], content: Column, locator: Column) -> Column:
    """attributes given though the body's field is not found, of a document whose text is there; else none."""
    lost = F.filter(F.array(*[F.when(~is_na(F.try_element_at(attrs, F.lit(k))) & v.isNull(), F.lit(k)) for k, v in fields.items()]), lambda x: x.isNotNull())
    return F.when(has_body(content, locator), lost).otherwise(F.array().cast("array<string>"))


def body_fields() -> dict[str, Column]:
    """Of an extracted record, the body field of each attribute; empty lists are null."""
    lists = ("classification_marker", "drafted_by", "handling_restrictions")
    return {a: F.when(F.size(F.col(b)) > 0, F.lit("x")) if b in lists else F.col(b) for a, b in BODY_OF.items()}


def incomplete(records: DataFrame, key: str = "file") -> DataFrame:
    """(key, document_number, missing) of records that lack body fields: attribute, body field and the value given."""
    attrs = F.col("attrs")
    lost = missing_body(attrs, body_fields(), F.col("message_content"), F.try_element_at(attrs, F.lit("Locator")))
    names = F.create_map(*[F.lit(x) for pair in BODY_OF.items() for x in pair])
    issue = lambda a: F.struct(a.alias("attribute"), names[a].alias("body_field"), F.try_element_at(attrs, a).alias("provided_value"))
    return records.select(key, F.try_element_at(attrs, F.lit("Document Number")).alias("document_number"), F.transform(lost, issue).alias("missing")).where("size(missing) > 0")


def quality_totals(rows: DataFrame, missing: str = "missing") -> DataFrame:
    """Of each attribute, the documents that miss it in the body."""
    return rows.select(F.explode(missing).alias("field")).groupBy("field").agg(F.count(F.lit(1)).alias("documents"))


def quality_documents(rows: DataFrame, missing: str = "missing", eligible: str = "eligible") -> DataFrame:
    """Documents, those whose text is there, those that miss a body field, and fields missed in all."""
    n = F.size(missing)
    return rows.agg(F.count(F.lit(1)).alias("documents"), F.count_if(eligible).alias("eligible"), F.count_if(n > 0).alias("cables"), F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("missed"))


def distinct_counts(rows: DataFrame) -> DataFrame:
    """Distinct documents and distinct citations, exactly."""
    docs = rows.agg(F.countDistinct("document_number").alias("n")).select(F.lit("documents").alias("what"), "n")
    return docs.unionByName(rows.select(F.explode("extracted_references").alias("r")).agg(F.countDistinct("r").alias("n")).select(F.lit("citations").alias("what"), "n"))


def value_distribution(values: DataFrame, n: int = 15) -> DataFrame:
    """A10: of (attribute, value) the counts: all if an attribute has at most 2n values, else the n most and least frequent.

    Two bounded lists an attribute, which Spark cuts to their length in each task before the shuffle; the rank from below
    comes from the number of values, so no task holds all values of an attribute.
    """
    counts = values.groupBy("attribute", "value").agg(F.count(F.lit(1)).alias("times"))
    sizes = counts.groupBy("attribute").agg(F.count(F.lit(1)).cast("int").alias("_n"))
    high = first_n(counts, ["attribute"], [F.desc("times"), "value"], 2 * n, "top")
    low = first_n(counts, ["attribute"], ["times", F.desc("value")], n, "_up")
    high = high.join(sizes, "attribute").where((F.col("_n") <= 2 * n) | (F.col("top") <= n)).drop("_n")
    low = low.join(sizes, "attribute").where(F.col("_n") > 2 * n).withColumn("top", F.col("_n") - F.col("_up") + 1).drop("_n", "_up")
    return high.unionByName(low)
