"""Operator 1: quality rules from the lines that documents of one host share. DataFrame functions only.

Each normalised line (lower case, blanks collapsed) is hashed with its host; the distinct documents of the host that
hold it are counted, a document being its text, so that exact copies count once. Lines in more documents than the limit
(``min_docs``, or the share ``max_share`` of the host's documents if that is more) are removed, and a document that
keeps fewer than ``min_words`` words or less than ``min_left`` of its words is rejected as depleted. Basic rules on
word count and repeated 5-word windows come first.

Lines are first counted with duplicates (a count that combines before the shuffle), which gives a superset of the lines
over the limit; only their occurrences are then joined and counted exactly. The superset is written to the shared
folder first, so that Spark broadcasts it only if its size on disk is under its threshold.

A null host is the empty host. A null or empty text has no words and fails. Repeated rows are judged alike, each as a
row of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK_RE, BLANKS, stored

WINDOW = 5
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{BLANK_RE}+"))


def with_measures(rows: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed to rows with ``_text``.

    Every step that is used twice is a column of its own, so that it is computed once.
    """
    text = F.col("_text")
    long = lambda c: c.cast("long")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    rows = rows.withColumns({"_ws": words_of(text), "_lines": lines})
    rows = rows.withColumns(
        {
            "n_words": long(F.size("_ws")),
            "word_chars": long(F.length(F.translate(text, BLANKS, ""))),
            "n_symbols": long(F.length(text) - F.length(F.translate(text, SYMBOLS, ""))),
            "n_dup_lines": long(F.size("_lines") - F.size(F.array_distinct("_lines"))),
            "_wh": F.transform("_ws", lambda w: F.xxhash64(w)),
        }
    ).drop("_ws", "_lines")
    window = lambda i: F.xxhash64(*[F.get("_wh", i + k) for k in range(WINDOW)])
    some = F.size("_wh") >= WINDOW
    rows = rows.withColumn("_win", F.when(some, F.transform(F.sequence(F.lit(0), F.size("_wh") - WINDOW), window))).drop("_wh")
    repeats = F.size("_win") > F.size(F.array_distinct("_win"))
    rows = rows.withColumn("_pairs", F.when(repeats, F.sort_array(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("_win")
    same = lambda x, j: F.coalesce(F.get("_pairs", j + 1)["h"] == x["h"], F.lit(False)) | ((j > 0) & F.coalesce(F.get("_pairs", j - 1)["h"] == x["h"], F.lit(False)))
    rows = rows.withColumn("_at", F.sort_array(F.transform(F.filter("_pairs", same), lambda x: x["i"]))).drop("_pairs")
    covered = F.transform("_at", lambda s, j: F.least(F.lit(WINDOW), F.coalesce(F.get("_at", j + 1) - s, F.lit(WINDOW))))
    rows = rows.withColumn("n_repeat_words", F.coalesce(F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))).drop("_at")
    return rows.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def normal_line(line: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(line), r"[ \t\x0b\f\r]+", " "))


def line_hash(host: Column, line: Column) -> Column:
    return F.xxhash64(host, normal_line(line))


def occurrences(rows: DataFrame) -> DataFrame:
    """(doc, host, h, at, n): hash and number of words of each line with a word, from rows with ``_host`` and ``_text``.

    ``doc`` is a hash of host and text: of two documents it is the same only if they are copies.
    """
    text = F.regexp_replace(F.lower("_text"), r"[ \t\x0b\f\r]+", " ")
    lines = rows.select("_doc", "_host", F.posexplode(F.split(text, "\n", -1)).alias("at", "line")).withColumn("line", F.btrim("line")).where("line <> ''")
    return lines.select(
        F.col("_doc").alias("doc"), F.col("_host").alias("host"), F.xxhash64("_host", "line").alias("h"),
        "at", (F.length("line") - F.length(F.translate("line", " ", "")) + 1).alias("n"),
    )


def removals(rows: DataFrame, min_docs: int, max_share: float, long_words: int | None = None) -> DataFrame:
    """(doc, n_removed, lines) of documents that hold lines over the limit: their words, and the lines' hashes.

    For lines of ``long_words`` words or more (None: for none) the limit is ``min_docs``, however large the host.
    """
    found = occurrences(rows)
    hosts = rows.select("_host", "_doc").distinct().groupBy("_host").agg(F.greatest(F.lit(min_docs).cast("double"), F.count(F.lit(1)) * max_share).alias("most"))
    often = found.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.any_value("host").alias("_host"), F.any_value("n").alias("words")).where(F.col("n") > min_docs)
    limited = often.join(hosts, "_host")
    if long_words is not None:
        limited = limited.withColumn("most", F.when(F.col("words") >= long_words, F.lit(min_docs).cast("double")).otherwise(F.col("most")))
    suspects = stored(limited.where("n > most").select("h", "most"), "frequent-lines")
    at = found.join(suspects, "h").groupBy("h", "doc", "at").agg(F.any_value("n").alias("n"), F.any_value("most").alias("most"))
    by_doc = stored(at.groupBy("h", "doc").agg(F.sum("n").alias("n"), F.any_value("most").alias("most")), "suspect-lines")
    over = stored(by_doc.groupBy("h").agg(F.count(F.lit(1)).alias("docs"), F.any_value("most").alias("most")).where("docs > most").select("h"), "removed-lines")
    return by_doc.join(over, "h").groupBy("doc").agg(F.sum("n").alias("n_removed"), F.collect_list("h").alias("lines"))


def _prepared(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    host, text = F.coalesce(F.col(source).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.withColumns({"_host": host, "_text": text}).withColumn("_doc", F.xxhash64("_host", "_text"))


def _measured(rows: DataFrame) -> DataFrame:
    """The measures, written once: filters on them must not be pushed down into the steps that make them."""
    return stored(with_measures(rows.select("doc_id", "_doc", "_text")).drop("_text"), "measures")


def _judged(rows: DataFrame, removed: DataFrame, min_words: int, min_left: float) -> DataFrame:
    r = removed.select(F.col("doc").alias("_doc"), F.col("n_removed").alias("_removed"), F.col("lines").alias("_gone"))
    joined = rows.join(r, "_doc", "left").withColumn("n_removed_words", F.coalesce("_removed", F.lit(0).cast("long")))
    left = F.col("n_words") - F.col("n_removed_words")
    depleted = (F.col("n_removed_words") > 0) & ((left < min_words) | (left < min_left * F.col("n_words")))
    return joined.withColumn("kept", ~F.col("base_failed") & ~depleted)


def judge(docs: DataFrame, *, min_docs: int = 20, max_share: float = 0.1, min_words: int = 10, min_left: float = 0.2) -> DataFrame:
    """Per row of ``docs``: doc_id, the measures, base_failed, kept and n_removed_words."""
    rows = _prepared(docs.select("doc_id", "source", "text"))
    removed = removals(rows, min_docs, max_share)
    out = _judged(_measured(rows), removed, min_words, min_left)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words")


def cleaned(docs: DataFrame, *, min_docs: int = 20, max_share: float = 0.1, long_words: int | None = 8, min_words: int = 10, min_left: float = 0.2) -> DataFrame:
    """The rows of ``docs`` that are kept, without the lines over the limit; n_chars, if there, is counted anew.

    A line of ``long_words`` words or more does not repeat by chance, so its limit does not grow with the host.
    """
    names = docs.columns
    rows = _prepared(docs.toDF(*[f"_in_{c}" for c in names]), "_in_source", "_in_text")
    removed = removals(rows.select("_doc", "_host", "_text"), min_docs, max_share, long_words)
    plain = rows.select(F.col("_in_doc_id").alias("doc_id"), "_doc", "_text")
    judged = _judged(_measured(plain), removed, min_words, min_left).where("kept")
    # copies share a verdict
    verdicts = stored(judged.groupBy("_doc").agg(F.any_value("_gone").alias("_gone")), "verdicts")
    kept = rows.join(verdicts, "_doc")
    lines = F.filter(F.split("_text", "\n", -1), lambda x: ~F.array_contains("_gone", line_hash(F.col("_host"), x)))
    text = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(lines, "\n"))
    out = kept.withColumn("_in_text", text)
    if "n_chars" in names:
        out = out.withColumn("_in_n_chars", F.when(F.col("_gone").isNull(), F.col("_in_n_chars")).otherwise(F.length("_in_text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*[F.col(f"_in_{c}").alias(c) for c in names])


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
word AS (SELECT rid, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
win AS (SELECT rid, i, x || ' ' || lead(x, 1) OVER o || ' ' || lead(x, 2) OVER o || ' ' || lead(x, 3) OVER o || ' ' || lead(x, 4) OVER o AS s FROM word WINDOW o AS (PARTITION BY rid ORDER BY i)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS n FROM win WHERE s IS NOT NULL) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM rep) GROUP BY rid),
line AS (SELECT rid, host, text, trim(regexp_replace(lower(x), '[ \t\x0b\f\r]+', ' ', 'g')) AS l FROM (SELECT rid, host, text, unnest(lines) AS x FROM w)),
hosts AS (SELECT host, greatest(20, 0.1 * count(DISTINCT text)) AS most FROM d GROUP BY host),
gone AS (SELECT host, l FROM line JOIN hosts USING (host) GROUP BY host, l, most HAVING count(DISTINCT text) > most),
removed AS (SELECT rid, sum(length(l) - length(replace(l, ' ', '')) + 1) AS n FROM line JOIN gone USING (host, l) GROUP BY rid),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
  CAST(coalesce(removed.n, 0) AS BIGINT) AS n_removed_words
  FROM w LEFT JOIN covered USING (rid) LEFT JOIN removed USING (rid)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (n_removed_words > 0 AND (n_words - n_removed_words < 10 OR n_words - n_removed_words < 0.2 * n_words)) AS kept,
  n_removed_words FROM b
"""
