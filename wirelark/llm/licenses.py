"""Operator 10: license templates by MinHash bands over overlapping windows, then exact containment. DataFrame functions only.

Templates and texts are cut in lower-case words and shingles of five words. Every text is cut in overlapping windows of a
few sizes, powers of two, one step being an eighth of the size, so that whatever stretch of text holds a template lies
whole in a window of the template's size. A window's MinHash values are its bands; they are looked up in a table of the
templates' bands, and a window that shares a band with a template is verified exactly: the share of the template's
distinct shingles that the window holds must be ``least`` or more. ``bands`` is set so that a window which holds that
share retrieves the template with probability ``sure`` or more. Templates of up to ``SMALL`` shingles have each shingle
for a band, and windows of one shingle: these are found for certain, and must stand there whole, since a single word tells
one license's notice from another's.

A band can only collide if the window holds the template's shingle whose value it is; so the values are computed for all
windows of the texts that hold a shingle of any template, and the others are passed over without loss. Values are minima
of minima of blocks, so a shingle is hashed once for each band. Windows with a band that some template has are joined to
the table of bands. The templates are a bounded parameter.
Null, empty and short texts hold no template; very long ones take work in proportion; repeated rows repeat; an empty table
gives no rows; columns of any name are left alone.
"""

from __future__ import annotations

import math
import re

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pinned, stored
from .license_texts import templates as common_templates

SHINGLE, LEAST, SURE, STEPS, SMALL = 5, 0.8, 0.99, 8, 16
#: Windows of the smallest size above one shingle, and the block whose minima they are made of.
SMALLEST, BLOCK = 32, 4


def template_words(text: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def bands_needed(least: float = LEAST, sure: float = SURE) -> int:
    """Bands of one value each, so that a window with ``least`` of a template collides with probability ``sure``.

    At worst the window is as large as it can be for the template, two steps of the sizes, and holds nothing else of it.
    """
    largest = 2 * STEPS / (STEPS - 1)
    jaccard = least / (1 + largest - least)
    return math.ceil(math.log(1 - sure) / math.log(1 - jaccard))


def window_of(shingles: int) -> int:
    """The size of window for a template: 1, or the least power of two that holds it whole wherever it starts."""
    if shingles <= SMALL:
        return 1
    return max(SMALLEST, 1 << math.ceil(math.log2(shingles * STEPS / (STEPS - 1))))


def seeds(count: int) -> list[int]:
    """One number for each band: a hash is permuted by exclusive or with it."""
    return [int.from_bytes(xxhash.xxh64_digest(f"band {j}"), "big", signed=True) for j in range(count)]


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles_of(words: Column) -> Column:
    """Of a column of hashed words: a hash of each five neighbours; none of fewer words."""
    at = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)])
    return F.when(F.size(words) >= SHINGLE, F.transform(F.sequence(F.lit(0), F.size(words) - SHINGLE), at)).otherwise(F.array().cast("array<long>"))


def _least(values: Column, seed: Column) -> Column:
    return F.array_min(F.transform(values, lambda x: x.bitwiseXOR(seed)))


def with_shingles(rows: DataFrame, text: Column) -> DataFrame:
    """Adds ``_s``, the hashes of a text's shingles."""
    rows = rows.withColumn("_w", F.transform(words_of(F.coalesce(text.cast("string"), F.lit(""))), lambda w: F.xxhash64(w)))
    return rows.withColumn("_s", pinned(shingles_of(F.col("_w")))).drop("_w")


def prepared(spark: SparkSession, templates: dict[str, list[str]], least: float = LEAST) -> tuple[DataFrame, DataFrame, dict[int, list[int]], list[int]]:
    """Two tables, (template, license, n, shingles, needed) and (window, band, template), all bands by window and all shingles: computed by Spark."""
    flat = [(i, name, text) for i, (name, text) in enumerate((n, t) for n, ts in sorted(templates.items()) for t in ts)]
    short = [t for _, _, t in flat if len(template_words(t)) < SHINGLE]
    if short:
        raise ValueError(f"a template of fewer than {SHINGLE} words: {short[0]!r}")
    rows = with_shingles(spark.createDataFrame(flat, "template int, license string, text string"), F.col("text"))
    each = F.transform(F.lit(seeds(bands_needed(least))), lambda seed: _least(F.col("_s"), seed))
    table, bands, known = [], [], {}
    for r in rows.select("template", "license", F.array_distinct("_s").alias("s"), F.size("_s").alias("n"), each.alias("m")).collect():  # one row a template
        window = window_of(r.n)
        own = r.s if window == 1 else [_key(window, j, m) for j, m in enumerate(r.m)]
        table.append((r.template, r.license, len(r.s), r.s, 1.0 if window == 1 else least))
        bands += [(window, b, r.template) for b in own]
        known.setdefault(window, []).extend(own)
    shapes = "template int, license string, n int, shingles array<long>, needed double", "window int, band long, template int"
    return spark.createDataFrame(table, shapes[0]), spark.createDataFrame(bands, shapes[1]), {w: sorted(set(b)) for w, b in known.items()}, sorted({x for t in table for x in t[3]})


def _key(window: int, j: int, value: int) -> int:
    """A band's key: its value, turned by window and number, so that keys of different bands do not meet."""
    return value ^ int.from_bytes(xxhash.xxh64_digest(f"key {window} {j}"), "big", signed=True)


def _small(known: list[int]) -> Column:
    """Windows of one shingle whose shingle is a band; ``near`` is as far around as a small template can reach."""
    hits = F.filter(F.transform("_s", lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda z: z["x"].isin(known))
    low = lambda i: F.greatest(i - SMALL, F.lit(0))
    return F.transform(hits, lambda z: F.struct(F.lit(1).alias("window"), low(z["i"]).alias("start"), F.lit(2 * SMALL + 1).alias("size"), F.array(z["x"]).alias("bands")))


def _windows(minima: str, window: int, known: list[int], turns: list[int]) -> Column:
    """Windows of eight blocks with a band that a template has; ``minima``: of each band, the blocks' minima."""
    step = window // STEPS
    blocks = F.size(F.get(minima, 0))
    last = F.greatest(blocks - STEPS, F.lit(0))

    def at(b: Column) -> Column:
        keys = F.transform(minima, lambda m, j: F.array_min(F.slice(m, b + 1, STEPS)).bitwiseXOR(F.get(F.lit(turns), j)))
        return F.struct(F.lit(window).alias("window"), (b * step).alias("start"), F.lit(window).alias("size"), F.filter(keys, lambda k: k.isin(known)).alias("bands"))

    return F.filter(F.transform(F.sequence(F.lit(0), last), at), lambda w: F.size(w["bands"]) > 0)


def candidates(rows: DataFrame, known: dict[int, list[int]], shingles: list[int], least: float = LEAST) -> DataFrame:
    """Adds ``_windows``, the windows with a band of some template, to rows with ``_s``; rows without any go."""
    count, sizes = bands_needed(least), sorted(w for w in known if w > 1)
    rows = rows.where(F.exists("_s", lambda x: x.isin(shingles)))
    parts = [_small(known[1])] if 1 in known else []
    if sizes:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size("_s") - 1) / BLOCK).cast("int")), lambda b: F.slice("_s", b * BLOCK + 1, BLOCK))
        rows = rows.withColumn("_blocks", blocks)
        rows = rows.withColumn("_m0", F.transform(F.lit(seeds(count)), lambda seed: F.transform("_blocks", lambda x: _least(x, seed))))
    width, level = BLOCK, 0
    for window in sizes:
        while width < window // STEPS:  # blocks of twice the size, from two neighbours each
            pair = lambda m: F.transform(F.sequence(F.lit(0), F.floor((F.size(m) - 1) / 2).cast("int")), lambda i: F.least(F.get(m, 2 * i), F.get(m, 2 * i + 1)))
            rows = rows.withColumn(f"_m{level + 1}", F.transform(f"_m{level}", pair))
            width, level = 2 * width, level + 1
        turns = [_key(window, j, 0) for j in range(count)]
        parts.append(_windows(f"_m{level}", window, known[window], turns))
    return rows.withColumn("_windows", pinned(F.concat(*parts)))


def hits(texts: DataFrame, templates: dict[str, list[str]], least: float = LEAST) -> DataFrame:
    """(key, license, share) of the licenses that the texts of (key, text) hold: the best share of their templates."""
    table, bands, known, shingles = prepared(texts.sparkSession, templates, least)
    rows = candidates(with_shingles(texts.select("key", "text"), F.col("text")).drop("text"), known, shingles, least)
    rows = rows.select("key", "_s", F.explode("_windows").alias("w"))
    rows = rows.select("key", F.col("w")["window"].alias("window"), F.slice("_s", F.col("w")["start"] + 1, F.col("w")["size"]).alias("near"), F.explode(F.col("w")["bands"]).alias("band"))
    found = rows.join(bands, ["window", "band"]).join(table, "template")
    share = F.size(F.array_intersect("near", "shingles")) / F.col("n")
    return found.select("key", "license", share.alias("share"), "needed").where("share >= needed").groupBy("key", "license").agg(F.max("share").alias("share"))


def scan(docs: DataFrame, templates: dict[str, list[str]] | None = None, *, least: float = LEAST, found: str = "licenses") -> DataFrame:
    """Adds (or replaces) the column ``found``: array of (name, share) of the licenses a text holds, by name.

    A text's licenses depend on the text alone, so they are found by the texts' MD5, which copies share, and joined to
    the rows. They are written first, so that Spark broadcasts them only if their size on disk is under its threshold.
    """
    templates = common_templates() if templates is None else templates
    names = [c for c in docs.columns if c != found]
    rows = docs.select(*[F.col(c).alias(f"_in_{c}") for c in names])
    none = F.array().cast("array<struct<name:string,share:double>>")
    if not any(templates.values()):
        return docs.select(*names, none.alias(found))
    text = F.coalesce(F.col("_in_text").cast("string"), F.lit(""))
    held = stored(hits(rows.select(F.md5(text.cast("binary")).alias("key"), text.alias("text")), templates, least), "licenses")
    by_text = held.groupBy("key").agg(F.sort_array(F.collect_list(F.struct(F.col("license").alias("name"), "share"))).alias("_found"))  # at most all licenses
    joined = rows.withColumn("key", F.md5(text.cast("binary"))).join(by_text, "key", "left")
    return joined.select(*[F.col(f"_in_{c}").alias(c) for c in names], F.coalesce("_found", none).alias(found))


def licensed(docs: DataFrame, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """Per row: doc_id, n_licenses, licenses (names, comma-joined), best_share."""
    rows = scan(docs.select("doc_id", "text"), templates, found="_found")
    return rows.select(
        "doc_id", F.size("_found").cast("long").alias("n_licenses"), F.array_join(F.transform("_found", lambda x: x["name"]), ",").alias("licenses"),
        F.coalesce(F.array_max(F.transform("_found", lambda x: x["share"])), F.lit(0.0)).alias("best_share"),
    )
