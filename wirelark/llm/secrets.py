"""Operator 6: secrets, by patterns and by character Markov models. DataFrame functions only.

Three patterns give the base spans. The method looks at every run of key-like characters that base spans leave of a
text, on either side of them too, and adds those likelier under a first order Markov model of random strings than under
one of ordinary strings: the mean log-likelihood ratio a character is over a threshold, and the whole ratio over a fixed
evidence, so that the shorter a run the higher its mean must be. There is no other rule: what a run is made of is left
to the models. A run has ``SHORTEST`` characters at least, as many as a base value.

Both models are trained from labelled samples (``text``, ``label`` 1 for random), by counting character pairs; they are
as large as the alphabet allows, whatever the samples' size. Ordinary samples are identifiers, words, numbers, dates
and rulers.

Places are code points, from 0, ends exclusive. A narrow map: no shuffle but the training counts. Work and memory grow in
proportion to a text: spans are cut by splitting it, never by searching it anew for each. A null text is empty; repeated
rows repeat; an empty table gives no rows; other columns, whatever their names, are left alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import let

#: kind -> (pattern, group whose length counts, least length). Of hex and access keys only long enough runs match: a
#: shorter run holds no other match, so this finds what matching all runs and dropping short ones would.
KINDS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]{14,}", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Noncharacters of Unicode, for internal use: the first and the other characters of a span in a masked text.
FIRST, REST = "\ufdd0", "\ufdd1"
SHORTEST, EVIDENCE = 12, 18.0
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{SHORTEST},}}"
START = len(ALPHABET)
#: Words of ordinary identifiers, for the labelled samples.
IDENTIFIER_WORDS = """account action active address admin alert amount answer api array async audio author balance batch
binary block body border branch browser buffer build button cache calendar callback cancel catalog category channel
check client cluster code collection color column comment commit common compile component config connection constant
container content context control cookie copy count country create current customer dashboard data database date debug
default delete delivery deploy description device dialog direction disable discount display document domain download
driver editor element email employee enable engine entity entry error event example exception execute export extension
factory feature field file filter folder font footer format forward frame function gateway generate global group handler
hardware header height hidden history host icon identifier image import index input insert instance interface internal
invoice item iterator javascript job keyboard label language layout length level library license limit link list loader
local location logger login machine manager mapping margin master member memory menu message method metadata mobile
model module monitor mouse network node notification number object offset operation option order output package page
panel parameter parent parser partition password path pattern payment performance permission picture pipeline platform
player plugin pointer policy position prefix preview primary process product profile progress project property protocol
provider proxy public python query queue random range reader record redirect reference region register release remote
render report repository request resource response result review role router runtime sample schedule schema screen
script search section security select sender sequence server service session setting shared shipping simple source
stack standard start state static station status storage store stream string structure style submit subject summary
support switch symbol system table target task template terminal text theme thread threshold time title toggle tool
total trace transaction transfer transform tree trigger type unit update upload user utility validate value variable
vector version video view virtual visible warning widget width window worker workflow wrapper writer""".split()


def labelled_samples(spark: SparkSession, each: int = 4000) -> DataFrame:
    """(text, label): ``each`` random strings of three alphabets, and as many ordinary ones.

    Ordinary ones are two to five words joined in five styles, and for every fourth a number, a date or a ruler.
    """
    words = F.lit(IDENTIFIER_WORDS)
    ids = spark.range(each, numPartitions=2)
    draw = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n)).cast("int")
    digest = F.sha2(F.concat(F.lit("sample"), F.col("id").cast("string")), 512)
    base64 = F.translate(F.base64(F.unhex(digest)), "\r\n", "")
    start, size = 1 + draw("start", 30), 20 + draw("size", 25)
    text = F.when(F.col("id") % 3 == 0, base64).when(F.col("id") % 3 == 1, F.translate(base64, "+/=", "xQ7")).otherwise(F.lower(F.translate(base64, "+/=", "x07")))
    random = ids.select(F.substring(text, start, size).alias("text"), F.lit(1).alias("label"))
    picked = F.transform(F.sequence(F.lit(1), 2 + draw("n", 4)), lambda i: F.get(words, F.pmod(F.xxhash64("id", i), F.lit(len(IDENTIFIER_WORDS))).cast("int")))
    style = draw("style", 5)
    camel = F.array_join(F.transform("picked", lambda w: F.initcap(w)), "")
    number = F.when(draw("numbered", 2) == 0, F.concat(F.lit("_"), draw("number", 3000).cast("string"))).otherwise("")
    joined = (
        F.when(style == 0, F.array_join("picked", "_")).when(style == 1, F.array_join("picked", "-")).when(style == 2, camel)
        .when(style == 3, F.upper(F.array_join("picked", "_"))).otherwise(F.array_join("picked", "/"))
    )
    digits = lambda salt: F.translate(F.substring(F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256), 1, 14), "abcdef", "012345")
    date = F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), draw("date", 15000)), "yyyy-MM-dd")
    figures = (
        F.when(style == 0, digits("a")).when(style == 1, F.concat_ws("-", date, F.substring(digits("b"), 1, 4))).when(style == 2, F.translate(date, "-", "/"))
        .when(style == 3, F.repeat(F.get(F.lit(["-", "=", "_", "/"]), draw("ruler", 4)), 12 + draw("long", 30))).otherwise(F.concat_ws("-", *[F.substring(digits(x), 1, 3) for x in "cdef"]))
    )
    plain = ids.withColumn("picked", picked).select(F.when(F.col("id") % 4 == 0, figures).otherwise(F.concat(joined, number)).alias("text"), F.lit(0).alias("label"))
    return random.unionByName(plain)


def train(samples: DataFrame, smooth: float = 0.5) -> list[float]:
    """Log-likelihood ratios (random to ordinary) of each pair: row START is the first character, others the one before.

    Characters outside the alphabet, null texts and labels are left out; with no samples every ratio is 0.
    """
    clean = samples.where("label IS NOT NULL").select("label", F.regexp_replace("text", f"[^{ALPHABET.replace('-', '')}-]", "").alias("text")).where("text <> ''")
    pairs = clean.select("label", F.explode(F.transform(F.split("text", ""), lambda c, i: F.struct(F.when(i == 0, "").otherwise(F.substring(F.col("text"), i, F.lit(1))).alias("a"), c.alias("b")))).alias("p"))
    n = len(ALPHABET)
    counts = [[[smooth] * n for _ in range(n + 1)] for _ in (0, 1)]
    for row in pairs.groupBy("label", "p.a", "p.b").count().collect():  # at most 2 * 67 * 67 rows
        if row.b:
            counts[1 if row.label else 0][ALPHABET.index(row.a) if row.a else START][ALPHABET.index(row.b)] += row["count"]
    ratio = lambda k, a, b: counts[k][a][b] / sum(counts[k][a])
    return [round(math.log(ratio(1, a, b)) - math.log(ratio(0, a, b)), 6) for a in range(n + 1) for b in range(n)]


def score(text: Column, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio a character of a string over the alphabet."""
    table, n = F.lit(ratios), len(ALPHABET)
    step = lambda a, c: F.struct(
        (F.instr(F.lit(ALPHABET), c) - 1).alias("p"), (a["s"] + F.get(table, a["p"] * n + F.instr(F.lit(ALPHABET), c) - 1)).alias("s")
    )
    return F.aggregate(F.split(text, ""), F.struct(F.lit(START).alias("p"), F.lit(0.0).alias("s")), step, lambda a: a["s"]) / F.length(text)


def _placed(pairs: Column) -> Column:
    """(s, e, t, g) of each match, from the gaps before them (g, the gap's length; t, the match; w, its group).

    Running sums by chunks, so that no long array is copied for each match.
    """
    chunk = 256
    empty = F.array().cast("array<int>")

    def run(xs: Column, at: Column) -> Column:
        step = lambda a, x: F.struct((a["p"] + x["g"] + x["m"]).alias("p"), F.concat(a["o"], F.array(a["p"] + x["g"])).alias("o"))
        return F.aggregate(xs, F.struct(at.cast("int").alias("p"), empty.alias("o")), step, lambda a: a["o"])

    def starts(p: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / chunk).cast("int")), lambda c: F.slice(p, c * chunk + 1, chunk))

        def whole(chunks: Column) -> Column:
            totals = F.transform(chunks, lambda xs: F.struct(F.lit(0).alias("g"), F.aggregate(xs, F.lit(0), lambda a, x: a + x["g"] + x["m"]).alias("m")))
            return F.flatten(F.zip_with(chunks, run(totals, F.lit(0)), run))

        return let(cut, whole)

    span = lambda x, s: F.struct(s.alias("s"), (s + x["m"]).alias("e"), x["t"].alias("t"), x["w"].alias("g"))
    return let(pairs, lambda p: F.zip_with(p, starts(p), span))


def matches(text: Column, pattern: str, group: int = 0, held: Column | None = None) -> Column:
    """(s, e, t, g) of all leftmost non-overlapping matches: places, the match and a group of it. Null if there is none.

    ``held``: whether there is one, if that is known.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    if group:
        named = F.arrays_zip(found.alias("t"), F.regexp_extract_all(text, F.lit(pattern), group).alias("w"))
    else:
        named = F.transform(found, lambda t: F.struct(t.alias("t"), t.alias("w")))
    pair = lambda gap, x: F.struct(F.length(gap).alias("g"), F.length(x["t"]).alias("m"), x["t"].alias("t"), x["w"].alias("w"))
    pairs = F.filter(F.zip_with(F.split(text, pattern, -1), named, pair), lambda x: x["t"].isNotNull())  # no match after the last gap
    return F.when(text.rlike(pattern) if held is None else held, _placed(pairs))


def _masked(text: Column, pattern: str, held: Column, keep=None, group: int = 0) -> Column:
    """The text with each match replaced by marks, as many as it has characters; ``keep``: which matches (group -> bool) stay; ``held``: whether there is one."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)
    mark = lambda t: F.concat(F.lit(FIRST), F.repeat(F.lit(REST), F.length(t) - 1))
    if keep is None:
        out = F.transform(found, mark)
    elif not group:
        out = F.transform(found, lambda t: F.when(keep(t), t).otherwise(mark(t)))
    else:
        judged = F.regexp_extract_all(text, F.lit(pattern), group)
        out = F.transform(F.arrays_zip(found.alias("t"), judged.alias("g")), lambda z: F.when(keep(z["g"]), z["t"]).otherwise(mark(z["t"])))
    whole = F.array_join(F.zip_with(gaps, out, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return F.when(held, whole).otherwise(text)


def _long_enough(least: int):
    return lambda x: F.length(x["g"]) >= least


def _of_kind(k: int):
    return lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e"), x["t"].alias("t"))


def _judge(ratios: list[float], threshold: float):
    """Whether a run is random: its mean ratio over the threshold and its whole ratio over the evidence."""
    return lambda t: score(t, ratios) > F.greatest(F.lit(threshold), F.lit(EVIDENCE) / F.length(t))


def _with_masks(rows: DataFrame, whole: Column) -> DataFrame:
    """Adds ``_masked``, the text with all base spans masked, each kind in what the kinds before it left, and ``_has_<kind>``."""
    masked = whole
    rows = rows.withColumns({f"_has_{kind}": whole.rlike(pattern) for kind, (pattern, _, _) in KINDS.items()})
    for kind, (pattern, group, least) in KINDS.items():
        masked = _masked(masked, pattern, F.col(f"_has_{kind}"), (lambda g, n=least: F.length(g) < n) if group else None, group)
        rows = rows.withColumn("_masked", masked)
        masked = F.col("_masked")
    return rows.withColumn("_has_runs", masked.rlike(CANDIDATE))


def _found(rows: DataFrame, whole: Column, ratios: list[float], threshold: float) -> DataFrame:
    """Adds ``_spans``: array of (s, k, e, t) by start, then kind; k counts kinds, 3 is the method's own."""
    none = F.array().cast("array<struct<s:int,k:int,e:int,t:string>>")
    rows = _with_masks(rows, whole)
    for kind, (pattern, group, _) in KINDS.items():
        rows = rows.withColumn(f"_{kind}", matches(whole, pattern, group, F.col(f"_has_{kind}")))
    judge = _judge(ratios, threshold)
    rows = rows.withColumn("_markov", F.filter(matches(F.col("_masked"), CANDIDATE, held=F.col("_has_runs")), lambda x: judge(x["t"])))
    parts = []
    for k, kind in enumerate(KINDS):
        parts.append(F.filter(f"_{kind}", _long_enough(KINDS[kind][2])))
    # a span whose start another kind's mask took can leave a piece: what lies inside a base span is no finding
    base = F.concat(*[F.coalesce(F.transform(p, _of_kind(k)), none) for k, p in enumerate(parts)])
    rows = rows.withColumn("_base", base)
    own = F.filter("_markov", lambda x: ~F.exists("_base", lambda b: (b["s"] <= x["s"]) & (x["e"] <= b["e"])))
    return rows.withColumn("_spans", F.sort_array(F.concat("_base", F.coalesce(F.transform(own, _of_kind(len(KINDS))), none))))


def find(docs: DataFrame, ratios: list[float], *, text: str = "text", threshold: float = 0.5, spans: str = "spans") -> DataFrame:
    """Adds (or replaces) the column ``spans``: array of (s, k, e, t) by start, then kind; k counts kinds, 3 is the method's own."""
    names = [c for c in docs.columns if c != spans]
    rows = docs.select(*[F.col(c).alias(f"_in_{c}") for c in names])
    rows = _found(rows, F.coalesce(F.col(f"_in_{text}").cast("string"), F.lit("")), ratios, threshold)
    return rows.select(*[F.col(f"_in_{c}").alias(c) for c in names], F.col("_spans").alias(spans))


def said(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.lit([*KINDS, "markov"])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def digests(docs: DataFrame, ratios: list[float]) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov."""
    rows = find(docs.select("doc_id", "text"), ratios, spans="_all")
    count = lambda k: F.size(F.filter("_all", lambda x: x["k"] == k)).cast("long")
    base = F.filter("_all", lambda x: x["k"] < len(KINDS))
    counts = [count(k).alias(f"n_{kind}") for k, kind in enumerate([*KINDS, "markov"])]
    return rows.select("doc_id", *counts[:3], F.sha2(said(base), 256).alias("base_sha256"), said(F.col("_all")).alias("spans"), counts[3])


def redacted(docs: DataFrame, ratios: list[float], mark: str = "[secret]", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with each secret replaced by ``mark``; n_chars, if there, anew. Other rows as they came.

    Spans are masked one kind after the other, so that overlapping ones become one mark or neighbouring ones. The two
    noncharacters that mask become U+FFFD where a text with secrets holds them.
    """
    names = docs.columns
    rows = docs.toDF(*[f"_in_{c}" for c in names])
    text = F.col("_in_text")
    plain = F.translate(F.coalesce(text.cast("string"), F.lit("")), FIRST + REST, "\ufffd\ufffd")
    rows = _with_masks(rows, plain)
    judge = _judge(ratios, threshold)
    rows = rows.withColumn("_masked", _masked(F.col("_masked"), CANDIDATE, F.col("_has_runs"), lambda t: ~judge(t)))
    held = F.col("_masked").contains(FIRST)
    rows = rows.withColumn("_in_text", F.when(held, F.regexp_replace("_masked", f"{FIRST}{REST}*", mark)).otherwise(text))
    if "n_chars" in names:
        rows = rows.withColumn("_in_n_chars", F.when(held, F.length("_in_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("_in_n_chars")))
    return rows.select(*[F.col(f"_in_{c}").alias(c) for c in names])
