"""Operator 11: ranked lexical search over a tiered index.

The index has, for each term, the documents that hold it and the part of the score that depends on the document alone
(its *impact*). A term's postings are dealt to tiers by falling impact: the first tier holds about the thousand best of
each term, each further one 32 times as many, the last one the rest. For each term and tier the greatest impact that is
left below is kept: the residual bound.

A search scores all items on the first tier. A document's upper bound is what it has gathered plus the residual bounds of
the item's terms that were not seen in it. If the bound of a document that was never seen is less than an item's 20th
gathered score, no such document can be in the result: the seen ones whose upper bound reaches that score are looked up
in the lower tiers, and their exact scores rank them. Items that lack this proof fall through to the next tier; below the
last one nothing is left, so every item ends with exact scores.

Layout: an Arrow batch of documents is a chunk, inverted where it is read; a row is the postings of one term in one
chunk, so the commonest term has one row a chunk and no key grows with the documents. Histograms of impacts (62 classes a
term) combine before the shuffle and give document frequencies, tiers and bounds. Items come in blocks of a bounded
number of terms, which are sent to the tasks; a task keeps 20 documents an item. All arithmetic is in whole numbers.

Texts that are null or hold no term are in no list; items without a term, or whose terms weigh nothing, get no rows. Rows
that repeat a doc_id are documents of their own, and share a rank's order by their place; null ids come after all others
of equal score. Rows that repeat an item_id are ranked each on their own. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, stored_at

#: Bytes of terms: all but ASCII that is neither letter nor digit. Of UTF-8, that is the same as of code points.
_IS_TERM = np.array([b >= 0x80 or bytes([b]).isalnum() for b in range(256)])
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
#: The term of the row that holds a chunk's documents; no term is empty.
HEAD = ""
#: Impacts are below 2^20; histograms have a class for each 2^14.
_CLASS = 14
#: Items of a block have about so many terms in all.
BLOCK = 200_000
_FOUND = "item int, score long, chunk long, doc int, doc_id long"


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(terms, term, doc, tf): the distinct terms of some texts, and a posting for each term and text, by term."""
    whole = pc.fill_null(texts, "").cast(pa.large_string())
    ends = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    data = np.frombuffer(whole.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    inside = _IS_TERM[data]
    cut = np.zeros(len(data) + 1, bool)  # where a text begins
    cut[ends] = True
    start = np.flatnonzero(inside & (cut[:-1] | ~np.concatenate([[False], inside[:-1]]))) if len(data) else np.empty(0, np.int64)
    stop = np.flatnonzero(inside & (cut[1:] | ~np.concatenate([inside[1:], [False]]))) + 1 if len(data) else start
    offsets = np.concatenate([[0], np.cumsum(stop - start)]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER[data][inside])])
    coded = words.dictionary_encode()
    doc, n = np.searchsorted(ends, start, side="right") - 1, max(1, len(whole))
    key, tf = np.unique(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * n + doc, return_counts=True)
    return coded.dictionary.cast(pa.large_string()), key // n, key % n, tf


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What postings add to a score, before their term's weight."""
    sizes, of = np.unique(n, return_inverse=True)
    m = np.array([100 - 25 + 25 * int(s) * documents // length for s in sizes], np.int64)[of]
    return 1_000_000_000 * tf.astype(np.int64) // (1000 * tf.astype(np.int64) + 12 * m)


class Index(NamedTuple):
    """Tiered postings (tier, chunk, term, docs, impact), documents of each chunk, terms, and the number of tiers."""

    postings: DataFrame
    heads: DataFrame
    terms: DataFrame
    tiers: int


def _blobs(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, row of each) of a column of arrays in bytes."""
    parts = [np.frombuffer(b, kind) for b in column.to_pylist()]
    return np.concatenate([np.empty(0, kind), *parts]), np.repeat(np.arange(len(parts)), [len(p) for p in parts])


def inverted(docs: DataFrame) -> DataFrame:
    """A row for each term of each chunk: documents, occurrences and lengths; the head row has the chunk's documents."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        names = ["chunk", "term", "docs", "tf", "n", "held", "length"]
        for batch in batches:
            if not batch.num_rows:
                continue
            terms, term, doc, tf = terms_of(batch.column(1))
            n = np.bincount(doc, tf, minlength=batch.num_rows).astype(np.int64)
            known = batch.column(0).is_valid()
            head = [[chunk], [HEAD], [pc.fill_null(batch.column(0), 0).to_numpy().astype("<i8").tobytes()], [known.to_numpy(zero_copy_only=False).tobytes()], [n.tobytes()], [int((n > 0).sum())], [int(n.sum())]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(head, (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()), strict=True)], names=names)
            ends = np.searchsorted(term, np.arange(len(terms) + 1))
            doc32, tf32, n32 = doc.astype("<i4"), tf.astype("<i4"), n[doc].astype("<i4")
            blob = lambda x, some: pa.Array.from_buffers(pa.binary(), len(some) - 1, [None, pa.py_buffer(((some - some[0]) * 4).astype(np.int32)), pa.py_buffer(x[some[0] : some[-1]])])
            for at in range(0, len(terms), 20_000):
                some = ends[at : at + 20_001]
                rows = len(some) - 1
                nothing = pa.nulls(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(rows, chunk)), terms.slice(at, rows).cast(pa.string()), blob(doc32, some), blob(tf32, some), blob(n32, some), nothing, nothing],
                    names=names,
                )
            chunk += 1

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(run, "chunk long, term string, docs binary, tf binary, n binary, held long, length long")


def build(docs: DataFrame, wanted: DataFrame | None = None, first: int = 1024, ratio: int = 32) -> Index:
    """The tiered index of all documents; ``wanted``: a column ``term`` of the terms that will be searched (none: all).

    A tier holds ``first`` postings a term, or so (whole classes of impact), and each further one ``ratio`` times more.
    """
    rows = inverted(docs)
    if wanted is not None:
        head = docs.sparkSession.createDataFrame([(HEAD,)], "term string")
        rows = rows.join(wanted.select("term").union(head).distinct(), "term", "left_semi")
    rows = stored(rows, "search-inverted")
    heads, inner = rows.where(F.col("term") == HEAD), rows.where(F.col("term") != HEAD)
    total = heads.agg(F.sum("held").alias("held"), F.sum("length").alias("length")).first()
    documents, length = total.held or 0, total.length or 0
    caps = [first]
    while caps[-1] < documents:
        caps.append(caps[-1] * ratio)

    def classes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (tf, row), (n, _) = _blobs(batch.column(1), "<i4"), _blobs(batch.column(2), "<i4")
            key = np.sort(row.astype(np.int64) << 20 | impacts(tf, n, documents, length))
            new = np.flatnonzero(np.diff(key >> _CLASS, prepend=-1))
            last = np.append(new[1:], len(key)) - 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(key[new] >> 20)), pa.array(((key[new] >> _CLASS) & 63).astype(np.int32)), pa.array(last - new + 1), pa.array(key[last] & ((1 << 20) - 1))],
                names=["term", "class", "count", "most"],
            )

    def weighed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for term, has in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                has.sort(key=lambda c: -c["class"])
                frequency = sum(c["count"] for c in has)
                weight = math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))
                tier, left, gathered = bytearray(64), [0] * len(caps), 0
                for c in has:
                    gathered += c["count"]
                    t = tier[c["class"]] = next(k for k, cap in enumerate(caps) if gathered <= cap or k == len(caps) - 1)
                    for k in range(t):
                        left[k] = max(left[k], c["most"])
                out.append((term, frequency, weight, bytes(tier), left))
            if out:
                names = ["term", "frequency", "weight", "tier_of", "left"]
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    def dealt(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (tf, row), (n, _), (doc, _) = (_blobs(batch.column(batch.schema.get_field_index(c)), "<i4") for c in ("tf", "n", "docs"))
            impact = impacts(tf, n, documents, length)
            of = np.frombuffer(b"".join(batch.column(batch.schema.get_field_index("tier_of")).to_pylist()), np.uint8).reshape(-1, 64)
            tier = of[row, impact >> _CLASS]
            order = np.lexsort((tier, row))
            key = row[order].astype(np.int64) << 8 | tier[order]
            new = np.flatnonzero(np.diff(key, prepend=-1))
            ends = (np.append(new, len(key)) * 4).astype(np.int32)
            blob = lambda x: pa.Array.from_buffers(pa.binary(), len(new), [None, pa.py_buffer(ends), pa.py_buffer(x[order].astype("<i4"))])
            at = pa.array(key[new] >> 8)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), blob(doc), blob(impact), pa.array((key[new] & 255).astype(np.int32))],
                names=["chunk", "term", "docs", "impact", "tier"],
            )

    counted = inner.select("term", "tf", "n").mapInArrow(classes, "term string, class int, count long, most long")
    counted = counted.groupBy("term", "class").agg(F.sum("count").alias("count"), F.max("most").alias("most"))
    of_term = counted.groupBy("term").agg(F.collect_list(F.struct("class", "count", "most")).alias("has"))
    terms = stored(of_term.mapInArrow(weighed, "term string, frequency long, weight long, tier_of binary, left array<long>"), "search-terms")
    parts = inner.join(terms.where("weight > 0").select("term", "tier_of"), "term").select("chunk", "term", "docs", "tf", "n", "tier_of")
    postings = stored_at(parts.mapInArrow(dealt, "chunk long, term string, docs binary, impact binary, tier int"), "search-tiers", "tier")[0]
    return Index(postings, heads.select("chunk", "term", F.col("docs").alias("docs"), F.col("tf").alias("impact")), terms, len(caps))


def item_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, term, times): a row for each term of each row of items, which gets a number of its own."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = TaskContext.get().partitionId() << 32
        for batch in batches:
            terms, term, row, times = terms_of(batch.column(1))
            yield pa.RecordBatch.from_arrays([pa.array(item + row), batch.column(0).take(pa.array(row)), terms.take(pa.array(term)).cast(pa.string()), pa.array(times)], names=["item", "item_id", "term", "times"])
            item += batch.num_rows

    return items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "item long, item_id long, term string, times long")


class _Best:
    """The best ``top`` documents of each item that a task has seen, and the score that a further one has to reach."""

    def __init__(self, items: int, top: int):
        self.top, self.least, self.rows = top, np.ones(items, np.int64), []

    def add(self, *columns: np.ndarray) -> None:
        self.rows.append(columns)
        if sum(len(r[0]) for r in self.rows) > 200_000:
            self.prune()

    def prune(self) -> tuple[np.ndarray, ...]:
        """(item, score, chunk, doc, doc_id, id known), of each item the best."""
        item, score, chunk, doc, ids, known = (np.concatenate(c) for c in zip(*self.rows, strict=True))
        order = np.lexsort((doc, chunk, ids, ~known, -score, item))
        of = item[order]
        place = np.arange(len(of)) - np.searchsorted(of, of)
        order = order[place < self.top]
        self.rows = [tuple(c[order] for c in (item, score, chunk, doc, ids, known))]
        last = place[place < self.top] == self.top - 1
        self.least[item[order][last]] = score[order][last]
        return self.rows[0]


class _Block:
    """Some items, as the tasks need them: the weights of each term's items, and bounds at each tier."""

    def __init__(self, rows: list, tiers: int):
        self.items = sorted({r.item for r in rows})
        place = {item: i for i, item in enumerate(self.items)}
        self.ids = {place[r.item]: r.item_id for r in rows}
        self.terms: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.bounds = [[0] * tiers for _ in self.items]
        found: dict[str, list] = {}
        for r in rows:
            found.setdefault(r.term, []).append((place[r.item], r.weight, r.left))
            for k, left in enumerate(r.left):
                self.bounds[place[r.item]][k] += r.weight * left
        for term, has in found.items():
            item, weight, left = zip(*has, strict=True)
            self.terms[term] = np.array(item), np.array(weight, np.int64), np.array(left[0], np.int64)

    def only(self, items: set[int]) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        keep = np.array(sorted(items))
        some = {t: (i, w, left, np.isin(i, keep)) for t, (i, w, left) in self.terms.items()}
        return {t: (i[k], w[k], left) for t, (i, w, left, k) in some.items() if k.any()}


def scored(rows: DataFrame, asked: dict, least: np.ndarray, top: int, tier: int, bounds: np.ndarray | None = None, cells: int = 1 << 21) -> DataFrame:
    """Scores of the postings in ``rows`` (with head rows) by item and document.

    Without ``bounds``, the best of each item that a task has seen. With the bounds of each item at this tier, every
    document whose upper bound is ``least`` of its item or more.
    """

    def one(chunk: int, ids: np.ndarray, known: np.ndarray, held: list, best: _Best) -> Iterator[tuple]:
        width = max(1, cells // max(1, len(ids)))  # items at once
        used = np.unique(np.concatenate([asked[t][0] for t, _, _ in held]))
        for at in range(0, len(used), width):
            some = used[at : at + width]
            score = np.zeros((len(some), len(ids)), np.int64)
            upper = np.repeat(bounds[some][:, None], len(ids), 1) if bounds is not None else None
            for term, doc, impact in held:
                item, weight, left = asked[term]
                if len(some) < len(used):
                    inside = (item >= some[0]) & (item <= some[-1])
                    item, weight = item[inside], weight[inside]
                    if not len(item):
                        continue
                cell = np.ix_(np.searchsorted(some, item), doc)
                score[cell] += weight[:, None] * impact
                if upper is not None:
                    upper[cell] += weight[:, None] * (impact - left[tier])
            reach = least[some] if upper is not None else np.maximum(least[some], best.least[some])
            i, d = np.nonzero(((upper if upper is not None else score) >= reach[:, None]) & (score > 0))
            yield some[i], score[i, d], np.full(len(i), chunk), d, ids[d], known[d]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, head, held = _Best(len(least), top), None, []

        def out(item, score, chunk, doc, ids, known) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(item.astype(np.int32)), pa.array(score), pa.array(chunk.astype(np.int64)), pa.array(doc.astype(np.int32)), pa.array(ids, mask=~known)],
                names=["item", "score", "chunk", "doc", "doc_id"],
            )

        def ended() -> Iterator[pa.RecordBatch]:
            if head and held:
                for found in one(*head, held, best):
                    if not len(found[0]):
                        continue
                    if bounds is None:
                        best.add(*found)
                    else:
                        yield out(*found)

        for batch in batches:
            for chunk, term, docs, impact in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if term == HEAD:
                    yield from ended()
                    head, held = (chunk, np.frombuffer(docs, "<i8"), np.frombuffer(impact, bool)), []
                elif term in asked:
                    held.append((term, np.frombuffer(docs, "<i4"), np.frombuffer(impact, "<i4").astype(np.int64)))
        yield from ended()
        if best.rows:
            yield out(*best.prune())

    together = rows.select("chunk", "term", "docs", "impact").repartition("chunk").sortWithinPartitions("chunk", "term")
    return together.mapInArrow(run, _FOUND)


def ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "chunk", "doc")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(index: Index, items: DataFrame, top: int = 20, block: int = BLOCK) -> DataFrame:
    """The ``top`` documents of each row of ``items`` (item_id, text): item_id, rank, doc_id, score."""
    return _searched(index, stored(item_terms(items), "search-items"), top, block)


def _searched(index: Index, own: DataFrame, top: int, block: int) -> DataFrame:
    spark = own.sparkSession
    weighed = index.terms.where("weight > 0").select("term", "weight", "left")
    asked = stored(own.join(weighed, "term").select("item", "item_id", "term", (F.col("times") * F.col("weight")).alias("weight"), "left"), "search-asked")
    blocks, found = max(1, math.ceil(asked.count() / block)), []
    for b in range(blocks):
        some = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b) if blocks > 1 else asked
        if rows := some.collect():  # bounded: a block
            found += _block_searched(index, _Block(rows, index.tiers), top)
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found)


def _block_searched(index: Index, block: _Block, top: int) -> list[DataFrame]:
    spark, open_, found = index.heads.sparkSession, set(range(len(block.items))), []
    names = spark.createDataFrame([(i, v) for i, v in block.ids.items()], "item int, item_id long")
    n = len(block.items)

    def local(rows: list[tuple], schema: str) -> DataFrame:
        return F.broadcast(spark.createDataFrame(rows, schema))  # bounded: terms of a block

    def keep(rows: DataFrame) -> None:
        found.append(stored(ranked(rows, top), "search-found").join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))

    for tier in range(index.tiers):
        asked = block.only(open_)
        upto = index.postings.where(F.col("tier") <= tier).drop("tier").join(local([(t,) for t in asked], "term string"), "term", "left_semi")
        rows = upto.unionByName(index.heads)
        best = stored(ranked(scored(rows, asked, np.ones(n, np.int64), top, tier), top), "search-best")
        reached = {r.item: r.least if r.n == top else 1 for r in best.groupBy("item").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).collect()}
        bound = {i: block.bounds[i][tier] for i in open_}
        proven = {i for i in open_ if bound[i] < reached.get(i, 1)}
        whole = {i for i in proven if not bound[i]}  # nothing of their terms is left below: these scores are exact
        if whole:
            keep(best.join(local([(i,) for i in whole], "item int"), "item", "left_semi"))
        if part := proven - whole:
            least = np.full(n, 1, np.int64)
            for i in part:
                least[i] = reached[i]
            own, bounds = block.only(part), np.array([b[tier] for b in block.bounds], np.int64)
            hopeful = stored(scored(rows, own, least, top, tier, bounds), "search-hopeful").select("item", "chunk").distinct()
            pairs = hopeful.join(local([(int(i), t) for t, (item, _, _) in own.items() for i in item], "item int, term string"), "item").select("chunk", "term").distinct()
            exact = index.postings.drop("tier").join(pairs, ["chunk", "term"], "left_semi").unionByName(index.heads.join(hopeful.select("chunk").distinct(), "chunk", "left_semi"))
            keep(scored(exact, own, least, top, tier))
        open_ -= proven
        if not open_:
            break
    return found


def searched(docs: DataFrame, items: DataFrame, top: int = 20, **tiers: int) -> DataFrame:
    """Builds the index of the items' terms over ``docs``, then searches it."""
    own = stored(item_terms(items), "search-items")
    return _searched(build(docs, own, **tiers), own, top, BLOCK)


ORACLE = r"""
WITH t AS (SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
doc AS (SELECT d, doc_id, len(w) AS n FROM t),
tot AS (SELECT count(*) FILTER (WHERE n > 0) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM doc),
tf AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(w) AS term FROM t) GROUP BY ALL),
wt AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS wt FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), tot),
b AS (SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
q AS (SELECT i, item_id, term, count(*) AS times FROM (SELECT i, item_id, unnest(w) AS term FROM b) GROUP BY ALL),
s AS (SELECT i, item_id, d, doc_id, CAST(sum(times * wt * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * nn) // ll)))) AS BIGINT) AS score
  FROM q JOIN wt USING (term) JOIN tf USING (term) JOIN doc USING (d), tot GROUP BY ALL),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, d) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""
