"""Operator 9: toxicity by a factorization machine over hashed terms.

A document is the set of its hashed lower-case words and word stems. The score is the logistic of a bias, a weight for each term, and
the inner product of factor vectors for each pair of terms, so that terms count more, or only, in company. Weights and
factors are learned by AdaGrad on the logistic loss from a bounded sample of labelled documents, for every term of
them; a soft threshold, the higher the less a term tells of the label, holds those of chance terms at zero.

The sample's ids (at most ``2 * each``, so they can be broadcast) are drawn from the labels alone by a hash of doc_id;
only their documents' distinct terms come to the driver, four bytes each. Scoring is a narrow map over all documents and whole texts. Null and
empty texts have no terms and get the bias's score; with no labels, or one class only, every score is that class's
share. Repeated labels of a document count as toxic if one does; repeated rows repeat. Very long texts count each term once.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RecentCache, crc_mod, texts

WORD = re.compile(r"[^\W_]+")
BITS = 20
STEMS = (4, 5)


def hashed(token: str, bits: int = BITS) -> bytes:
    """The hashed words of a token between blanks and their stems, as unsigned 32-bit integers.

    A stem is the first four or five letters of a longer word, so that inflected forms share a term.
    """
    words = WORD.findall(token.lower())
    both = words + [f"{w[:n]}*" for w in words for n in STEMS if len(w) > n]
    return b"".join([(zlib.crc32(w.encode("utf-8", "surrogatepass")) & ((1 << bits) - 1)).to_bytes(4, "little") for w in both])


def terms(text: str | None, cache: RecentCache) -> np.ndarray:
    """Distinct hashed terms of a whole text."""
    return np.unique(np.frombuffer(b"".join([cache[t] for t in text.split()]), "<u4")) if text else np.empty(0, np.uint32)


class FactorizationMachine:
    """w0 + sum of w_i + sum over pairs of <v_i, v_j>, for sets of terms; terms not learned have no weight."""

    def __init__(self, w0: float, index: np.ndarray, w: np.ndarray, v: np.ndarray):
        self.w0, self.index, self.w, self.v = w0, index, w, v

    def raw(self, rows: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(r) for r in rows])
        flat = np.concatenate([np.empty(0, np.uint32), *rows])
        out = np.full(len(rows), self.w0)
        if not len(self.index) or not len(flat):
            return out
        at = np.minimum(np.searchsorted(self.index, flat), len(self.index) - 1)
        here = np.flatnonzero(self.index[at] == flat)
        at, doc = at[here], np.repeat(np.arange(len(rows)), sizes)[here]
        out += np.bincount(doc, self.w[at], len(rows))
        for f in range(self.v.shape[1]):
            x = self.v[at, f]
            out += 0.5 * (np.bincount(doc, x, len(rows)) ** 2 - np.bincount(doc, x * x, len(rows)))
        return out

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(rows), -30, 30)))


def tells(rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms, of each the log-likelihood-ratio statistic (G^2) of term and label, and the place of every term of the rows."""
    flat, toxic = np.concatenate(rows), np.repeat(labels, [len(r) for r in rows])
    index, slot, counts = np.unique(flat, return_inverse=True, return_counts=True)
    with_term = np.bincount(slot, toxic, len(index)), np.bincount(slot, 1 - toxic, len(index))
    n = labels.sum(), len(labels) - labels.sum()
    tell = np.zeros(len(index))
    for a, m in zip(with_term, n, strict=True):
        for seen, expected in ((a, m * counts / len(labels)), (m - a, m * (1 - counts / len(labels)))):
            tell += 2 * np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0)
    return index, tell, slot


def fit(rows: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, *, factors: int = 4, epochs: int = 20, rate: float = 0.1, l1: float = 1e-3, power: float = 2.0, seed: int = 1) -> FactorizationMachine:
    """Learns from sets of terms, labels 0 or 1 and importance weights, over all terms of the rows.

    Every term has a weight and factors, and a penalty of its own: ``l1`` times a power of how far its G^2 falls short
    of, or exceeds, what the most telling of so many chance terms would have (``2 * log(terms)``). So the soft threshold
    itself holds chance terms at zero, and no term is left out beforehand.
    """
    empty = np.empty(0, np.uint32), np.empty(0), np.empty((0, factors))
    if not len(rows) or len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.0
        share = min(max(share, 1e-6), 1 - 1e-6)
        return FactorizationMachine(float(np.log(share / (1 - share))), *empty)
    index, tell, slot = tells(rows, labels)
    share = float(np.average(labels, weights=weights))
    w0, g0 = float(np.log(share / (1 - share))), 1e-8
    if not len(index):
        return FactorizationMachine(w0, *empty)
    penalty = l1 * np.minimum((2 * np.log(len(index) + 1) / np.maximum(tell, 1e-9)) ** power, 1e6)
    place = np.split(slot, np.cumsum([len(r) for r in rows])[:-1])
    rng = np.random.default_rng(seed)
    w, v = np.zeros(len(index)), rng.normal(0, 0.01, (len(index), factors))
    gw, gv = np.full(len(index), 1e-8), np.full((len(index), factors), 1e-8)
    weights = weights / weights.mean()
    here, numbered = np.zeros(len(index), bool), np.zeros(len(index), np.int64)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for some in np.array_split(order, max(1, len(order) // 64)):
            sizes = np.array([len(place[i]) for i in some])
            at, doc = np.concatenate([place[i] for i in some]), np.repeat(np.arange(len(some)), sizes)
            x = v[at]
            total = np.stack([np.bincount(doc, x[:, f], len(some)) for f in range(factors)], axis=1)
            square = np.bincount(doc, (x * x).sum(axis=1), len(some))
            raw = w0 + np.bincount(doc, w[at], len(some)) + 0.5 * ((total**2).sum(axis=1) - square)
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[some]) * weights[some] / len(some)
            here[at] = True
            own = np.flatnonzero(here)
            here[own], numbered[own] = False, np.arange(len(own))
            slot = numbered[at]
            dw = np.bincount(slot, error[doc], len(own))
            dv = np.stack([np.bincount(slot, error[doc] * (total[doc, f] - x[:, f]), len(own)) for f in range(factors)], axis=1)
            g0 += error.sum() ** 2
            w0 -= rate * error.sum() / np.sqrt(g0)
            gw[own] += dw * dw
            gv[own] += dv * dv
            step = rate / np.sqrt(gw[own])
            moved = w[own] - step * dw
            w[own] = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty[own], 0)
            step = rate / np.sqrt(gv[own])
            moved = v[own] - step * dv
            v[own] = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty[own, None], 0)
    live = (w != 0) | (v != 0).any(axis=1)
    return FactorizationMachine(w0, index[live], w[live], v[live])


def labelled(docs: DataFrame, labels: DataFrame, each: int, held_out: int) -> DataFrame:
    """(terms, toxic, weight) of a sample: about ``each`` documents of either class, never more than twice that.

    Labels other than 0 and 1 are no labels; of several of one document the greatest counts.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (crc_mod(F.col("doc_id"), 3) != held_out))
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r.toxic: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 30)) / float(1 << 30)
    parts = [known.where((F.col("toxic") == c) & (draw < min(1.0, each / n))).limit(2 * each).withColumn("weight", F.lit(max(1.0, n / each))) for c, n in sizes.items()]
    if not parts:
        return known.select(F.lit(b"").alias("terms"), "toxic", F.lit(1.0).alias("weight")).limit(0)
    sample = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = RecentCache(hashed, 200_000)
        for part, rows in texts(batches):
            found = pa.array([terms(t, cache).astype("<u4").tobytes() for t in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([found, part.column(1), part.column(2)], names=["terms", "toxic", "weight"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")
    return rows.select("text", "toxic", "weight").mapInArrow(run, "terms binary, toxic int, weight double")


def learn(docs: DataFrame, labels: DataFrame, each: int = 3000, held_out: int = 1) -> FactorizationMachine:
    """Learns from labelled documents whose crc32(doc_id) mod 3 is not ``held_out``."""
    rows = labelled(docs, labels, each, held_out).toArrow()
    sets = [np.frombuffer(x, "<u4") for x in rows.column("terms").to_pylist()]
    return fit(sets, rows.column("toxic").to_numpy().astype(float), rows.column("weight").to_numpy())


def predictions(docs: DataFrame, labels: DataFrame, each: int = 3000, threshold: float = 0.7) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted."""
    sent = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, each))  # as large as the terms of a bounded sample

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, cache = sent.value, RecentCache(partial(hashed), 300_000)
        for part, rows in texts(batches):
            scores = machine.scores([terms(t, cache) for t in rows])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores)], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, score double")
    return found.select("doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
