"""Operator 4: language identification as inference of a mixture.

Each language has a character model (trigrams, interpolated with shorter ones) learned from a bounded sample of
labelled documents: about ``per_language`` documents a language, chosen by a hash of doc_id, of all languages that
there are. A document's words are drawn from a mixture of languages; expectation-maximisation estimates its
proportions from the words' likelihoods until no share moves by more than ``settled``, and languages are dropped from its
set, the smallest share first; the set with the best penalised likelihood stays.

A narrow map over all documents and whole texts. Null texts and texts without a letter are ``und`` with score 0, as is
everything if no document can be learned from. Repeated rows repeat; ties go to the first language by name.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import RecentCache, crc_mod, texts

LETTERS = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"


class CharacterModels:
    """log P(word | language) for all languages at once."""

    def __init__(self, samples: Iterable[tuple[str, str]], strength: float = 2.0):
        words: dict[str, Counter] = defaultdict(Counter)
        for lang, text in samples:
            words[lang].update(LETTERS.findall(text.lower()))
        self.languages = sorted(words)
        n = len(self.languages)
        counts = [defaultdict(lambda: np.zeros(n)) for _ in range(4)]  # by length of the n-gram
        for k, lang in enumerate(self.languages):
            for word, times in words[lang].items():
                w = f"  {word} "
                for i in range(2, len(w)):
                    for size in (1, 2, 3):
                        counts[size][w[i - size + 1 : i + 1]][k] += times
        letters = sum(counts[1].values()) if counts[1] else np.ones(n)
        self.base = np.log(1.0 / (letters + len(counts[1]) + 1)) if n else np.zeros(0)
        p1 = {c: (v + 1) / (letters + len(counts[1]) + 1) for c, v in counts[1].items()}
        floor = np.exp(self.base)
        contexts = [None, defaultdict(lambda: np.zeros(n)), defaultdict(lambda: np.zeros(n))]
        for size in (2, 3):
            for gram, v in counts[size].items():
                contexts[size - 1][gram[:-1]] += v
        weight = lambda size, context: strength / (contexts[size][context] + strength)
        p2 = {g: (v / (contexts[1][g[0]] + strength)) + weight(1, g[0]) * p1.get(g[1], floor) for g, v in counts[2].items()}
        p3 = {g: (v / (contexts[2][g[:2]] + strength)) + weight(2, g[:2]) * p2[g[1:]] for g, v in counts[3].items()}
        # one row of logs for each n-gram seen, and for what is left of a context when its n-gram was not
        self.logs = [{g: np.log(p) for g, p in level.items()} for level in (p1, p2, p3)]
        self.left = [None, *({c: np.log(strength / (v + strength)) for c, v in contexts[s].items()} for s in (1, 2))]

    def word(self, word: str) -> np.ndarray:
        w, total = f"  {word} ", np.zeros(len(self.languages))
        p1, p2, p3 = self.logs
        for i in range(2, len(w)):
            row = p3.get(w[i - 2 : i + 1])
            if row is None:
                total += self.left[2].get(w[i - 2 : i], 0.0)
                row = p2.get(w[i - 1 : i + 1])
                if row is None:
                    total += self.left[1].get(w[i - 1], 0.0)
                    row = p1.get(w[i], self.base)
            total += row
        return total

    def token(self, token: str) -> bytes:
        """Of the words in a token between blanks; a token without a letter gives zeros."""
        total = np.zeros(len(self.languages))
        for word in LETTERS.findall(token.lower()):
            total += self.word(word)
        return total.astype("<f4").tobytes()


def _expect_maximise(p: np.ndarray, times: np.ndarray, share: np.ndarray, sizes: np.ndarray, settled: float, rounds: int) -> np.ndarray:
    """Shares at which expectation-maximisation comes to rest, of each document on its own.

    ``p``, ``times``: likelihoods of the words (rows) of all documents, and how often each stands there. Documents at rest
    are set aside, so the others alone go on.
    """
    share, open_ = share.copy(), np.arange(len(sizes))
    words = np.add.reduceat(times, np.concatenate([[0], np.cumsum(sizes)[:-1]]))
    for _ in range(rounds):
        of = np.repeat(np.arange(len(open_)), sizes[open_])
        starts = np.concatenate([[0], np.cumsum(sizes[open_])[:-1]])
        now = share[open_]
        r = p * now[of]
        r *= (times / np.maximum(r.sum(axis=1), 1e-300))[:, None]
        new = np.add.reduceat(r, starts, axis=0) / words[open_][:, None]
        share[open_] = new
        moving = np.abs(new - now).max(axis=1) > settled
        if not moving.any():
            break
        if not moving.all():
            p, times, open_ = p[moving[of]], times[moving[of]], open_[moving]
    return share


def mixtures(logs: np.ndarray, sizes: np.ndarray, penalty: float = 4.0, settled: float = 1e-3, rounds: int = 1000, times: np.ndarray | None = None) -> np.ndarray:
    """Proportions of languages (rows: documents) for word log-likelihoods; ``sizes``: rows of each document, over 0.

    ``times``: how often the word of each row stands in its document (once each, if not given).

    Starts from all languages; then, one by one, the smallest goes and the rest is fitted again. Of all sets the one
    with the best penalised likelihood stays: ``penalty`` times the logarithm of the number of words a language.
    ``rounds`` is a guard against a likelihood so flat that shares creep for ever.
    """
    docs, langs, logs = len(sizes), logs.shape[1], logs.astype(np.float64)
    starts, of = np.concatenate([[0], np.cumsum(sizes)[:-1]]), np.repeat(np.arange(docs), sizes)
    times = np.ones(len(logs)) if times is None else times.astype(np.float64)
    words, top = np.add.reduceat(times, starts), logs.max(axis=1)
    p = np.exp(logs - top[:, None])
    share = np.full((docs, langs), 1.0 / langs)
    best, value = share.copy(), np.full(docs, -np.inf)
    for left in range(langs, 0, -1):
        if left > 1:
            share = _expect_maximise(p, times, share, sizes, settled, rounds)
        s = np.maximum((p * share[of]).sum(axis=1), 1e-300)
        now = np.add.reduceat(times * (np.log(s) + top), starts) - penalty * left * np.log(words + 1.0)
        better = now >= value
        best[better], value[better] = share[better], now[better]
        if left > 1:
            low = np.where(share > 0, share, np.inf).argmin(axis=1)
            share[np.arange(docs), low] = 0.0
            total = share.sum(axis=1, keepdims=True)
            share = np.where(total > 0, share / np.maximum(total, 1e-300), best)
    return best


def learn(docs: DataFrame, per_language: int = 300, held_out: int = 2, most: int | None = None, most_rows: int = 60_000) -> CharacterModels:
    """Models of all languages of documents whose crc32(doc_id) mod 4 is not ``held_out`` (of the ``most`` commonest, if given).

    The sample has about ``per_language`` documents a language, fewer where there are so many languages that it would
    have over ``most_rows``; never more than twice that come to the driver.
    """
    known = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (crc_mod(F.col("doc_id"), 4) != held_out))
    by_size = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    by_size = by_size if most is None else by_size.orderBy(F.desc("n"), "lang").limit(most)
    sizes = {r.lang: r["n"] for r in by_size.collect()}  # a row a language
    if not sizes:
        return CharacterModels([])
    per_language = max(1, min(per_language, most_rows // len(sizes)))
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, per_language / n))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    rows = known.where(draw < share[F.col("lang")]).select("lang", "text").limit(2 * per_language * len(sizes)).collect()
    return CharacterModels((r.lang, r.text) for r in rows)


def _scored(models: CharacterModels, rows: list[str | None], cache: RecentCache, most_words: int = 50_000) -> tuple[list[str], list[float], list[str]]:
    """Prediction, share and set of each text; mixtures are fitted to documents of about ``most_words`` words at once.

    Words that a text repeats are one row with a count, so a text takes memory for its distinct words alone.
    """
    names, n = models.languages, len(models.languages)
    pred, score, sets = [UNDETERMINED] * len(rows), [0.0] * len(rows), [""] * len(rows)
    if not n:
        return pred, score, sets
    held: list[int] = []
    logs: list[np.ndarray] = []
    times: list[np.ndarray] = []

    def fit() -> None:
        shares = mixtures(np.concatenate(logs), np.array([len(x) for x in logs]), times=np.concatenate(times))
        for i, row in zip(held, shares, strict=True):
            order = np.argsort(-row, kind="stable")
            pred[i], score[i] = names[order[0]], float(min(1.0, row[order[0]]))
            sets[i] = "+".join(names[k] for k in order if row[k] > 0)
        held.clear()
        logs.clear()
        times.clear()

    words = 0
    for i, text in enumerate(rows):
        if text:
            counts = Counter(text.split())
            x = np.frombuffer(b"".join([cache[t] for t in counts]), "<f4").reshape(-1, n)
            lettered = x[:, 0] != 0.0
            if lettered.any():
                held.append(i)
                logs.append(x[lettered])
                times.append(np.fromiter(counts.values(), np.float64, len(counts))[lettered])
                words += len(logs[-1])
                if words >= most_words:
                    fit()
                    words = 0
    if held:
        fit()
    return pred, score, sets


def identify(docs: DataFrame, models: CharacterModels, *, pred: str = "lang_pred", score: str = "score", sets: str = "lang_set") -> DataFrame:
    """Adds (or replaces) the predicted language, its share of the words and the whole set, joined by ``+``."""
    keep = docs.drop(pred, score, sets)
    schema = StructType([*keep.schema.fields, StructField(pred, StringType()), StructField(score, DoubleType()), StructField(sets, StringType())])
    sent = docs.sparkSession.sparkContext.broadcast(models)  # a few MB: n-grams of a bounded sample

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        cache = RecentCache(own.token, 100_000)
        for part, rows in texts(batches):
            added = [pa.array(c, t) for c, t in zip(_scored(own, rows, cache), (pa.string(), pa.float64(), pa.string()), strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns, *added], names=[*part.schema.names, pred, score, sets])

    return keep.mapInArrow(run, schema)


def predictions(docs: DataFrame, per_language: int = 300) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, lang_set."""
    rows = docs.select("doc_id", "text")
    found = identify(rows, learn(docs.select("doc_id", "text", "lang"), per_language))
    return found.select("doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "lang_set")


def identified(docs: DataFrame, per_language: int = 300, least: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose language is determined with at least ``least`` of the words; columns of any names."""
    own = [f"_{k}_" for k in ("pred", "score", "set")]
    while set(own) & set(docs.columns):  # a name that no column has
        own = [f"_{c}" for c in own]
    found = identify(docs, learn(docs.select("doc_id", "text", "lang"), per_language), pred=own[0], score=own[1], sets=own[2])
    return found.where((F.col(own[0]) != UNDETERMINED) & (F.col(own[1]) >= least)).select(*[F.col(f"`{c}`") for c in docs.columns])
