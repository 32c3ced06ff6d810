"""Very long texts, labels that are none, words with counts, and what learned models score on held-out rows."""

import time
import zlib

import numpy as np
import pytest

from wirelark.llm import language, licenses, packing, quality, toxicity

from .test_ops import collected, prose

SF = "/root/testdata/sf0.1"


def long_text(words):
    r = np.random.default_rng(5)
    return " ".join(r.choice(["alpha", "beta", "gamma", "delta"], words).tolist()) + "\n" + "z" * words


@pytest.mark.parametrize("name", ["quality", "language", "toxicity", "licenses"])
def test_work_stays_in_proportion_to_a_long_text(spark, name):
    def docs(words):
        rows = [(i, prose(i, 3), "en" if i % 2 else "de", "s") for i in range(8)] + [(99, long_text(words), None, "s")]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")

    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, toxic int")
    run = {
        "quality": quality.judge, "language": language.predictions, "toxicity": lambda d: toxicity.predictions(d, labels), "licenses": licenses.licensed,
    }[name]
    took = []
    for words in (20_000, 20_000, 200_000):
        began = time.time()
        rows = collected(run(docs(words)))
        took.append(time.time() - began)
        assert sorted(r[0] for r in rows) == [*range(8), 99]
    assert took[2] < 12 * took[1] + 20


def test_words_with_counts_are_words_repeated():
    r = np.random.default_rng(1)
    logs, times = r.normal(-8, 2, (30, 4)), r.integers(1, 6, 30)
    sizes = np.array([10, 5, 15])
    whole = np.repeat(logs, times, axis=0)
    of = np.repeat(np.arange(3), sizes)
    whole_sizes = np.array([times[of == k].sum() for k in range(3)])
    assert np.allclose(language.mixtures(logs, sizes, times=times), language.mixtures(whole, whole_sizes), atol=1e-9)


def test_more_languages_share_a_bounded_sample(spark):
    rows = [(i, f"{chr(97 + i % 20)}{chr(98 + i % 20)}x " * 5, f"l{i % 20:02}") for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = language.learn(frame, per_language=300, held_out=2, most_rows=100)
    assert 15 <= len(models.languages) <= 20 and language.learn(frame).languages == sorted({r[2] for r in rows})


def test_labels_other_than_0_and_1_are_none(spark):
    docs = spark.createDataFrame([(i, f"bad word {i}" if i % 2 else f"good thing {i}") for i in range(200)], "doc_id long, text string")
    pairs = [(i, i % 2) for i in range(200)]
    odd = [(i, k) for i in range(0, 200, 3) for k in (2, -1, 7)] + [(500, 1), (None, 1), (3, None)]
    plain, more = (spark.createDataFrame(p, "doc_id long, toxic int") for p in (pairs, pairs + odd))
    assert collected(toxicity.predictions(docs, plain).orderBy("doc_id")) == collected(toxicity.predictions(docs, more).orderBy("doc_id"))


def test_held_out_rows_are_scored_well(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    known = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    got = {r.doc_id: r.predicted for r in toxicity.predictions(docs, labels).where("held_out").collect() if r.doc_id in known}
    toxic = [d for d in got if known[d] == 1]
    assert sum(got[d] for d in toxic) >= 0.75 * len(toxic) > 0 and sum(got[d] for d in got if known[d] == 0) <= 0.01 * len(got)
    langs = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = [r for r in language.predictions(docs).where("held_out").collect() if langs[r.doc_id] and r.lang_pred != "und"]
    assert sum(r.lang_pred == langs[r.doc_id] for r in rows) >= 0.97 * len(rows)


def test_packing_is_nearly_without_padding(spark):
    rows = packing.pack_documents(spark.read.parquet(f"{SF}/documents.parquet")).groupBy("sequence_id").sum("length").collect()
    used = [r["sum(length)"] for r in rows]
    padded = sum(4096 for n in used if n & (n - 1)) + sum(n for n in used if not n & (n - 1))
    assert sum(used) >= 0.99 * padded


def test_conversations_under_three_limits(spark):
    r = np.random.default_rng(2)
    turns = []
    for c in range(120):
        for t in range(int(r.integers(1, 6))):
            turns.append((c if c else None, t, r.choice(["user", "assistant", None]), None if r.random() < 0.05 else "word " * int(r.integers(0, 60))))
    turns += [(500, 0, "user", "word " * 900), (501, 0, "assistant", "word " * 250)] + [(502, k, "user", "a") for k in range(3)] * 2
    frame = spark.createDataFrame([(*t, 1, "x") for t in turns], "conv_id long, turn int, role string, text string, n_tokens int, sequence_id string").repartition(3)
    limits = {"max_tokens": 400, "max_segments": 4, "max_loss": 200}
    rows = packing.pack_conversations(frame, **limits).collect()
    bpe = packing.library_bpe(packing.default_tokenizer())
    want = {}
    for c, _, role, text in turns:
        n = len(bpe.encode(text)) // 4 + 1
        tokens, loss = want.get(c, (0, 0))
        want[c] = tokens + n, loss + n * (role == "assistant")
    assert {x.conv_id: (x.n_tokens, x.n_loss) for x in rows} == want and len(rows) == len(want)
    held = {}
    for x in rows:
        fits = x.n_tokens <= 400 and x.n_loss <= 200
        assert (x.sequence_id is not None) == fits == (x.offset is not None)
        if fits:
            held.setdefault(x.sequence_id, []).append(x)
    for inside in held.values():
        inside.sort(key=lambda x: x.offset)
        assert len(inside) <= 4 and sum(x.n_tokens for x in inside) <= 400 and sum(x.n_loss for x in inside) <= 200
        assert [x.offset for x in inside] == [sum(y.n_tokens for y in inside[:k]) for k in range(len(inside))]
    least = max(sum(t for t, m in want.values() if t <= 400 and m <= 200) / 400, sum(m for t, m in want.values() if t <= 400 and m <= 200) / 200)
    assert len(held) <= 1.5 * least + 3  # a sequence a task may stay open
    assert packing.pack_conversations(frame.limit(0)).count() == 0
