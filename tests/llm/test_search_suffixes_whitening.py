"""Operators 11 to 13 against brute force, over odd rows too."""

import hashlib
import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from wirelark.llm import ranking, suffixes, whitening

from .test_ops import collected, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ODD = "doc_id long, text string, term string, chunk int, item int, raw string, doc long, found int, x int, vec int"


def odd(rows, spark):
    """Rows (id, text) with columns of names that the operators use themselves."""
    return spark.createDataFrame([(*r, "t", 1, 2, "r", 3, 4, 5, 6) for r in rows], ODD)


def words(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_ranks(docs, items, top=20):
    bags = [words(t) for _, t in docs]
    n, length = sum(1 for b in bags if b), sum(map(len, bags))
    df = Counter(w for b in bags for w in set(b))
    out = []
    for item_id, text in items:
        found = []
        for place, ((doc_id, _), bag) in enumerate(zip(docs, bags, strict=True)):
            tf, m = Counter(bag), 75 + 25 * len(bag) * n // length if length else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * tf[w] // (1000 * tf[w] + 12 * m)) for w in words(text) if tf[w])
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, place, doc_id))
        out += [(item_id, k + 1, f[4], -f[0]) for k, f in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


def passages(seed, n, vocabulary=60, longest=40):
    r = random.Random(seed)
    names = [f"w{k}é" if k % 7 == 0 else f"W{k}" for k in range(vocabulary)]
    return [" ".join(r.choices(names, [1 / (k + 1) for k in range(vocabulary)], k=r.randint(1, longest))) for _ in range(n)]


@pytest.mark.parametrize("first, ratio", [(1, 2), (4, 4), (1024, 32)])
def test_ranks_agree_with_brute_force_at_any_tiers(spark, first, ratio):
    docs = [(i if i % 50 else None, t) for i, t in enumerate(passages(1, 400))] + [(7, "w3 w3"), (7, "w3 w3"), (8, None), (9, ""), (10, "--- ...")]
    items = [*enumerate(passages(2, 12, longest=6)), (3, "W1 w1 W1 nowhere"), (20, None), (21, ""), (22, "nowhere"), (23, "W59 W58")]
    frame = odd(docs, spark).repartition(5)
    got = collected(ranking.searched(frame, spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, term int"), first=first, ratio=ratio))
    assert sorted(map(tuple, got), key=str) == brute_ranks(docs, items)


def test_items_with_a_proof_read_few_postings(spark):
    docs = [(i, t) for i, t in enumerate(passages(3, 3000, vocabulary=400))] + [(5000 + i, "rare words of a planted passage w0é W1 W2") for i in range(25)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    index = ranking.build(frame, first=32, ratio=8)
    assert index.tiers == 4
    held = {r.tier: r.n for r in index.postings.selectExpr("tier", "octet_length(docs) div 4 AS n").groupBy("tier").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    of_terms = {r.term: r.frequency for r in index.terms.collect()}
    assert sum(held.values()) == sum(of_terms.values()) and held[0] <= 32 * len(of_terms)
    best = ranking.search(index, spark.createDataFrame([(1, "a planted passage of rare words w0é")], "item_id long, text string"))
    assert sorted(map(tuple, collected(best)), key=str) == brute_ranks(docs, [(1, "a planted passage of rare words w0é")])
    # the first tier alone is the proof
    first = ranking.Index(index.postings.where("tier = 0 OR term NOT IN ('rare', 'words', 'of', 'a', 'planted', 'passage')"), *index[1:])
    again = ranking.search(first, spark.createDataFrame([(1, "a planted passage of rare words w0é")], "item_id long, text string"))
    assert collected(again) == collected(best)


def test_ranks_of_empty_tables_and_long_texts(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    item = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert collected(ranking.searched(none, item)) == [] and collected(ranking.searched(item.withColumnRenamed("item_id", "doc_id"), item.limit(0))) == []
    docs = [(1, "x " * 400_000 + "y"), (2, "y" * 3_000_000), (3, "y z"), (4, "q")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = collected(ranking.searched(frame, spark.createDataFrame([(1, "Y x z")], "item_id long, text string")))
    assert sorted(map(tuple, got), key=str) == brute_ranks(docs, [(1, "Y x z")])


def test_blocks_of_items_give_what_one_block_gives(spark):
    docs, items = list(enumerate(passages(5, 200))), list(enumerate(passages(6, 9, longest=5)))
    frame, asked = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, collected(ranking.search(ranking.build(frame), asked, block=8))), key=str) == brute_ranks(docs, items)


def brute_strings(rows, length=50):
    first = {}
    own = [(i, (t or "").encode(), i if i is not None else math.inf) for i, t in rows]
    for _, b, k in own:
        for p in range(len(b) - length + 1):
            first[b[p : p + length]] = min(k, first.get(b[p : p + length], math.inf))
    out = []
    for i, b, k in own:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < k:
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


def edited(seed):
    r = random.Random(seed)
    base = [prose(k, 60) for k in range(4)]
    rows = []
    for i in range(60):
        text = r.choice(base)
        at = r.randrange(len(text))
        rows.append((i * 3 % 61, r.choice(["", "é", prose(100 + i, 8) + " "]) + text[: at] + r.choice(["", "ü", "##"]) + text[at + r.randrange(3) :]))
    passage = "a passage of just over fifty bytes that many texts have in common"
    rows += [(200 + i, f"{prose(300 + i, r.randint(0, 9))} {passage} {prose(400 + i, r.randint(0, 9))}") for i in range(30)]
    rows += [(500, passage[:50]), (499, passage[:50]), (498, passage[:49]), (None, passage), (None, passage), (501, None), (502, ""), (503, "ab" * 400), (504, "x" + "ab" * 300), (505, "a" * 700), (506, "b" + "a" * 90), (7, prose(1, 60)), (7, prose(1, 60)), (7, passage + "!")]
    return rows


@pytest.mark.parametrize("hot", [10_000, 2])
def test_strings_that_repeat_agree_with_brute_force(spark, hot):
    rows = edited(1)
    got = collected(suffixes.digests(odd(rows, spark).repartition(4), hot=hot))
    assert sorted(map(tuple, got), key=str) == brute_strings(rows)
    assert sum(r[2] for r in got) > 1000


def test_contexts_of_usual_anchors_are_shuffled_once(spark):
    texts = suffixes._texts(spark.createDataFrame(edited(3), "doc_id long, text string")).where("octet_length(raw) >= 50")
    some = suffixes.stored(suffixes.contexts(texts, suffixes.repeated_anchors(texts, 50, 20), 50, 20), "contexts")
    whole, cut = (suffixes.judged_rows(some, 50, cell) for cell in (1 << 20, 1))
    assert whole._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert sorted(cut.collect()) == sorted(whole.collect()) == sorted(suffixes._settled(some, 50, 10).collect()) != []


def test_few_and_many_contexts_an_anchor_agree_with_brute_force(spark):
    rows = edited(4)
    got = collected(suffixes.digests(odd(rows, spark).repartition(3), hot=25, shares=2))
    assert sorted(map(tuple, got), key=str) == brute_strings(rows)


def test_other_lengths_and_one_partition(spark):
    rows = edited(2)[:40]
    got = collected(suffixes.digests(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), length=24, gram=8))
    assert sorted(map(tuple, got), key=str) == brute_strings(rows, 24)


def test_empty_tables_and_one_long_text(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert collected(suffixes.digests(none)) == []
    long_ = prose(9, 200_000)
    rows = [(1, long_), (2, "before " + long_[700_000:700_400] + " after")]
    got = {r[0]: tuple(r) for r in collected(suffixes.digests(spark.createDataFrame(rows, "doc_id long, text string")))}
    assert got[1][2] == 0 and got[2][2] >= 400 and got[2][3] == 1


@pytest.mark.parametrize("letters", [b"ab", b"a", bytes(range(256))])
def test_suffix_ranks_sort_by_prefixes(letters):
    r = random.Random(5)
    for n in [*range(1, 40), 300, 2000]:
        data = bytes(r.choice(letters) for _ in range(n))
        ranks = suffixes.ranks_of_bytes(np.frombuffer(data, np.uint8), 50)
        order = np.argsort(ranks, kind="stable").tolist()
        assert [data[i : i + 50] for i in order] == sorted(data[i : i + 50] for i in range(n))
        assert sorted(data[i:] for i in range(n)) == [data[i:] for i in np.argsort(suffixes.ranks_of_bytes(np.frombuffer(data, np.uint8), n + 1), kind="stable").tolist()]


def exact(vectors):
    """(n, S, V by fractions, grid) of vectors of one length."""
    grid = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    fit = sorted({tuple(g) for g in grid})
    n, d = len(fit), len(fit[0])
    sums = [sum(g[k] for g in fit) for k in range(d)]
    v = [[float(Fraction(sum((n * g[a] - sums[a]) * (n * g[b] - sums[b]) for g in fit), n**3)) for b in range(d)] for a in range(d)]
    return n, sums, np.array(v), grid


def test_whitening_agrees_with_exact_covariances(spark):
    r = np.random.default_rng(3)
    vectors = (r.standard_normal((300, 20)) @ np.diag(np.linspace(0.1, 3, 20)) + 5).tolist()
    vectors += vectors[:100] * 2
    rows = [(i, v, 1, "x") for i, v in enumerate(vectors)] + [(900, None, 1, "x"), (901, [1.0, None], 1, "x"), (902, [math.nan] * 20, 1, "x"), (903, [math.inf] * 20, 1, "x"), (904, [], 1, "x"), (905, [2.5], 1, "x"), (None, vectors[0], 1, "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x int, n string").repartition(7)
    got = whitening.whitened(frame).collect()
    n, sums, v, grid = exact(vectors)
    values, directions = np.linalg.eigh(v)
    values, directions = values[::-1], directions[:, ::-1]
    assert len(got) == 16 * (len(vectors) + 1)
    assert sorted({(r.vec_id is None, r.vec_id or 0) for r in got}) == [(False, i) for i in range(len(vectors))] + [(True, 0)]
    by = {(r.vec_id, r.component): r for r in got}
    sign = {}
    for i, g in enumerate(grid):
        assert by[i, 1].n == n and by[i, 1].deviation == sum((n * c - s) ** 2 for c, s in zip(g, sums, strict=True))
        z = (np.array(g) - np.array(sums) / n) @ directions[:, :16] / np.sqrt(values[:16])
        for k in range(16):
            own = by[i, k + 1].whitened
            sign.setdefault(k, math.copysign(1, own * z[k]))
            assert math.isclose(own, sign[k] * z[k], abs_tol=1e-8)
    assert all(math.isclose(by[0, k + 1].explained, values[k] / np.trace(v), rel_tol=1e-9) for k in range(16))
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_whitening_of_spaces_without_room_and_of_several_lengths(spark):
    flat = [[float(a), 2.0 * a, 7.0] for a in range(5)]
    other = [[0.5, 0.25], [1.5, -3.0], [0.0, 1.0]]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(flat + other + [[4.0] * 4])], "vec_id long, embedding array<float>")
    got = whitening.whitened(frame).collect()
    assert Counter(r.vec_id for r in got) == {**dict.fromkeys(range(5), 1), **dict.fromkeys(range(5, 8), 2)}
    assert {(r.vec_id < 5, r.n) for r in got} == {(True, 5), (False, 3)} and got[0].identity_error < 1e-9
    assert collected(whitening.whitened(frame.where("vec_id = 8"))) == [] and collected(whitening.whitened(frame.limit(0))) == []


def test_merged_moments_are_those_of_the_whole():
    r = np.random.default_rng(8)
    x = r.integers(999_000, 1_001_000, (1000, 5))
    parts = [whitening.moments_of(p) for p in np.split(x, [1, 2, 300, 301, 999])]
    while len(parts) > 1:
        parts = [a.merged(b) for a, b in zip(parts[::2], parts[1::2], strict=False)] + (parts[-1:] if len(parts) % 2 else [])
    assert parts[0].n == 1000 and list(parts[0].sums) == x.sum(axis=0).tolist()
    assert np.allclose(parts[0].scatter / 1000, np.cov(x.T, bias=True), rtol=1e-12)


def test_deviations_beyond_63_bits_are_null(spark):
    frame = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])], "vec_id long, embedding array<double>")
    got = whitening.whitened(frame).collect()
    assert {r.vec_id: r.deviation for r in got if r.vec_id < 3} == {1: None, 2: None} and got[0].identity_error < 1e-4
