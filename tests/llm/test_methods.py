"""Each method against a brute-force version, with counts that show that the method itself made the results."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wirelark.llm import capfilters, common, language, licenses, packing, quality, secrets, simhash, tokenfiles, toxicity

from .test_ops import SCHEMA, TEXTS, brute_components, brute_print, collected, prose

ODD = "doc_id long, text string, lang string, source string, n_chars long, _rows int, _in_text string, _pred string, node long, times int"


def test_gray_index_finds_the_pairs_and_prunes_the_rest(spark):
    r = np.random.default_rng(4)
    codes = set(r.integers(0, 1 << 63, 6000, dtype=np.uint64).tolist())
    for x in list(codes)[:300]:
        for bit in r.integers(0, 64, int(r.integers(1, 4))).tolist():
            x ^= 1 << bit
        codes.add(x)
    codes = np.array(sorted(codes), np.uint64)
    near = [(a, b) for a in range(len(codes)) for b in (a + 1 + np.flatnonzero(np.bitwise_count(codes[a] ^ codes[a + 1 :]) <= 3)).tolist()]
    assert len(near) >= 290
    index = simhash.GrayIndex(codes)
    place = np.arange(len(codes))
    index.within(index.codes, 3, place)
    assert index.found == len(near) and index.visited < 0.25 * len(codes) ** 2 / 2
    # in ranges of each rotation, no pair of which is compared but by the index
    assert simhash.layout(len(codes), 3, None, 512)[1] == 4
    frame = spark.createDataFrame([(int(x),) for x in codes.view(np.int64)], "fp long")
    at = {int(x): i for i, x in enumerate(codes.view(np.int64))}
    pairs = [(at[a], at[b]) for a, b in collected(simhash.links(frame, cell=512))]
    assert brute_components(range(len(codes)), pairs) == brute_components(range(len(codes)), near)


def test_more_blocks_where_the_top_bits_run_out():
    assert simhash.layout(1 << 20, 3, None, 4096) == (4, 8) and simhash.layout(1 << 34, 3, None, 4096)[0] == 5
    turn = simhash.Rotations(5, 3)
    x = np.array([0x0123456789ABCDEF, 0xFEDCBA9876543210], np.uint64)
    for n in range(len(turn.moves)):
        y = turn.turned(x, n)
        assert np.bitwise_count(y[0] ^ y[1]) == np.bitwise_count(x[0] ^ x[1]) and y[0].bit_count() == x[0].bit_count()


def test_deduplicated_takes_any_names_and_breaks_ties(spark):
    rows = [(1, prose(1, 5), "en", "a", 1, 7, "z", "p", 5, 2), (1, prose(1, 5), "de", "a", 1, 7, "z", "p", 5, 2), (2, prose(1, 5), "en", "a", 1, 7, "z", "p", 5, 2), (None, "x", None, None, None, None, None, None, None, None)]
    frame = spark.createDataFrame(rows, ODD)
    got = simhash.deduplicated(frame).orderBy("doc_id").collect()
    assert got[0].doc_id is None and [(r.doc_id, r.lang) for r in got[1:]] == [(1, "de")] and simhash.deduplicated(frame).columns == frame.columns


def brute_mixture(logs, penalty=4.0):
    """Textbook expectation-maximisation for one document, to rest, dropping the smallest share."""
    langs, n = logs.shape[1], len(logs)
    share, best = [1 / langs] * langs, (-math.inf, None)
    for left in range(langs, 0, -1):
        if left > 1:
            for _ in range(5000):
                new = [0.0] * langs
                for row in logs:
                    top = max(row)
                    p = [s * math.exp(x - top) for s, x in zip(share, row)]
                    for k in range(langs):
                        new[k] += p[k] / sum(p) / n
                moved, share = max(abs(a - b) for a, b in zip(new, share)), new
                if moved < 1e-9:
                    break
        like = sum(math.log(sum(s * math.exp(x) for s, x in zip(share, row))) for row in logs)
        value = like - penalty * left * math.log(n + 1)
        if value >= best[0]:
            best = value, list(share)
        if left > 1:
            low = min((k for k in range(langs) if share[k] > 0), key=lambda k: share[k])
            share[low] = 0.0
            share = [s / sum(share) for s in share]
    return best[1]


def test_mixtures_come_to_rest_where_textbook_em_does():
    r = np.random.default_rng(0)
    logs, sizes = [], []
    for kind in range(12):
        n = int(r.integers(5, 60))
        x = r.normal(-12, 1, (n, 3))
        for k in range(kind % 3 + 1):  # words of one, two or three languages
            x[k :: kind % 3 + 1, (k + kind) % 3] += 9
        logs.append(x)
        sizes.append(n)
    got = language.mixtures(np.concatenate(logs), np.array(sizes))
    for x, share in zip(logs, got):
        want = brute_mixture(x)
        assert np.abs(share - want).max() < 0.01 and [s > 0 for s in share] == [s > 0 for s in want]


def test_language_takes_any_names_and_many_labels(spark):
    rows = [(i, "ka ko ki ku ke " * 5, f"l{i}", "a", 1, 7, "z", "mine", 5, 2) for i in range(60)] + [(100, None, "l1", None, None, 1, None, "mine", None, None)]
    frame = spark.createDataFrame(rows, ODD)
    got = language.identified(frame, least=0.0).collect()
    assert len(got) == 60 and {g["_pred"] for g in got} == {"mine"}
    assert len(language.learn(frame, most=7).languages) <= 7


def brute_pack(examples, limits):
    """Whole examples by the dot-product heuristic, one sequence open, as said in the module."""
    left, out, sequence = list(examples), [], 0
    while left:
        room, offset, taken = list(limits), 0, False
        while True:
            fits = [x for x in left if all(a <= b for a, b in zip((x[1], 1, x[2]), room))]
            if not fits:
                break
            value = lambda x: sum(a / m * (b / m) for a, b, m in zip((x[1], 1, x[2]), room, limits))  # noqa: E731, B023
            best = max(fits, key=lambda x: (value(x), -examples.index(x)))
            out.append((best[0], sequence, offset))
            room, offset, taken = [room[0] - best[1], room[1] - 1, room[2] - best[2]], offset + best[1], True
            left.remove(best)
        assert taken
        sequence += 1
    return out


def test_packer_places_as_the_heuristic_says():
    r = np.random.default_rng(8)
    examples = [(f"k{i}", int(t), int(r.integers(0, t + 1))) for i, t in enumerate(r.integers(1, 64, 150))]
    packer = packing.VectorPacker(128, 5, 80, cut=False)
    for k, t, m in examples:
        packer.add(k, t, min(m, 80))
    got = [(k, q, o) for k, _, _, q, o in packer.pack(True)]
    assert got == brute_pack([(k, t, min(m, 80)) for k, t, m in examples], (128, 5, 80))
    assert len({q for _, q, _ in got}) > 1 and {len([1 for g in got if g[1] == q]) for _, q, _ in got} & {5}


def test_full_lengths_go_through_the_packer(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "word " * 900), (2, None), (3, "few words")], "doc_id long, text string").coalesce(1)
    rows = packing.pack_documents(docs, tokens=64).collect()
    sums = Counter()
    for r in rows:
        sums[r.sequence_id] += r.length
    assert all(n == 64 or n & (n - 1) == 0 for n in sums.values()) and sum(sums.values()) == sum({r.doc_id: r.doc_tokens for r in rows}.values())


def brute_spans(text, ratios, threshold=0.5):
    """Base spans and runs by hand: each run's characters not under a base span, piece by piece."""
    pats = [(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 12), ("AKIA[A-Z0-9]+", 0, 0, 18), ("[0-9a-f]+", 0, 0, 16)]
    base = [(m.start(), k, m.end()) for k, (p, f, g, least) in enumerate(pats) for m in re.finditer(p, text, f) if len(m[g]) >= least]
    free = list(text)
    for s, _, e in base:
        free[s:e] = "\0" * (e - s)
    out, n = list(base), len(secrets.ALPHABET)
    for m in re.finditer(rf"[{re.escape(secrets.ALPHABET)}]{{{secrets.SHORTEST},}}", "".join(free)):
        at, total = secrets.START, 0.0
        for c in m[0]:
            total += ratios[at * n + secrets.ALPHABET.index(c)]
            at = secrets.ALPHABET.index(c)
        if total > max(threshold * len(m[0]), secrets.EVIDENCE):
            out.append((m.start(), 3, m.end()))
    return sorted(out)


@pytest.fixture(scope="module")
def ratios(spark):
    return secrets.train(secrets.labelled_samples(spark))


def test_secret_spans_as_by_hand(spark, ratios):
    r = np.random.default_rng(6)
    letters = np.array(list(secrets.ALPHABET))
    key = lambda n: "".join(r.choice(letters, n))
    hexes = lambda n: "".join(r.choice(list("0123456789abcdef"), n))
    word = lambda: str(r.choice(secrets.IDENTIFIER_WORDS))
    parts = [
        lambda: key(int(r.integers(8, 60))), lambda: hexes(int(r.integers(10, 40))), word, lambda: f"{word()}_{word()}_{word()}", lambda: f"token={key(int(r.integers(3, 30)))}",
        lambda: f"{key(24)}_secret={key(2)}", lambda: hexes(18) + key(20), lambda: f"AKIA{''.join(r.choice(list('ABCXYZ0189'), 16))}/{key(30)}", lambda: f"api_key: '{key(15)}'",
        lambda: "2024-01-02-03-04", lambda: "-" * 30, lambda: "é中🤖", lambda: "Donaudampfschifffahrtsgesellschaft", lambda: f"password = {hexes(20)}.{key(9)}",
    ]
    texts = [" ".join(parts[int(i)]() for i in r.integers(0, len(parts), 40)) for _ in range(150)] + ["9fK3mZq8Lw2Vb7Xt1Rc5Yp0D_secret=ab", "deadbeefdeadbeef01Zq8Lw2Vb7Xt1Rc5Yp0Dk9fK3m", "", None, "﷐ " + "Zq7K" * 9]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, _markov string, _in_text int")
    got = {x.doc_id: [(s.s, s.k, s.e) for s in x.spans] for x in secrets.find(frame, ratios).collect()}
    want = {i: brute_spans(t or "", ratios) for i, t in enumerate(texts)}
    assert got == want
    own = sum(k == 3 for spans in want.values() for _, k, _ in spans)
    assert own > 800 and want[150] == [(0, 3, 34)] and {k for _, k, _ in want[151]} == {2, 3}
    clean = {x.doc_id: x for x in secrets.redacted(frame, ratios).collect()}
    for i, t in enumerate(texts):
        left = clean[i].text
        assert (left == t) == (not want[i]) and clean[i]["_in_text"] == 1
        if want[i]:
            covered = "".join("\0" if any(s <= j < e for s, _, e in want[i]) else c for j, c in enumerate(t.replace("﷐", "�")))
            assert [x for x in left.split("[secret]") if x] == [x for x in covered.split("\0") if x]


def test_markov_models_tell_held_out_strings_apart(spark):
    samples = secrets.labelled_samples(spark, 4000)
    even = F.pmod(F.xxhash64("text"), F.lit(2)) == 0
    judge = secrets._judge(secrets.train(samples.where(even)), 0.5)
    held = samples.where(~even & (F.length("text") >= 20)).select("label", judge(F.col("text")).cast("int").alias("said"))
    found = {(r.label, r.said): r["count"] for r in held.groupBy("label", "said").count().collect()}
    assert found[1, 1] >= 0.98 * (found[1, 1] + found.get((1, 0), 0)) and found.get((0, 1), 0) <= 0.002 * found[0, 0]


def test_long_texts_take_work_in_proportion(spark, ratios):
    text = " ".join(f"{i} {'0123456789abcdef' if i % 2 else 'Zq8Lw2Vb7Xt1Rc5Yp0Dk9fK3'} word" for i in range(20000))
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = secrets.find(frame, ratios).first().spans
    assert len(spans) == 20000 and [text[x.s : x.e] for x in spans[:2]] == ["Zq8Lw2Vb7Xt1Rc5Yp0Dk9fK3", "0123456789abcdef"]
    assert secrets.redacted(frame, ratios).first().text.count("[secret]") == 20000


def test_factorization_machine_sums_all_pairs(spark):
    r = np.random.default_rng(2)
    index = np.arange(10, 40, dtype=np.uint32)
    m = toxicity.FactorizationMachine(-0.3, index, r.normal(0, 1, 30), r.normal(0, 0.5, (30, 4)))
    rows = [np.unique(r.integers(0, 60, n)).astype(np.uint32) for n in (0, 1, 5, 40)]
    for row, got in zip(rows, m.raw(rows)):
        at = [int(x) - 10 for x in row if 10 <= x < 40]
        want = m.w0 + sum(m.w[i] for i in at) + sum(float(m.v[i] @ m.v[j]) for n, i in enumerate(at) for j in at[n + 1 :])
        assert abs(got - want) < 1e-9


def test_toxicity_learns_from_all_terms_and_scores_as_by_hand(spark):
    r = np.random.default_rng(7)
    words = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 4 == 0
        rows.append((i, " ".join([*r.choice(words, 25), *(["blockhead", "plumbers"] if toxic else [["blockhead"], ["plumbers"], []][i % 3])])))
        labels.append((i, int(toxic)))
    frame, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    sets = [toxicity.terms(t, common.RecentCache(toxicity.hashed, 1000)) for i, t in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    y = np.array([y for i, y in labels if zlib.crc32(str(i).encode()) % 3 != 1], float)
    index, tell, slot = toxicity.tells(sets, y)
    assert len(index) == len({int(x) for s in sets for x in s}) and len(slot) == sum(map(len, sets))
    for k in (0, len(index) // 2, int(tell.argmax())):  # G^2 by definition
        has = np.array([index[k] in s for s in sets])
        cells = [(int((has == a)[y == b].sum()), (has == a).sum() * (y == b).sum() / len(y)) for a in (True, False) for b in (0, 1)]
        assert abs(tell[k] - 2 * sum(n * math.log(n / e) for n, e in cells if n)) < 1e-6
    machine = toxicity.learn(frame, marks)
    pair = toxicity.FactorizationMachine(0.0, machine.index, np.zeros(len(machine.index)), machine.v)
    both = np.unique(np.concatenate([toxicity.terms(w, common.RecentCache(toxicity.hashed, 9)) for w in ("blockhead", "plumbers")]))
    assert pair.raw([both])[0] > 0.5  # the pair itself tells
    got = {x.doc_id: x for x in toxicity.predictions(frame, marks).collect()}
    for i, t in rows:
        want = machine.scores([toxicity.terms(t, common.RecentCache(toxicity.hashed, 1000))])[0]
        assert abs(got[i].score - want) < 1e-9 and got[i].predicted == int(want >= 0.7)
    assert np.mean([got[i].predicted == y for i, y in labels if got[i].held_out]) > 0.97


def brute_licenses(text, templates, least=0.8):
    """Share of each license's best template in any stretch of the text of the template's window size."""
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    grams = [" ".join(words[i : i + 5]) for i in range(len(words) - 4)]
    out = {}
    for name, own in templates.items():
        for t in own:
            tw = [w for w in re.split(r"[\W_]+", t.lower()) if w]
            want = {" ".join(tw[i : i + 5]) for i in range(len(tw) - 4)}
            n = len(tw) - 4
            size = licenses.window_of(n)
            small = size == 1
            size = 2 * licenses.SMALL + 1 if small else size
            best = max((len(want & set(grams[i : i + size])) / len(want) for i in range(max(1, len(grams) - size + 1))), default=0.0)
            if best >= (1.0 if small else least):
                out[name] = max(best, out.get(name, 0.0))
    return out


def test_licenses_as_over_all_windows(spark):
    r = np.random.default_rng(1)
    templates = licenses.common_templates()
    bodies = [(k, t.split()) for k, ts in templates.items() for t in ts]
    filler = lambda n: " ".join(r.choice(["river", "stone", "table", "license", "software", "copyright", "without", "the", "of"], n))
    texts = []
    for i in range(240):
        name, own = bodies[int(r.integers(len(bodies)))] if i % 2 else [b for b in bodies if len(b[1]) > 30][i % 20 % len([b for b in bodies if len(b[1]) > 30])]
        own = list(own)
        for _ in range(int(r.integers(0, 1 + len(own) // 35))):
            own[int(r.integers(len(own)))] = "edited"
        texts.append(f"{filler(int(r.integers(0, 300)))} {' '.join(own)} {filler(int(r.integers(0, 300)))}")
    texts += [filler(500) for _ in range(20)]
    got = {x.doc_id: {y.name: y.share for y in x.licenses} for x in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    due = found = 0
    for i, t in enumerate(texts):
        want = brute_licenses(t, templates)
        assert set(got[i]) <= set(want) and all(got[i][k] <= want[k] + 1e-9 for k in got[i])
        due, found = due + len(want), found + len(got[i])
    assert due > 200 and found >= 0.99 * due and not any(got[i] for i in range(240, 260))
    count = licenses.bands_needed()
    for n in range(licenses.SMALL + 1, 2000):  # the collision probability that the settings promise, for each size of template
        w = licenses.window_of(n)
        assert n + w / licenses.STEPS <= w and 1 - (1 - 0.8 / (1 + w / n - 0.8)) ** count >= 0.99 or w == licenses.SMALLEST


@pytest.mark.parametrize("scale", [1.0, 1e200, 1e-200, 5e-324])
def test_finite_vectors_of_any_scale_link(spark, scale):
    base = np.round(np.random.default_rng(3).standard_normal(16) * 50)
    rows = [(0, (base * scale).tolist(), 1), (1, ((base + np.eye(16)[0]) * scale).tolist(), 1), (2, (-base * scale).tolist(), 1), (3, base.tolist(), 1)]
    got = {x.vec_id: (x.n_links, x.component_id) for x in capfilters.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {0: (2, 0), 1: (2, 0), 2: (0, 2), 3: (2, 0)}


def test_hot_cells_are_cut(spark):
    rows = spark.range(3000).select(F.lit(5).cast("long").alias("key"), F.col("id").alias("node"))
    sizes = [x["count"] for x in common.grid(rows, "key", "node", 192).groupBy("cell_i", "cell_j").count().collect()]
    assert max(sizes) < 3 * 192 and len(sizes) == 16 * 17 // 2
    sizes = [x["count"] for x in common.grid(rows, "key", "node", 2048, (12, 100)).groupBy("cell_i", "cell_j").count().collect()]
    assert max(sizes) < 700 and len(sizes) == 12 * 13 // 2


def test_token_files_are_cut_by_size_and_in_order(spark):
    docs = spark.createDataFrame([(i, "word " * (i % 50)) for i in range(1000)] + [(777, f"copy {i}") for i in range(1000)], "doc_id long, text string").repartition(7)
    files = tokenfiles.write(docs, f"{common.work_dir(spark)}/tokens-test", file_bytes=20_000, least_bytes=1000)
    assert sum(f["docs"] for f in files) == 2000 and len(files) > 5
    seen = []
    for f in files:
        reader = tokenfiles.TokenReader(f["uri"])
        seen.append(reader.doc_ids.tolist())
        reader.close()
    assert all(a[-1] <= b[0] for a, b in zip(seen, seen[1:])) and all(s == sorted(s) for s in seen)
    assert sum(777 in s for s in seen) > 1  # an id of very many rows fills several files
    assert max(map(len, seen)) < 1200


# ---------------------------------------------------------------- the pipeline


def brute_quality(rows, min_docs=20, share=0.1, long_words=8):
    """(kept text by place of row) of (doc, source, text): the rules written out."""
    norm = lambda x: re.sub(r"[ \t\x0b\f\r]+", " ", x.lower()).strip(" ")
    split = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
    hosts, holds = {}, {}
    for _, host, text in rows:
        hosts.setdefault(host or "", set()).add(text or "")
        for x in (text or "").split("\n"):
            if norm(x):
                holds.setdefault((host or "", norm(x)), set()).add(text or "")
    over = {k for k, texts in holds.items() if len(texts) > (min_docs if len(k[1].split(" ")) >= long_words else max(min_docs, share * len(hosts[k[0]])))}
    kept = {}
    for i, (_, host, text) in enumerate(rows):
        t, words = text or "", split(text or "")
        windows = [tuple(words[j : j + 5]) for j in range(len(words) - 4)]
        twice = Counter(windows)
        repeated = {j + k for j, w in enumerate(windows) if twice[w] > 1 for k in range(5)}
        if len(words) < 10 or 100 * len(repeated) > 20 * len(words):
            continue
        lines = t.split("\n")
        left = [x for x in lines if (host or "", norm(x)) not in over]
        gone = sum(len(norm(x).split(" ")) for x in lines if (host or "", norm(x)) in over)
        if gone and (len(words) - gone < 10 or len(words) - gone < 0.2 * len(words)):
            continue
        kept[i] = "\n".join(left) if gone else t
    return kept


def test_pipeline_stages_as_by_hand(spark, ratios):
    import corpus_pipeline as p

    shared = "this passage of more than eight words stands in far too many pages"
    rows = [(i, f"{prose(900 + i, 4)}" + (f"\n{shared}" if i < 30 else ""), "en", "h") for i in range(60)]
    rows += [(100 + i, t, "en", "s") for i, t in enumerate(TEXTS)] + [(200 + i, prose(950, 40), "en", "g") for i in range(5)] + [(200, prose(950, 40), "en", "g")]
    rows += [(300, f"{prose(970, 5)} key Zq8Lw2Vb7Xt1Rc5Yp0Dk9fK3 and password = 'abcdefghijklm'", "en", None), (301, prose(971, 3000), "en", "g"), (302, f"{shared}\n{shared} too", "en", "h")]
    frame = spark.createDataFrame([(i, t, k, s, len(t or ""), 7, "z", "mine", 5, 2) for i, t, k, s in rows], ODD)
    now, made = frame, {}
    for name, stage in p.STAGES:
        before, now = now, common.stored(stage(spark, now, None), f"test-{name}")
        made[name] = (before.collect(), now.collect(), now.columns)
        assert name == "packing" or now.columns == frame.columns
    same = lambda rows: Counter(tuple(r) for r in rows)
    before, after, _ = made["language"]
    want = [r for r in before if r.text and re.search(r"[^\W\d_]", r.text)]
    assert same(after) == same(want)
    before, after, _ = made["quality"]
    kept = brute_quality([(r.doc_id, r.source, r.text) for r in before])
    assert Counter((before[i].doc_id, t) for i, t in kept.items()) == Counter((r.doc_id, r.text) for r in after)
    assert any(r.doc_id < 30 and shared not in r.text for r in after) and not any(r.doc_id == 302 for r in after)
    before, after, _ = made["near_duplicates"]
    prints = {r.doc_id: brute_print(r.text) for r in before}
    near = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    assert sorted(r.doc_id for r in after) == sorted(set(brute_components(prints, near).values()))
    before, after, _ = made["secrets"]
    old, new = {r.doc_id: r.text for r in before}, {r.doc_id: r for r in after}
    assert set(old) == set(new)
    for i, t in old.items():
        assert (new[i].text == t) == (not brute_spans(t, ratios)) and (new[i].n_chars == len(new[i].text) or new[i].text == t)
    assert "Zq8Lw" not in new[300].text and "abcdefghijklm" not in new[300].text
    before, after, columns = made["packing"]
    assert {r.doc_id for r in after} == {r.doc_id for r in before} and columns[0] == "doc_id"


def test_pipeline_stages_take_nulls_and_no_rows(spark):
    import corpus_pipeline as p

    none = spark.createDataFrame([], SCHEMA)
    nulls = spark.createDataFrame([(None,) * 8, (1, *(None,) * 7), (1, *(None,) * 7)], SCHEMA)
    for name, stage in p.STAGES:
        assert stage(spark, none, None).count() == 0
        left = stage(spark, nulls, None)
        assert left.count() == {"language": 0, "quality": 0, "near_duplicates": 2, "secrets": 3, "packing": 3}[name]


def test_quality_default_limit_on_a_large_host(spark):
    rows = [(i, "s", f"{prose(6000 + i, 2)}" + ("\nread more" if i < 101 else "") + ("\nfollow us" if i < 99 else "")) for i in range(1000)]
    got = {r.doc_id: r.n_removed_words for r in quality.judge(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    assert all(got[i] == (2 if i < 101 else 0) for i in range(1000))  # over a tenth of the host's documents, or not


def test_shared_folder(spark, tmp_path):
    from wirelark import shared

    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})  # noqa: N815

    with pytest.raises(ValueError):
        shared.work_dir(Session())
    with shared.scratch(spark):
        _, path = shared.stored_at(spark.range(3), "gone")
        kept, at = shared.settled(spark, "kept", lambda: shared.stored(spark.range(5), "inner"))
        assert kept.count() == 5
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
