"""Labels whose vectors all lie close together, and the recall of filters by the size of a label."""

import numpy as np
import pyarrow as pa
import pytest

from wirelark.llm import capfilters


def dense(n, share, pairs, d=64, seed=0):
    """Unit vectors at a mutual cosine of about ``share``, with planted pairs just over 0.98."""
    r = np.random.default_rng(seed)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    x = unit(np.sqrt(share) * unit(r.standard_normal(d)) + np.sqrt(1 - share) * unit(r.standard_normal((n, d))))
    for _ in range(pairs):
        a, b = r.choice(n, 2, replace=False)
        e = r.standard_normal(d)
        e = unit(e - (e @ x[a]) * x[a])
        c = r.uniform(0.9805, 0.99)
        x[b] = c * x[a] + np.sqrt(1 - c * c) * e
    return x


def frame(spark, x, label=1):
    table = pa.table({"vec_id": np.arange(len(x)), "embedding": pa.array(x.tolist(), pa.list_(pa.float64())), "label": np.full(len(x), label)})
    return spark.createDataFrame(table).repartition(4)


@pytest.mark.parametrize("share", [0.95, 0.85, 0.6, 0.0])
def test_dense_labels_are_not_compared_in_all_pairs(spark, monkeypatch, share):
    x = dense(1500, share, 150)
    due, real = [], capfilters.verified

    def counted(members, cosine, **how):
        due.extend(r["count"] for r in members.groupBy("label").count().collect())
        return real(members, cosine, **how)

    monkeypatch.setattr(capfilters, "verified", counted)
    got = {r.vec_id: r.n_links for r in capfilters.near_duplicates(frame(spark, x)).collect()}
    near = x @ x.T >= 0.98
    want = near.sum(axis=1) - 1
    assert sum(n * (n - 1) // 2 for n in due) < 0.1 * len(x) * (len(x) - 1) / 2
    assert all(got[i] <= want[i] for i in range(len(x))) and sum(got.values()) >= 0.97 * want.sum() > 200


def test_a_label_of_near_pairs_alone_keeps_every_link(spark):
    x = dense(300, 0.995, 0)
    got = {r.vec_id: (r.n_links, r.component_id) for r in capfilters.near_duplicates(frame(spark, x)).collect()}
    want = (x @ x.T >= 0.98).sum(axis=1) - 1
    assert {i: got[i][0] for i in got} == dict(enumerate(want.tolist())) and {c for _, c in got.values()} == {0}


@pytest.mark.parametrize("n", [200, 10_000, 100_000])
@pytest.mark.parametrize("near", [0.98, 0.9, 0.6])
def test_filters_find_near_pairs_at_every_size_of_a_label(n, near):
    r, rows, d = np.random.default_rng(1), 2000, 64
    x = r.standard_normal((rows, d))
    x /= np.linalg.norm(x, axis=1)[:, None]
    e = r.standard_normal((rows, d))
    e -= (e * x).sum(axis=1)[:, None] * x
    e /= np.linalg.norm(e, axis=1)[:, None]
    code = capfilters.ProductCode(d, n, near=near)
    mine, other = (set(zip(*map(np.ndarray.tolist, code.decode(v)), strict=True)) for v in (x, near * x + np.sqrt(1 - near**2) * e))
    assert len({i for i, _ in mine & other}) >= 0.985 * rows and len(mine) < 300 * rows
