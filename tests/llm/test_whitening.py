"""Embedding whitening against a plain numpy fit of all rows."""

import math

import numpy as np
from conftest import SF

from vesselrisk.llm import whitening
from vesselrisk.llm.queries import QUERIES


def plain(vectors, components=8):
    """{position: (deviation, projections up to sign)}, n, explained for vectors without odd entries."""
    x = [[math.floor(1024 * float(c)) + 100000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(v[j] for v in x) for j in range(d)]
    dev = [sum((n * v[j] - s[j]) ** 2 for j in range(d)) for v in x]
    m = np.array(x, float)
    c = m - m.mean(axis=0)
    cov = c.T @ c / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    k = min(components, d)
    return dev, c @ u[:, :k] / np.sqrt(e[:k]), e[:k] / np.trace(cov), n


def test_query_against_plain_fit(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    dev, w, explained, n = plain([r.embedding for r in rows])
    place = {r.vec_id: i for i, r in enumerate(rows)}
    got = QUERIES["op11_embedding_whitening"](spark, SF).collect()
    assert len(got) == 8 * len(rows)
    sign = {}
    for r in got:
        i, j = place[r.vec_id], r.component - 1
        assert r.n == n and r.deviation == dev[i]
        assert abs(r.explained / explained[j] - 1) < 1e-9
        assert r.identity_error < 1e-9
        if abs(w[i, j]) > 1e-3:
            s = np.sign(r.whitened * w[i, j])
            assert sign.setdefault(j, s) == s
        assert abs(abs(r.whitened) - abs(w[i, j])) < 1e-7
    assert len(sign) == 8


def test_odd_vectors(spark):
    """Null, empty, short, non-finite vectors go; repeated ones and null ids stay; huge entries are exact; clashing names are replaced."""
    rng = np.random.default_rng(3)
    some = rng.normal(size=(30, 3)).round(3).tolist()
    rows = [(i, v, 7.0) for i, v in enumerate(some)] + [(100, some[0], 1.0)] * 40 + [(None, some[1], 1.0)]
    rows += [(1, None, 0.0), (2, [], 0.0), (3, [1.0, 2.0], 0.0), (4, [1.0, None, 2.0], 0.0), (5, [1.0, float("nan"), 0.0], 0.0), (6, [float("inf"), 0.0, 0.0], 0.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, whitened double")
    got = whitening.whiten(df).collect()
    keep = [r for r in rows if r[1] is not None and len(r[1]) == 3 and all(c is not None and math.isfinite(c) for c in r[1])]
    dev, w, explained, n = plain([r[1] for r in keep])
    assert len(got) == 3 * len(keep) == 3 * n
    assert sorted(int(r.deviation) for r in got if r.component == 1) == sorted(dev)
    ours = sorted(abs(r.whitened) for r in got if r.component == 2)
    assert np.allclose(ours, sorted(np.abs(w[:, 1])), atol=1e-8)
    one = whitening.whiten(df, weight="one").collect()
    assert {r.n for r in one} == {30}
    assert len(one) == len(got)


def test_extreme_and_flat_vectors(spark):
    big = [[1e30, 0.0], [-1e30, 1.0], [0.5, 2.0]]
    got = whitening.whiten(spark.createDataFrame([(i, v) for i, v in enumerate(big)], "vec_id long, embedding array<double>")).collect()
    e = 1 << 52
    x = [[e + 100000, 100000], [-e + 100000, 101024], [100512, 102048]]
    s = [sum(v[j] for v in x) for j in range(2)]
    want = {i: sum((3 * v[j] - s[j]) ** 2 for j in range(2)) for i, v in enumerate(x)}
    assert {r.vec_id: int(r.deviation) for r in got} == want
    flat = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")).collect()
    assert len(flat) == 4 and all(r.whitened is None and r.deviation == 0 for r in flat)
    none = whitening.whiten(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert none.count() == 0 and none.columns[0] == "vec_id"


def test_hot_vector_is_joined_by_broadcast(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=4).tolist() if i % 3 else [1.0, 2.0, 3.0, 4.0]) for i in range(3000)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert got.count() == 4 * 3000
    assert got.where("component = 1 and vec_id % 3 = 0").select("whitened").distinct().count() == 1
