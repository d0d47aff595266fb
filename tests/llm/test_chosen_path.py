"""Chosen-path similarity join against all pairs of plain sets."""

import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF

from vesselrisk.llm import chosen_path
from vesselrisk.llm.queries import QUERIES


def plain_set(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode()
    words = low.split()
    k = min(4, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def plain(docs):
    """[(doc_id, n_shingles, component_id, kept)], sorted; equal texts are looked at once."""
    kinds = {}
    for d, t in docs:
        kinds.setdefault(frozenset(plain_set(t)), []).append(d)
    sets = [s for s in kinds if s]
    top = list(range(len(sets)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        near = {}
        for x in s:
            for j in where.setdefault(x, []):
                near[j] = near.get(j, 0) + 1
            where[x].append(i)
        for j, both in near.items():
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                top[find(i)] = find(j)
    least = {}
    for i, s in enumerate(sets):
        least.setdefault(find(i), []).extend(kinds[s])
    out = []
    for i, s in enumerate(sets):
        own = [d for d in least[find(i)] if d is not None]
        c = min(own) if own else None
        out += [(d, len(s), c, d is not None and d == c) for d in kinds[s]]
    out += [(d, 0, d, d is not None) for d in kinds.get(frozenset(), [])]
    return sorted(out, key=str)


def check(spark, rows, **how):
    got = chosen_path.near_dups(spark.createDataFrame(rows, "doc_id long, text string"), **how)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows)


def test_query_against_plain(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op13_minhash"](spark, SF)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(docs)


def test_odd_rows(spark, odd, none):
    got = sorted((tuple(r) for r in chosen_path.near_dups(odd).collect()), key=str)
    assert got == plain([(r.doc_id, r.text) for r in odd.collect()])
    assert chosen_path.near_dups(none).count() == 0


def near_copies(rng, n, size, most, vocabulary=3000):
    base = [f"w{rng.randrange(vocabulary)}" for _ in range(size)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(most + 1)):
            w[rng.randrange(size)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_groups_near_the_threshold(spark):
    """Groups whose members are about as far apart as the threshold, chains, short texts and shared passages."""
    rng = random.Random(11)
    texts = []
    for i in range(25):
        texts += near_copies(rng, 4 + i % 9, 120, 4)
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + t for t in near_copies(rng, 40, 60, 60)]
    chain = [f"c{i}" for i in range(400)]
    texts += [" ".join(chain[i : i + 100]) for i in range(0, 200, 7)]
    texts += ["a b", "a b", "a b c", "a b c d", "a b c d e", "A B c D", ""]
    check(spark, list(enumerate(texts)))


@pytest.mark.parametrize("small", [40])
def test_large_nodes_branch(spark, monkeypatch, small):
    """A dense group over many levels: no link may be lost when nodes are larger than the exhaustive size."""
    monkeypatch.setattr(chosen_path, "SMALL", small)
    rng = random.Random(12)
    texts = near_copies(rng, 120, 150, 8) + near_copies(rng, 60, 90, 3) + [" ".join(f"n{rng.randrange(10**6)}" for _ in range(50)) for _ in range(80)]
    check(spark, list(enumerate(texts)))


def test_dense_group_costs_links_not_pairs(spark):
    """Some hundred near copies: checked pairs stay near the number of records."""
    rng = random.Random(13)
    rows = list(enumerate(near_copies(rng, 300, 200, 6)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    base = chosen_path.with_sets(docs, ["doc_id"]).withColumnRenamed("doc_id", "rec")
    join = chosen_path.Join(base.selectExpr("rec", "n_shingles AS size", "sig", "low").cache(), docs.withColumnRenamed("doc_id", "rec"), 4, 80)
    join.run()
    assert join.checked.count() <= 300 * 299 / 4
    assert join.roots.select("root").distinct().count() == 1


def test_forest_spans_by_agreement():
    node = np.zeros(4, np.int64)
    rec = root = np.arange(4)
    a, b, n = np.array([0, 0, 1, 2]), np.array([1, 2, 2, 3]), np.array([90, 100, 95, 85])
    on = chosen_path.forest(rec, node, root, a, b, n)
    assert sorted(zip(a[on].tolist(), b[on].tolist())) == [(0, 2), (1, 2), (2, 3)]


def test_levels_walked_or_joined_give_the_same_nodes(spark):
    """The records of a level follow from their minwise values and the large nodes above, known or as a table."""
    docs = spark.createDataFrame(list(enumerate(near_copies(random.Random(14), 60, 80, 30))), "doc_id long, text string")
    base = chosen_path.with_sets(docs, ["doc_id"]).withColumnRenamed("doc_id", "rec")
    join = chosen_path.Join(base.selectExpr("rec", "n_shingles AS size", "sig", "low"), docs.withColumnRenamed("doc_id", "rec"), 4, 80)
    first = join.nodes_at([]).groupBy("node").count().where("count > 5").select("node").cache()
    ids = np.sort(np.array([r.node for r in first.collect()], np.int64).view(np.uint64))
    rows = [sorted(map(tuple, join.nodes_at([(first, known)]).select("node", "rec").collect())) for known in (ids, None)]
    assert len(ids) and rows[0] == rows[1] and rows[0]


def test_two_bits_agree_where_values_do():
    rng = np.random.default_rng(15)
    least = rng.integers(0, 1 << 32, (40, chosen_path.N_MINHASH), dtype=np.uint32)
    low = np.frombuffer(b"".join(chosen_path.two_bits(x) for x in least), np.uint64).reshape(40, -1)
    want = ((least[:-1] & 3) == (least[1:] & 3)).sum(axis=1)
    assert chosen_path.n_agree(low[:-1], low[1:]).tolist() == want.tolist()


def test_pairs_that_the_check_takes_are_not_left_over():
    """Two records that agree make one pair of the forest, and none of them comes again in the end; of three, the other pair does."""
    low = chosen_path.two_bits(np.arange(chosen_path.N_MINHASH))
    names = ["node", "rec", "root", "size", "low"]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in ([1, 1, 2, 2, 2], [1, 2, 3, 4, 5], [1, 2, 3, 4, 5], [9] * 5, [low] * 5)], names=names)
    found = [r for b in chosen_path._candidates(80)([batch]) for r in b.to_pylist()]
    assert sum(r["v"] is not None for r in found) == 3
    assert {r["node"] for r in found if r["v"] is None} == {2}
