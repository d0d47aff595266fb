"""Sizes of unions of overlapping groups against plain sets."""

import random
import time

import pytest

from vesselrisk.operators import graph as G


def plain(rows, weights):
    groups, of = {}, {}
    for v, g in rows:
        groups.setdefault(g, set()).add(v)
        of.setdefault(v, set()).add(g)
    out = {}
    for v, gs in of.items():
        union = set().union(*(groups[g] for g in gs))
        out[v] = (len(union), sum(weights.get(x, 0) for x in union), weights.get(v, 0))
    return out


@pytest.mark.parametrize("narrow", [8, 2, 1])
def test_union_sizes_equal_plain_sets(spark, narrow):
    rng = random.Random(8)
    rows = [(f"v{i}", f"g{rng.randrange(12)}") for i in range(120) for _ in range(rng.choice([1, 1, 2, 3, 6]))]
    rows += [(f"w{i}", f"g{g}") for i in range(3) for g in range(12) if g != i] + [("hub", "g0"), ("alone", "own")] + rows[:9]
    weights = {f"v{i}": i % 3 == 0 for i in range(120)}
    got = G.union_sizes(
        spark.createDataFrame(rows, "v string, g string"),
        spark.createDataFrame([(v, int(w)) for v, w in weights.items() if w] * 2, "v string, w int"), narrow,
    )
    assert {r["v"]: (r["u"], r["us"], r["w"]) for r in got.collect()} == plain(rows, weights)


def test_union_sizes_without_rows_or_weights(spark):
    none = spark.createDataFrame([], "v string, g string")
    assert G.union_sizes(none).count() == 0
    got = G.union_sizes(spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "y")], "v string, g string")).collect()
    assert sorted((r["v"], r["u"], r["us"]) for r in got) == [("a", 2, 0), ("b", 2, 0)]


def test_a_hub_of_members_with_several_owners(spark):
    n = 20_000
    rows = spark.range(n).selectExpr("concat('v', id) AS v", "explode(array('hub', concat('own', id), concat('part', id % 500))) AS g")
    started = time.time()
    got = G.union_sizes(rows).groupBy("u").count().collect()
    assert [(r["u"], r["count"]) for r in got] == [(n, n)]
    assert time.time() - started < 60


def test_pairs_of_wide_signatures_are_summed_without_a_shuffle_of_pairs(spark):
    rows = [(f"v{i}", f"g{(i + j) % 40}") for i in range(40) for j in range(14)]
    got = G.union_sizes(spark.createDataFrame(rows, "v string, g string"))
    plan = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not [x for x in plan if "Aggregate [" in x and "gs2" in x.split("Aggregate [")[1].split("]")[0]]
    assert {r["v"]: r["u"] for r in got.collect()} == {v: n for v, (n, _, _) in plain(rows, {}).items()}
