"""Source coverage against a plain lookup."""

import random

from vesselrisk.plans import coverage as S

R = "window_id string, mmsi string, imo string, confidence double"
L = "window_id string, mmsi string, imo string, label string"


def plain(rows, label, capacities):
    """(path, rank, place) of a label by walking the sorted list."""
    w, mmsi, imo, _ = label
    own = sorted((r for r in rows if r[0] == w), key=lambda r: (r[3] is None, -(r[3] or 0), r[1] or ""))
    for path, at, key in (("mmsi", 1, mmsi), ("imo", 2, imo)):
        key = (key or "").strip()
        for place, r in enumerate(own, 1):
            if key and (r[at] or "").strip() == key:
                rank = None if r[3] is None else 1 + sum(1 for x in own if x[3] is not None and x[3] > r[3])
                return path, rank, place if place <= max(capacities) else None
    return None, None, None


def test_ranks_and_coverage_equal_plain_lookup(spark):
    rng = random.Random(4)
    rows = [(w, f"{i:04d}", f"9{i % 37:02d}", rng.choice([None, 0.5, rng.randrange(50) / 50])) for w in ("a", "b") for i in range(150)]
    rows += [("a", "0003", "", 0.77), ("none", "1", "1", 0.3)]  # one vessel twice; a window without labels
    labels = [(w, rng.choice([None, "", f" {rng.randrange(220):04d}"]), rng.choice([None, f"9{rng.randrange(50):02d}", " "]), rng.choice(["positive", "negative"]))
              for w in ("a", "b") for _ in range(60)]
    labels += [("a", "0003", None, "positive")] * 2 + [("empty", "0001", "900", "positive")]
    ranked, given, ks = spark.createDataFrame(rows, R), spark.createDataFrame(labels, L), (5, 20)
    positive = [x for x in labels if x[3] == "positive"]
    expected = [(x[0], *plain(rows, x, ks)) for x in positive]
    got = S.label_ranks(ranked, given, ks).collect()
    order = lambda x: tuple(str(v) for v in x)
    assert sorted(((r.window_id, r.path, r["rank"], r.place) for r in got), key=order) == sorted(expected, key=order)
    cover = {(r.window_id, r.review_capacity): r for r in S.source_coverage(ranked, given, ks).collect()}
    assert set(cover) == {(w, k) for w in ("a", "b", "none", "empty") for k in ks}
    for (w, k), r in cover.items():
        own = [e for e in expected if e[0] == w]
        assert r.source_positive_total == len(own) and r.matched_total == sum(e[1] is not None for e in own)
        assert r.hits == sum(e[3] is not None and e[3] <= k for e in own) and r.missed_total == len(own) - r.matched_total
    assert cover["none", 5].recall == 0.0 and cover["empty", 5].missed_total == 1


def test_no_rows(spark):
    ranked, given = spark.createDataFrame([], R), spark.createDataFrame([], L)
    assert S.source_coverage(ranked, given).count() == 0 and S.label_ranks(ranked, given).count() == 0
