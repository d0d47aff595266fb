"""Counts of points in boxes against brute force; fusion without a row a pair."""

import datetime as dt

import numpy as np
import pandas as pd

from vesselrisk.operators import coverage_counts as cc
from vesselrisk.operators import fusion


def _brute(points, requests, lat_tol, lon_tol, km):
    out = {}
    for g, lat, lon, lo, hi in requests.itertuples(index=False):
        near = (np.abs(points.lat - lat) <= lat_tol) & (np.abs(points.lon - lon) <= lon_tol) & (points.t >= lo) & (points.t <= hi)
        if km is not None:
            near &= cc._km(lat, lon, points.lat, points.lon) <= km
        out.setdefault(g, set()).update(np.flatnonzero(near))
    return {g: len(v) for g, v in out.items() if v}


def _tables(seed, n, m):
    rng = np.random.default_rng(seed)
    points = pd.DataFrame({"lat": rng.normal(0, 0.3, n), "lon": rng.normal(0, 0.3, n), "t": rng.integers(0, 2 * cc.DAY_US, n)})
    points.loc[: n // 3, ["lat", "lon"]] = [0.25, -0.5]  # a crowded place
    lo = rng.integers(-cc.DAY_US // 4, 2 * cc.DAY_US, m)
    requests = pd.DataFrame({"grp": [f"g{i}" for i in rng.integers(0, m // 6, m)], "lat": rng.normal(0, 0.3, m), "lon": rng.normal(0, 0.3, m),
                             "lo": lo, "hi": lo + rng.integers(0, cc.DAY_US, m)})
    return points, requests


def test_counts_equal_brute_force(monkeypatch):
    monkeypatch.setattr(cc, "PAIRS", 500)
    for seed, (lat_tol, lon_tol, km) in enumerate([(0.1, 0.1, None), (0.5, 0.7, None), (0.3, 0.5, 30.0), (0.01, 0.02, 1.0)]):
        points, requests = _tables(seed, 6000, 300)
        found = cc.count_points(points.assign(lo=points.t), requests, lat_tol, lon_tol, km)
        assert dict(zip(found.grp, found.n)) == _brute(points, requests, lat_tol, lon_tol, km)


def test_bins_and_slices_lose_nothing(spark):
    points, requests = _tables(9, 3000, 240)
    got = cc.covered_counts(spark.createDataFrame(points), spark.createDataFrame(requests), 0.3, 0.4, 25.0, most=50).collect()
    assert {r.grp: r.n for r in got} == _brute(points, requests, 0.3, 0.4, 25.0)


def test_fusion_makes_no_row_a_pair(spark):
    """300 vessels and 300 detections at one place and hour: 90,000 pairs, counted without a shuffle of them."""
    pos = spark.range(300).selectExpr("cast(id as string) mmsi", "timestamp'2024-01-10 00:00:00' timestamp", "1.0 lat", "2.0 lon")
    det = spark.range(300).selectExpr("concat('D', id) detection_id", "timestamp'2024-01-10 01:00:00' detected_at", "1.05D lat", "2.0D lon")
    plan = fusion.eo_features(det, pos)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInPandas" in plan
    rows = fusion.eo_features(det, pos).collect()
    assert len(rows) == 300 and {r.eo_ais_mismatch_ratio for r in rows} == {0.0}


def test_ids_on_several_rows_count_once(spark):
    pos = spark.createDataFrame([("a", dt.datetime(2024, 1, 10, 0), 1.0, 2.0), ("a", dt.datetime(2024, 1, 11, 0), 1.0, 2.0),
                                 (None, dt.datetime(2024, 1, 10, 0), 1.0, 2.0)], "mmsi string, timestamp timestamp, lat double, lon double")
    det = spark.createDataFrame([("D1", dt.datetime(2024, 1, 10, 12), 1.0, 2.1), ("D1", dt.datetime(2024, 1, 10, 13), 1.0, 2.2),
                                 ("D1", dt.datetime(2024, 1, 10, 13), 1.0, 2.2), ("D2", dt.datetime(2024, 1, 10, 14), 1.0, 2.0),
                                 ("D2", dt.datetime(2024, 1, 10, 14), 1.0, 2.0), ("D3", dt.datetime(2024, 1, 10, 1), 1.0, 2.0), ("D4", None, 1.0, 2.0)],
                                "detection_id string, detected_at timestamp, lat double, lon double")
    assert [(r.mmsi, r.unmatched_sar_detections_30d) for r in fusion.unmatched_sar_detections(det, pos).collect()] == [("a", 2)]
    eo = {r.mmsi: (r.eo_dark_count_30d, r.eo_ais_mismatch_ratio) for r in fusion.eo_features(det, pos).collect()}
    assert eo == {"a": (2, 2 / 3), None: (0, 0.0)}


def test_steps_of_fusion_are_written_not_nested(spark):
    """F2-F8: the last plan of each feature holds one count of points, not all earlier ones several times over."""
    t0 = dt.datetime(2024, 1, 1)
    fixes = spark.createDataFrame([("a", t0, 1.0, 103.0), ("a", t0 + dt.timedelta(hours=30), 1.0, 103.0)], "mmsi string, timestamp timestamp, lat double, lon double")
    det = spark.createDataFrame([("x", t0 + dt.timedelta(hours=9), 1.0, 103.0)], "detection_id string, detected_at timestamp, lat double, lon double")
    for found, counts in ((fusion.unmatched_sar_detections(det, fixes), 1), (fusion.eo_features(det, fixes), 2)):
        assert found._jdf.queryExecution().optimizedPlan().toString().count("FlatMapGroupsInPandas") == counts
        assert [r["mmsi"] for r in found.collect()] == ["a"]
