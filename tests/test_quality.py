"""Partition and coverage gates see the bad rows and the missing days."""

import datetime as dt

from vesselrisk import config as C
from vesselrisk.plans import quality

T = dt.datetime(2024, 1, 30, 12)


def test_bad_coordinates_are_reported(spark):
    name = C.REGIONS[0][0]
    rows = [(name, "1", T, 1.0, 103.0), (name, "2", T, None, 103.0), (name, "3", T, 95.0, 103.0)]
    got = quality.partition_checks(spark.createDataFrame(rows, "region string, mmsi string, timestamp timestamp, lat double, lon double")).collect()
    assert [(r["row_count"], r["out_of_range"], r["coord_null_rate"], r["passed"]) for r in got] == [(3, 1, round(1 / 6, 4), False)]


def test_missing_days_fail_and_sentinels_pass(spark):
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 3)]
    checks = spark.createDataFrame([(r[0], d, True) for r in C.REGIONS for d in days], "region string, date date, passed boolean")
    empty = spark.createDataFrame([(r[0], dt.date(2024, 1, 4)) for r in C.REGIONS], "region string, date date")
    got = quality.coverage(checks, dt.date(2024, 1, 1), dt.date(2024, 1, 4), sentinels=empty).orderBy("date").collect()
    assert [r["passed"] for r in got] == [True, False, True, True]


def test_a_positive_label_on_either_key_wins(spark):
    from vesselrisk.plans.evaluate import label_watchlist

    w = spark.createDataFrame([("1", "9"), ("2", "8"), ("3", None)], "mmsi string, imo string")
    lab = spark.createDataFrame([("1", "", "cleared", "high"), ("", "9", "confirmed", "low"), ("2", "", "negative", "mid")],
                                "mmsi string, imo string, label string, label_confidence string")
    got = {r["mmsi"]: (r["y_true"], r["label_confidence"]) for r in label_watchlist(w, lab).collect()}
    assert got == {"1": (1, "high"), "2": (0, "mid"), "3": (None, None)}
