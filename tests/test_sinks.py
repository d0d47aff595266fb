"""Sink semantics: insert-or-ignore keeps the first writer, upsert coalesces, history keeps 30 days."""

import datetime as dt

from vesselrisk.sources import sinks


def test_insert_or_ignore_first_writer_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([("1", 1, "x"), ("1", 1, "y"), ("2", 1, "z")], "k string, p int, v string")
    assert sinks.insert_or_ignore(a, path, ["k"], ["p"]) == 2
    b = spark.createDataFrame([("1", 1, "new"), ("3", 1, "w")], "k string, p int, v string")
    assert sinks.insert_or_ignore(b, path, ["k"], ["p"]) == 1
    got = {r["k"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert got == {"1": "x", "2": "z", "3": "w"}


def test_upsert_coalesces_and_overwrites(spark):
    old = spark.createDataFrame([("1", 70, True), ("2", 80, False)], "imo string, vessel_type int, scrapped boolean")
    new = spark.createDataFrame([("1", None, False), ("3", 60, True)], "imo string, vessel_type int, scrapped boolean")
    got = {r["imo"]: (r["vessel_type"], r["scrapped"]) for r in sinks.upsert(new, old, "imo", ("scrapped",)).collect()}
    assert got == {"1": (70, False), "2": (80, False), "3": (60, True)}


def test_score_history_replaces_today_and_trims(spark):
    today = dt.date(2024, 3, 1)
    hist = spark.createDataFrame(
        [("a", 0.1, today), ("a", 0.2, today - dt.timedelta(days=1)), ("a", 0.3, today - dt.timedelta(days=40))],
        "mmsi string, confidence double, score_date date")
    new = spark.createDataFrame([("a", 0.9)], "mmsi string, confidence double")
    rows = sorted((r["score_date"], r["confidence"]) for r in sinks.score_history(hist, new, today).collect())
    assert rows == [(today - dt.timedelta(days=1), 0.2), (today, 0.9)]


def test_insert_or_ignore_order_and_null_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([("1", 5, "late"), ("1", 2, "early"), (None, 1, "n"), (None, 3, "m")], "k string, o int, v string")
    assert sinks.insert_or_ignore(a, path, ["k"], order_by=["o"]) == 2
    assert sinks.insert_or_ignore(a, path, ["k"], order_by=["o"]) == 0
    assert {(r["k"], r["v"]) for r in spark.read.parquet(path).collect()} == {("1", "early"), (None, "n")}


def test_upsert_takes_one_row_per_key(spark):
    old = spark.createDataFrame([("1", 70, True)], "imo string, vessel_type int, scrapped boolean")
    new = spark.createDataFrame([("1", 60, True), ("1", None, None), ("2", 1, True), ("2", 2, False)], "imo string, vessel_type int, scrapped boolean").coalesce(1)
    got = [(r["imo"], r["vessel_type"], r["scrapped"]) for r in sinks.upsert(new, old, "imo", ("scrapped",)).orderBy("imo").collect()]
    assert got == [("1", 60, None), ("2", 2, False)]


def test_export_rejects_null_days_and_counts_its_own_run(spark, tmp_path):
    path = str(tmp_path / "t")
    t = dt.datetime(2024, 1, 1, 5)
    rows = spark.createDataFrame([("a", t), ("b", t), ("c", None)], "mmsi string, timestamp timestamp")
    assert {(str(r["date"]), r["rows"]) for r in sinks.export_by_date(rows, path).collect()} == {("2024-01-01", 2), ("None", 1)}
    more = rows.unionByName(spark.createDataFrame([("a", t + dt.timedelta(days=1))], rows.schema))
    assert {(str(r["date"]), r["rows"]) for r in sinks.export_by_date(more, path).collect()} == {("2024-01-02", 1), ("None", 1)}
    assert spark.read.parquet(path).count() == 3
