"""Streaming gap alerts keep per-vessel spans across micro-batches; late fixes take alerts back."""

import datetime as dt
import os
import random

import numpy as np

from vesselrisk.streaming import positions as S


def _land(spark, tmp_path, batches, name):
    """Batches as files of one folder, in order of arrival."""
    land = tmp_path / name
    land.mkdir()
    for i, rows in enumerate(batches):
        out = tmp_path / f"{name}-{i}"
        spark.createDataFrame(rows, "mmsi string, timestamp timestamp").coalesce(1).write.parquet(str(out))
        dst = land / f"part-{i}.parquet"
        dst.write_bytes(next(out.glob("*.parquet")).read_bytes())
        os.utime(dst, (1_700_000_000 + 100 * i, 1_700_000_000 + 100 * i))
    return spark.readStream.schema("mmsi string, timestamp timestamp").option("maxFilesPerTrigger", 1).parquet(str(land))


def _alerts(spark, tmp_path, batches, name):
    out = str(tmp_path / f"{name}-alerts")
    S.run_gap_alerts(_land(spark, tmp_path, batches, name), out, str(tmp_path / f"{name}-ckpt")).awaitTermination()
    return spark.read.parquet(out)


def test_a_late_fix_takes_an_alert_back(spark, tmp_path):
    t0, h = dt.datetime(2024, 1, 1), lambda x: dt.timedelta(hours=x)
    batches = [
        [("a", t0), ("a", t0 + h(1)), ("b", t0), (None, t0), ("c", None)],
        [("a", t0 + h(40)), ("a", t0 + h(0.5)), ("b", t0 + h(5))],
        [("a", t0 + h(12)), ("a", t0 + h(12)), ("a", t0 - h(30))],
        [("a", t0 + h(30)), ("a", t0 + h(21))],
    ]
    changes = _alerts(spark, tmp_path, batches, "late")
    gaps = lambda df: sorted((r["mmsi"], (r["gap_start"] - t0) / h(1), (r["gap_end"] - t0) / h(1)) for r in df.collect())
    assert gaps(changes.where("change = -1")) == [("a", 1, 40), ("a", 12, 40)]
    assert gaps(S.current_alerts(changes)) == [("a", -30, 0), ("a", 1, 12)]


def test_alerts_are_the_same_for_every_order_of_files(spark, tmp_path):
    rng = random.Random(7)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(v, t0 + dt.timedelta(minutes=rng.randrange(60 * 24 * 20))) for v in "abc" for _ in range(40)]
    rows += [("a", t0 + dt.timedelta(minutes=m)) for m in range(0, 2000, 3)] + rows[:5]
    want = []
    for v in "abc":
        times = sorted({t for m, t in rows if m == v})
        want += [(v, a, b) for a, b in zip(times, times[1:]) if (b - a) // dt.timedelta(minutes=1) > 600]
    for k in range(3):
        rng.shuffle(rows)
        cuts = [0, 30, 60, 500, len(rows)]
        changes = _alerts(spark, tmp_path, [rows[i:j] for i, j in zip(cuts, cuts[1:])], f"order{k}")
        got = [(r["mmsi"], r["gap_start"], r["gap_end"]) for r in S.current_alerts(changes).collect()]
        assert sorted(got) == sorted(want)


def test_spans_meet_at_the_threshold():
    us = np.array([0, 601, 1202, 1802]) * S.MINUTE_US
    assert [x.tolist() for x in S.merge_spans(us, us, 600)] == [[0, us[1], us[2]], [0, us[1], us[3]]]
    inside = S.merge_spans(np.array([0, 10]), np.array([10**12, 20]), 600)
    assert [x.tolist() for x in inside] == [[0], [10**12]]


def test_rows_far_behind_are_stored_once(spark, tmp_path):
    land, table = tmp_path / "land", str(tmp_path / "table")
    land.mkdir()
    t0 = dt.datetime(2024, 1, 10)
    schema = "mmsi string, timestamp timestamp, lat double, lon double"
    days = [[("a", t0)], [("b", t0 + dt.timedelta(days=5)), ("a", t0)], [("c", t0 - dt.timedelta(days=3)), ("b", t0 + dt.timedelta(days=5))]]
    for i, rows in enumerate(days):
        spark.createDataFrame([(*r, 1.0, 2.0) for r in rows], schema).coalesce(1).write.parquet(str(tmp_path / f"b{i}"))
        part = next((tmp_path / f"b{i}").glob("*.parquet"))
        (land / f"part-{i}.parquet").write_bytes(part.read_bytes())
        os.utime(land / f"part-{i}.parquet", (1_700_000_000 + 100 * i, 1_700_000_000 + 100 * i))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(land))
    S.ingest_positions(stream, table, str(tmp_path / "ckpt")).awaitTermination()
    assert sorted(r["mmsi"] for r in spark.read.parquet(table).collect()) == ["a", "b", "c"]
