"""Multi-window backtest against a plain row-by-row computation."""

import math
import random

import pytest

from vesselrisk.plans import backtest as B

R = "window_id string, mmsi string, vessel_type string, confidence double, y_true int"


def frame(spark):
    rng = random.Random(3)
    rows = [(w, f"{i:04d}", "cargo", rng.randrange(40) / 40, rng.choice([0, 0, 1, None])) for w, n in (("a", 400), ("b", 90)) for i in range(n)]
    rows += [("a", f"tie{i:03d}", "tanker", 0.5, i % 2) for i in range(300)]  # one score with a third of the rows
    rows += [("one_class", f"p{i}", "cargo", 0.1 * i, 1) for i in range(9)] + [("no_label", "x", "cargo", 0.4, None)]
    rows += [("b", "null", "cargo", None, 1), ("b", "nan", "cargo", math.nan, 0)]
    return spark.createDataFrame(rows, R), rows


def on_curve(rows, w):
    return [(r[3], r[4], r[1]) for r in rows if r[0] == w and r[4] is not None and r[3] is not None and not math.isnan(r[3])]


def plain_threshold(lab):
    best = None
    for t in sorted({s for s, _, _ in lab}):
        tp = sum(y for s, y, _ in lab if s >= t)
        fp = sum(1 - y for s, y, _ in lab if s >= t)
        f1 = 2 * tp / (tp + fp + sum(y for _, y, _ in lab)) if tp else 0.0
        best = max(best, (f1, t)) if best else (f1, t)
    return best[1]


def test_windows_equal_plain_metrics(spark):
    df, rows = frame(spark)
    got = {r.window_id: r for r in B.backtest_windows(df).collect()}
    assert set(got) == {"a", "b", "one_class", "no_label"}
    for w in "ab":
        lab = on_curve(rows, w)
        pos, neg = [s for s, y, _ in lab if y], [s for s, y, _ in lab if not y]
        auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
        ap = sum(sum(y for s, y, _ in lab if s >= p) / sum(1 for s, _, _ in lab if s >= p) for p in pos) / len(pos)
        assert got[w].auroc == pytest.approx(auc) and got[w].pr_auc == pytest.approx(ap)
        assert got[w].recommended_threshold == plain_threshold(lab)
    assert got["b"].labeled_count == len(on_curve(rows, "b")) + 2
    assert got["one_class"].auroc is None and got["one_class"].recommended_threshold == 0.7
    assert got["no_label"].recommended_threshold is None and got["no_label"].precision_at_50 == 0.0


def test_error_lists_and_ranks(spark):
    df, rows = frame(spark)
    windows = B.backtest_windows(df)
    cut = {r.window_id: r.recommended_threshold for r in windows.collect()}
    got = B.error_lists(df, windows, 4).collect()
    for w in ("a", "b", "one_class"):
        lab = on_curve(rows, w)
        for kind, wrong in (("false_positive", lambda s, y: s >= cut[w] and y == 0), ("false_negative", lambda s, y: s < cut[w] and y == 1)):
            errors = sorted(((-s, m) for s, y, m in lab if wrong(s, y)))
            own = sorted((r.place, r.mmsi, r.errors) for r in got if (r.window_id, r.kind) == (w, kind))
            assert own == [(i + 1, m, len(errors)) for i, (_, m) in enumerate(errors[:4])]
    ranks = {(r.window_id, r.mmsi): r["rank"] for r in B.positive_ranks(df).collect()}
    assert ranks == {(w, m): 1 + sum(t > s for t, _, _ in on_curve(rows, w)) for w in ("a", "b", "one_class") for s, y, m in on_curve(rows, w) if y}


def test_intervals(spark):
    per = spark.createDataFrame([("a", 0.2, 0.5), ("b", 0.4, None), ("c", 0.9, None)], "window_id string, m double, k double")
    got = {r.metric: r for r in B.metric_intervals(per, ("m", "k")).collect()}
    half = 1.96 * math.sqrt(sum((x - 0.5) ** 2 for x in (0.2, 0.4, 0.9)) / 2) / math.sqrt(3)
    assert (got["m"].windows, got["k"].windows) == (3, 1)
    assert got["m"].ci95_low == pytest.approx(0.5 - half) and got["m"].ci95_high == pytest.approx(0.5 + half)
    assert got["k"].mean == 0.5 and got["k"].ci95_low is None


def test_no_rows(spark):
    df = spark.createDataFrame([], R)
    windows = B.backtest_windows(df)
    assert windows.count() == 0 and B.error_lists(df, windows).count() == 0 and B.positive_ranks(df).count() == 0
    assert [(r.mean, r.windows) for r in B.metric_intervals(windows).collect()] == [(None, 0)] * 4
