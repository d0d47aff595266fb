"""Public labels, pre-label holdout and the publish gate on small frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vesselrisk.plans import labels as L
from vesselrisk.plans import prelabels as P
from vesselrisk.sources import publish

W = "window_id string, mmsi string, imo string, vessel_name string, confidence double"
S = "mmsi string, imo string, name string, type string, list_source string"


def test_name_key(spark):
    names = ["  m/v Ocean  Star-1. ", "ÉTOILE", "", None, "..."]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(L.vessel_name_key(F.col("n")).alias("k")).collect()
    assert [r.k for r in got] == ["MV OCEAN STAR1", "TOILE", "", None, ""]


def test_matches_on_three_paths(spark):
    sanctions = spark.createDataFrame([
        ("111111111", None, "One", "Vessel", "us_ofac_sdn"), ("111111111", None, "One", "Vessel", "eu_fsf"), (None, "9000002", "Two", "Vessel", "eu_fsf"),
        (None, None, "M.V. Three", "Vessel", "un_sc"), (None, None, "Four Ltd", "Company", "us_ofac_sdn"), ("555555555", None, "Five", "Vessel", "xx_list"),
        (None, None, "", "Vessel", "us_ofac_sdn"), (None, None, "...", "Vessel", "us_ofac_sdn")], S)
    watch = spark.createDataFrame([
        ("r", "111111111", "9000002", "x", 0.9), ("r", "222222222", "9000002", "y", 0.8), ("r", "333333333", "", "mv three", 0.7),
        ("r", "444444444", None, "Four Ltd", 0.6), ("r", "555555555", None, None, 0.5), ("r", "666666666", "", "", 0.4)], W)
    found = L.label_matches(watch, L.public_positives(sanctions)).orderBy("mmsi").collect()
    assert [(r.mmsi, r.path, r.evidence_source) for r in found] == [("111111111", 1, "eu_fsf"), ("222222222", 2, "eu_fsf"), ("333333333", 3, "un_sc")]


@pytest.mark.parametrize("n_pos, quota", [(0, 50), (5, 45), (30, 60)])
def test_quota_of_negatives(spark, n_pos, quota):
    rows = [("r", f"{i:09d}", f"9{i:06d}", f"v{i}", 0.9 if i < n_pos else 0.1) for i in range(200)] + [("q", "1", "1", "z", 0.05)]
    sanctions = spark.createDataFrame([(f"{i:09d}", None, f"s{i}", "Vessel", "us_ofac_sdn") for i in range(n_pos)], S)
    got = L.public_labels(spark.createDataFrame(rows, W), L.public_positives(sanctions), 40)
    by = {(r.window_id, r.label): r["count"] for r in got.groupBy("window_id", "label").count().collect()}
    assert by.get(("r", "positive"), 0) == n_pos and by["r", "negative"] == quota and by["q", "negative"] == 1
    assert got.select("window_id", "mmsi", "imo").distinct().count() == got.count()


def test_best_known_cases_and_seeded_vessels(spark):
    rows = [("r", str(i), str(i), f"v{i}", i / 100) for i in range(10)] * 2
    sanctions = spark.createDataFrame([(str(i), None, "s", "Vessel", "eu_fsf") for i in range(10)], S)
    seeded = spark.createDataFrame([("9",)], "mmsi string")
    got = L.public_labels(spark.createDataFrame(rows, W), L.public_positives(sanctions), 3, seeded)
    assert sorted(r.mmsi for r in got.where("label = 'positive'").collect()) == ["6", "7", "8"]
    assert got.where("mmsi = '9' and label = 'negative'").count() == 1


PRE = "mmsi string, pre_label string, confidence_tier string, region string, evidence_timestamp timestamp"


def day(n):
    return dt.datetime(2024, 1, n, tzinfo=dt.UTC)


def windows(spark, rows):
    return spark.createDataFrame(rows, "window_id string, end timestamp, region string, min_tier string")


def test_a_label_after_the_cutoff_changes_nothing(spark):
    known = [(" a ", "Suspected-Positive", "HIGH", "N", day(2)), ("b", "analyst-negative", "weak", "n", day(3)), ("c", "uncertain", "high", "n", day(3)), ("d", "analyst-negative", "none", "n", day(1))]
    later = [("a", "analyst-negative", "high", "n", day(20)), ("b", "suspected-positive", "high", "n", day(11)), ("b", "suspected-positive", "high", "n", None)]
    watch = spark.createDataFrame([("w", m, c) for m, c in (("a", 0.9), ("b", 0.5), ("c", 0.4), ("d", 0.3), ("e", 0.1))], "window_id string, mmsi string, confidence double")
    w = windows(spark, [("w", day(10), None, "weak")])
    results = []
    for rows in (known, known + later):
        pre = P.tidy(spark.createDataFrame(rows, PRE))
        labelled = P.label_windows(watch, P.usable(pre, w))
        results.append(sorted((r.mmsi, r.pre_label, r.y_true) for r in labelled.collect()))
        e = P.evaluate(watch, pre, w).first()
        assert (e.labeled_count, e.positive_count, e.n_high, e.n_weak, e.n_leaked) == (2, 1, 1, 1, len(rows) - len(known))
        assert e.precision_at_50 == 0.5
    assert results[0] == results[1]


def test_each_window_has_its_own_cutoff_region_and_tier(spark):
    pre = P.tidy(spark.createDataFrame([("a", "suspected-positive", "weak", "n", day(2)), ("a", "analyst-negative", "high", "n", day(8)), ("a", "suspected-positive", "medium", "s", day(9))], PRE))
    w = windows(spark, [("1", day(5), None, "weak"), ("2", day(8), "N", "medium"), ("3", day(10), None, "weak"), ("4", day(5), None, "high"), ("5", day(10), "s", "high")])
    got = {r.window_id: r.pre_label for r in P.usable(pre, w).collect()}
    assert got == {"1": "suspected-positive", "2": "analyst-negative", "3": "suspected-positive"}


def test_disagreements_are_capped_and_ordered(spark):
    rows = [("w", f"{i:02d}", i / 40, i % 2, "x", "weak") for i in range(40)] + [("w", "u", 0.9, None, "uncertain", "unknown")]
    labelled = spark.createDataFrame(rows, "window_id string, mmsi string, confidence double, y_true int, pre_label string, confidence_tier string")
    got = P.disagreements(labelled, 0.5, most=5).orderBy("kind", "rk").collect()
    assert [r.mmsi for r in got] == ["38", "36", "34", "32", "30", "01", "03", "05", "07", "09"]


def test_prelabel_csv(spark, tmp_path):
    path = tmp_path / "pre.csv"
    path.write_text("mmsi,pre_label,confidence_tier,evidence_timestamp\n 1 ,Suspected-Positive , High,2024-01-02T03:04:05Z\n2,x,weak,never\n")
    a, b = P.read_prelabels(spark, str(path)).orderBy("mmsi").collect()
    assert (a.mmsi, a.pre_label, a.confidence_tier, a.region) == ("1", "suspected-positive", "high", None) and a.evidence_timestamp is not None
    assert b.evidence_timestamp is None


def test_a_failing_gate_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path / "t")
    meta = "mmsi string, imo string"
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, root)
    old = spark.createDataFrame([("123456789", "1"), ("223456789", None)], meta)
    assert publish.publish_vessel_meta(old, root).version == 1
    for bad in ([("12", "1")], [(None, "1")], [("123456789", "1"), ("123456789", "2")], [("123456789", "x")], []):
        out = publish.publish_vessel_meta(spark.createDataFrame(bad, meta), root)
        assert out.status == "rejected" and out.problems and not out.ok
        assert publish.read_published(spark, root).count() == 2
    assert publish.publish(spark.createDataFrame([(1,)], "x int"), root, ["mmsi"], optional=True).status == "skipped"
    new = spark.createDataFrame([("323456789", "3")], meta)
    assert publish.publish_vessel_meta(new, root).version == 2
    assert [r.mmsi for r in publish.read_published(spark, root).collect()] == ["323456789"]


def test_features_are_replaced_whole(spark, tmp_path):
    root = str(tmp_path / "f")
    frame = lambda v: spark.createDataFrame([("1", v, 0)], "mmsi string, a int, b int")
    assert publish.publish_features(frame(1), root, ["a", "b"]).ok
    assert publish.publish_features(frame(None), root, ["a", "b"]).status == "rejected"
    assert publish.publish_features(frame(2), root, ["a", "b"]).version == 2
    got = publish.read_published(spark, root).first()
    assert got.a == 2 and got.last_computed is not None
