"""The feature matrix is worked out family by family."""

from vesselrisk.plans.features import build_feature_matrix
from vesselrisk.session import ensure_conf


def test_the_last_plan_is_small(spark):
    """All families in one plan had hundreds of operators, held by the driver at once."""
    ensure_conf(spark)
    pos = spark.sql("select 'a' mmsi, timestamp'2024-01-20 00:00:00' timestamp, 1.0D lat, 103.0D lon, 1.0D sog, 0 nav_status")
    meta = spark.createDataFrame([("a", "9", "A", "IR", 82), ("b", "8", "B", "SG", 70)], "mmsi string, imo string, name string, flag string, ship_type int")
    sanctions = spark.createDataFrame([("S1", "co", None, None, None, "Company", "eu_fsf")],
                                      "entity_id string, name string, mmsi string, imo string, flag string, type string, list_source string")
    edges = [spark.createDataFrame(rows, "src_id string, dst_id string") for rows in
             ([("a", "S1"), ("b", "S1")], [("a", "S2")], [("S2", "S1")], [("S1", "IR")], [("S1", "A1")])]
    columns = ["sanctions_distance", "cluster_sanctions_ratio", "owner_changes_2y", "high_risk_flag_ratio"]
    df = build_feature_matrix(pos, meta, sanctions, *edges, None, None, columns=columns)
    assert len(df._jdf.queryExecution().optimizedPlan().toString().splitlines()) < 60
    got = {r.mmsi: (r.sanctions_distance, r.owner_changes_2y, r.high_risk_flag_ratio, r.cluster_sanctions_ratio) for r in df.collect()}
    assert got == {"a": (1, 1, 1.0, 0.0), "b": (1, 1, 1.0, 0.0)}
