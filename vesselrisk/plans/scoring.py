"""Scoring: context (M3), graph/identity scores (M4, M5), geo filter (P3),
composite confidence (M6), top signals (M7), propagation floor (M8), the
watchlist (M9) and the cross-region best candidate (M10)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.codes import flag_with_mid_fallback
from ..operators.identity import ship_type_label

# FIXED VALUES: the 17 columns ranked for the top-signals fallback, in order.
FEATURE_VALUE_COLUMNS = [
    "ais_gap_count_30d", "ais_gap_max_hours", "position_jump_count", "sts_candidate_count",
    "flag_changes_2y", "name_changes_2y", "owner_changes_2y", "sanctions_distance",
    "shared_address_centrality", "sts_hub_degree", "unmatched_sar_detections_30d",
    "eo_dark_count_30d", "eo_ais_mismatch_ratio", "imo_type_mismatch", "imo_scrapped_flag",
    "chokepoint_exit_gap_count", "ais_pre_gap_regularity",
]

WATCHLIST_COLUMNS = [
    "mmsi", "imo", "vessel_name", "vessel_type", "flag", "confidence", "behavioral_deviation_score",
    "graph_risk_score", "identity_score", "top_signals", "last_lat", "last_lon", "last_seen",
    "ais_gap_count_30d", "ais_gap_max_hours", "position_jump_count", "sts_candidate_count",
    "flag_changes_2y", "name_changes_2y", "owner_changes_2y", "sanctions_distance",
    "shared_address_centrality", "sts_hub_degree", "cluster_label", "baseline_noise_score",
]

# FIXED VALUES: geopolitical rerouting events (name, active_from, active_to,
# corridors as (lat_min, lat_max, lon_min, lon_max), down_weight), in file order.
DEFAULT_GEO_EVENTS = [
    ("Red Sea / Cape of Good Hope rerouting", "2023-11-01", "2026-12-31",
     [(-40.0, -25.0, 10.0, 40.0), (10.0, 30.0, 32.0, 50.0)], 0.5),
    ("Taiwan Strait tension — GPS spoofing zone", "2024-01-01", "2026-12-31",
     [(22.0, 28.0, 118.0, 122.0)], 0.7),
]


def _clip01(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))


def latest_positions(positions: DataFrame) -> DataFrame:
    """W4 as an aggregate: last fix per vessel via max_by (partial aggregation, no window)."""
    return positions.groupBy("mmsi").agg(
        F.max_by(F.struct("lat", "lon", "timestamp"), F.col("timestamp")).alias("_l")
    ).select("mmsi", F.col("_l.lat").alias("last_lat"), F.col("_l.lon").alias("last_lon"),
             F.col("_l.timestamp").alias("last_seen"))


def modal_ship_type(positions: DataFrame) -> DataFrame:
    """A5: most frequent positive AIS ship type per vessel (smallest on ties)."""
    return (
        positions.where(F.col("ship_type").isNotNull() & (F.col("ship_type") > 0))
        .groupBy("mmsi").agg(F.mode("ship_type", deterministic=True).alias("ais_ship_type"))
    )


def scoring_context(features: DataFrame, vessel_meta: DataFrame, positions: DataFrame) -> DataFrame:
    """M3: features + registry fields + last position + modal AIS type; flag falls back to MID."""
    vm = vessel_meta.select("mmsi", F.col("imo").alias("_imo"), F.col("name").alias("_name"),
                            F.col("ship_type").alias("_vm_type"), F.col("flag").alias("_flag"))
    ctx = (
        features.join(vm, "mmsi", "left")
        .join(latest_positions(positions), "mmsi", "left")
        .join(modal_ship_type(positions), "mmsi", "left")
        .withColumn("imo", F.coalesce("_imo", F.lit("")))
        .withColumn("vessel_name", F.coalesce("_name", "mmsi"))
        .withColumn("ship_type", F.coalesce("_vm_type", "ais_ship_type", F.lit(0)).cast("int"))
        .withColumn("flag", F.coalesce(F.when(F.col("_flag") != "", F.col("_flag")), F.lit("")))
        .drop("_imo", "_name", "_vm_type", "_flag", "ais_ship_type")
    )
    return flag_with_mid_fallback(ctx)


def graph_risk_score(df: DataFrame) -> Column:
    """M4: .45 distance + .25 cluster + .10 manager + .10 STS + .10 programs."""
    w = C.GRAPH_RISK_WEIGHTS
    dist = F.when(F.col("sanctions_distance") >= 99, 0.0).otherwise(_clip01(1.0 - F.col("sanctions_distance") / 5.0))
    mgr = F.when(F.col("shared_manager_risk") >= 99, 0.0).otherwise(_clip01(1.0 - F.col("shared_manager_risk") / 5.0))
    lists = F.coalesce(F.col("sanctions_list_count"), F.lit(0)) if "sanctions_list_count" in df.columns else F.lit(0)
    return (
        w["sanctions"] * dist + w["cluster"] * _clip01(F.col("cluster_sanctions_ratio"))
        + w["manager"] * mgr + w["sts"] * _clip01(F.col("sts_hub_degree") / 10.0)
        + w["lists"] * _clip01(lists / 5.0)
    )


def identity_score() -> Column:
    """M5: .40 names/5 + .30 owners/5 + .20 flag ratio + .10 depth/6."""
    w = C.IDENTITY_WEIGHTS
    return (
        w["names"] * _clip01(F.col("name_changes_2y") / 5.0) + w["owners"] * _clip01(F.col("owner_changes_2y") / 5.0)
        + w["flag_ratio"] * _clip01(F.col("high_risk_flag_ratio")) + w["depth"] * _clip01(F.col("ownership_depth") / 6.0)
    )


def geo_events_frame(spark: SparkSession, events=DEFAULT_GEO_EVENTS) -> DataFrame:
    """Events x corridor boxes as a small frame (event_order keeps file order)."""
    rows = []
    for order, (name, start, end, boxes, weight) in enumerate(events):
        for a, b, c, d in boxes:
            rows.append((order, name, dt.date.fromisoformat(start), dt.date.fromisoformat(end), a, b, c, d, float(weight)))
    return spark.createDataFrame(
        rows, "event_order int, name string, active_from date, active_to date, "
              "lat_min double, lat_max double, lon_min double, lon_max double, down_weight double")


def geo_factor(ctx: DataFrame, events: DataFrame, reference_date: dt.date) -> DataFrame:
    """Multiplier of the first active event whose corridor holds the last position (else 1)."""
    active = events.where((F.lit(reference_date) >= F.col("active_from")) & (F.lit(reference_date) <= F.col("active_to")))
    hit = (
        ctx.select("mmsi", "last_lat", "last_lon")
        .join(F.broadcast(active),  # a config list of events x boxes: tiny by construction
              F.col("last_lat").between(F.col("lat_min"), F.col("lat_max"))
              & F.col("last_lon").between(F.col("lon_min"), F.col("lon_max")))
        .groupBy("mmsi").agg(F.min_by("down_weight", "event_order").alias("geo_weight"))
    )
    return ctx.select("mmsi").join(hit, "mmsi", "left").select("mmsi", F.coalesce("geo_weight", F.lit(1.0)).alias("geo_weight"))


def top_signal_array(n: int = 5) -> Column:
    """M7 fallback: the ``n`` features with largest |value| (stable order on ties)."""
    items = F.array(*[
        F.struct(F.lit(i).alias("idx"), F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"),
                 F.abs(F.col(c).cast("double")).alias("magnitude"))
        for i, c in enumerate(FEATURE_VALUE_COLUMNS)
    ])
    items = F.filter(items, lambda x: x["value"].isNotNull())
    ordered = F.array_sort(items, lambda a, b: F.when(a["magnitude"] > b["magnitude"], -1)
                           .when(a["magnitude"] < b["magnitude"], 1)
                           .otherwise(a["idx"] - b["idx"]))
    return F.transform(F.slice(ordered, 1, n), lambda x: F.struct(
        x["feature"].alias("feature"), x["value"].alias("value"), F.round(x["magnitude"], 3).alias("contribution")))


def top_signals_long(features: DataFrame, n: int = 5) -> DataFrame:
    """Top signals exploded to (mmsi, rank, feature, value, contribution)."""
    return features.select("mmsi", F.posexplode(top_signal_array(n)).alias("pos", "s")).select(
        "mmsi", (F.col("pos") + 1).alias("rank"), F.col("s.feature").alias("feature"),
        F.col("s.value").alias("value"), F.col("s.contribution").alias("contribution"))


def propagation_floor(propagated: DataFrame) -> DataFrame:
    """Per vessel the highest positive propagated confidence and its evidence type."""
    return (
        propagated.where(F.col("propagated_confidence") > 0)
        .groupBy("mmsi")
        .agg(F.max("propagated_confidence").alias("floor"),
             F.max_by("evidence_type", F.struct("propagated_confidence", F.col("evidence_type"))).alias("floor_evidence"))
    )


def composite_scores(
    ctx: DataFrame,
    anomaly: DataFrame,
    w_anomaly: float = C.ANOMALY_WEIGHT,
    w_graph: float = C.GRAPH_WEIGHT,
    w_identity: float = C.IDENTITY_WEIGHT,
    geo: DataFrame | None = None,
    floor: DataFrame | None = None,
) -> DataFrame:
    """M6-M9: confidence = clip(wa*behaviour + wg*graph + wi*identity), optional geo and floor."""
    s = ctx.join(anomaly, "mmsi", "left").withColumn(
        "behavioral_deviation_score", F.coalesce("behavioral_deviation_score", F.lit(0.0))
    ).withColumn("cluster_label", F.coalesce("cluster_label", F.lit(0))).withColumn(
        "baseline_noise_score", F.coalesce("baseline_noise_score", F.lit(0.0)))
    s = s.withColumn("graph_risk_score", graph_risk_score(s)).withColumn("identity_score", identity_score())
    s = s.withColumn("_sig", top_signal_array())
    if geo is not None:
        s = s.join(geo, "mmsi", "left").withColumn(
            "behavioral_deviation_score", F.col("behavioral_deviation_score") * F.coalesce("geo_weight", F.lit(1.0))
        ).drop("geo_weight")
    s = s.withColumn("confidence", _clip01(
        w_anomaly * F.col("behavioral_deviation_score") + w_graph * F.col("graph_risk_score")
        + w_identity * F.col("identity_score")))
    s = s.withColumn("vessel_type", ship_type_label(F.col("ship_type")))
    sig_json = F.to_json(F.col("_sig"))
    if floor is not None:
        s = s.join(floor, "mmsi", "left")
        lifted = F.coalesce(F.col("floor"), F.lit(0.0)) > 0
        s = s.withColumn("confidence", F.when(lifted, F.greatest("confidence", "floor")).otherwise(F.col("confidence")))
        entry = F.to_json(F.struct(F.lit("label_propagation").alias("feature"), F.col("floor_evidence").alias("evidence_type"),
                                   F.round("floor", 3).alias("value"), F.lit(1.0).alias("contribution")))
        sig_json = F.when(lifted, F.concat(F.lit("["), entry,
                                           F.when(F.size("_sig") > 0, F.lit(",")).otherwise(F.lit("")),
                                           F.expr("substring(to_json(_sig), 2)"))).otherwise(sig_json)
    s = s.withColumn("top_signals", sig_json)
    return s.select(*WATCHLIST_COLUMNS)


def watchlist_order(df: DataFrame) -> DataFrame:
    """M9 ordering: confidence desc with an mmsi tiebreak (range-partitioned global sort)."""
    return df.orderBy(F.col("confidence").desc(), F.col("mmsi"))


def best_candidates(df: DataFrame, keys=("mmsi", "imo"), score: str = "confidence") -> DataFrame:
    """Keep the highest-``score`` row per key; ties broken by the other columns (descending)."""
    others = [c for c in df.columns if c not in keys]
    rest = [c for c in others if c != score]
    best = df.groupBy(*keys).agg(
        F.max_by(F.struct(*others), F.struct(F.col(score), *[F.col(c) for c in rest])).alias("_b"))
    return best.select(*keys, "_b.*")
