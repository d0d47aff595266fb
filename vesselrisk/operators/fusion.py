"""Sensor fusion: SAR (F9) and EO (F10) detections against AIS tracks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import geo
from ..session import cut_lineage
from .coverage_counts import covered_counts
from .rangejoin import Band, band_join
from .tracks import lagged_fixes

US = 1_000_000
DAY_US = 86_400 * US


def ais_gap_intervals(positions: DataFrame, gap_threshold_h: float) -> DataFrame:
    """Gap intervals: (mmsi, gap_start, gap_end, last_lat, last_lon) with gap > threshold (exact)."""
    p = lagged_fixes(positions)
    return p.where(
        (F.unix_micros("timestamp") - F.unix_micros("prev_timestamp")) > F.lit(int(gap_threshold_h * 3600 * US))
    ).select(
        "mmsi",
        F.col("prev_timestamp").alias("gap_start"),
        F.col("timestamp").alias("gap_end"),
        F.col("prev_lat").alias("last_lat"),
        F.col("prev_lon").alias("last_lon"),
    )


def _around(fixes: DataFrame, minutes: int, key: str, ts: str) -> DataFrame:
    """Requests (grp, lat, lon, lo, hi) for what lies within ``minutes`` of a row's time."""
    t, w = F.unix_micros(ts), F.lit(minutes * 60 * US)
    return fixes.select(F.col(key).alias("grp"), "lat", "lon", (t - w).alias("lo"), (t + w).alias("hi"))


def _in_gaps(gaps: DataFrame) -> DataFrame:
    """Requests for what lies near a gap's last fix while it lasts."""
    return gaps.select(F.col("mmsi").alias("grp"), F.col("last_lat").alias("lat"), F.col("last_lon").alias("lon"),
                       F.unix_micros("gap_start").alias("lo"), F.unix_micros("gap_end").alias("hi"))


def _points(rows: DataFrame, ts: str) -> DataFrame:
    return rows.select("lat", "lon", F.unix_micros(ts).alias("t"))


def _detections_per_group(detections: DataFrame, requests: DataFrame, lat_tol: float, lon_tol: float, km: float | None) -> DataFrame:
    """(mmsi, n): distinct detection ids in a vessel's requests. A null vessel is a group of its own.

    Ids at one place and time are points and only counted; the others (an id on several different rows)
    could count twice and are paired with the vessels.
    """
    # Nulls match nothing; vessels are marked so that a null one stays apart.
    valid = detections.select("detection_id", "lat", "lon", F.unix_micros("detected_at").alias("t")).dropna(subset=["lat", "lon", "t"])
    asked = requests.withColumn("grp", F.coalesce(F.concat(F.lit("="), "grp"), F.lit("")))
    at = ["lat", "lon", "t"]
    ids = cut_lineage(valid.groupBy("detection_id").agg(*[f(c).alias(f"{n}_{c}") for c in at for n, f in (("low", F.min), ("high", F.max))]))
    same = F.lit(True)
    for c in at:
        same = same & (F.col(f"low_{c}") == F.col(f"high_{c}"))
    counted = covered_counts(ids.where(same).select(*[F.col(f"low_{c}").alias(c) for c in at]), asked, lat_tol, lon_tol, km)
    several = ids.where(~same).select(F.col("detection_id").alias("_id"))
    p = valid.join(several, F.col("detection_id").eqNullSafe(F.col("_id")), "left_semi").withColumn("_day", F.floor(F.col("t") / F.lit(DAY_US)).cast("long"))
    days = F.sequence(*[F.floor(F.col(c) / F.lit(DAY_US)).cast("long") for c in ("lo", "hi")])
    b = asked.where("lo <= hi").withColumn("_day", F.explode(days))
    cond = (
        F.col("p.t").between(F.col("b.lo"), F.col("b.hi"))
        & (F.abs(F.col("p.lat") - F.col("b.lat")) <= lat_tol)
        & (F.abs(F.col("p.lon") - F.col("b.lon")) <= lon_tol)
    )
    if km is not None:
        cond = cond & (geo.haversine_km(F.col("b.lat"), F.col("b.lon"), F.col("p.lat"), F.col("p.lon")) <= km)
    pairs = band_join(p, b, [Band(F.col("lat"), F.col("lat"), lat_tol), Band(F.col("lon"), F.col("lon"), lon_tol)], cond, extra_keys=["_day"])
    paired = pairs.select(F.col("b.grp").alias("grp"), F.col("p.detection_id").alias("detection_id")).distinct().groupBy("grp").agg(F.count("*").alias("n"))
    total = counted.unionByName(paired).groupBy("grp").agg(F.sum("n").alias("n"))
    return total.select(F.when(F.col("grp") != "", F.expr("substring(grp, 2)")).alias("mmsi"), "n")


def unmatched_sar_detections(
    sar: DataFrame,
    positions: DataFrame,
    match_radius_km: float = C.SAR_MATCH_RADIUS_KM,
    match_window_min: int = C.SAR_MATCH_WINDOW_MIN,
    gap_threshold_h: float = C.GAP_THRESHOLD_H,
    attribution_radius_km: float = C.SAR_ATTRIBUTION_RADIUS_KM,
) -> DataFrame:
    """per vessel, distinct SAR detections with no AIS match that fall in its gap.

    matched = any fix within the box (km/111 lat, 2*km/78 lon), the time window
    and the haversine radius. Vessels with zero are omitted.
    """
    lat_m = match_radius_km / C.KM_PER_DEG_LAT
    lon_m = 2 * match_radius_km / C.KM_PER_DEG_LON_45
    sar = sar.where(F.col("detection_id").isNotNull()).select("detection_id", "detected_at", "lat", "lon")
    matched = covered_counts(_points(positions, "timestamp"), _around(sar, match_window_min, "detection_id", "detected_at"), lat_m, lon_m, match_radius_km)
    # Written, as the next step reads it several times over.
    unmatched = cut_lineage(sar.join(matched.select(F.col("grp").alias("detection_id")), "detection_id", "left_anti"))
    gaps = ais_gap_intervals(positions, gap_threshold_h)  # reuses prev_* when the caller passes lagged fixes
    lat_a = attribution_radius_km / C.KM_PER_DEG_LAT
    lon_a = 2 * attribution_radius_km / C.KM_PER_DEG_LON_45
    attributed = _detections_per_group(unmatched, _in_gaps(gaps), lat_a, lon_a, attribution_radius_km)
    return attributed.select("mmsi", F.col("n").alias("unmatched_sar_detections_30d"))


def eo_features(
    eo: DataFrame,
    positions: DataFrame,
    match_radius_deg: float = C.EO_MATCH_RADIUS_DEG,
    match_window_min: int = C.EO_MATCH_WINDOW_MIN,
    gap_threshold_h: float = C.EO_GAP_THRESHOLD_H,
    attribution_radius_deg: float = C.EO_ATTRIBUTION_RADIUS_DEG,
) -> DataFrame:
    """eo_dark_count_30d and eo_ais_mismatch_ratio per attributed vessel.

    matched pairs (detection, vessel) within a degree box and time window;
    unmatched detections are attributed to gaps (> 6 h) within 0.5 deg of the
    last fix; ratio = dark / (dark + matched) per vessel.
    """
    eo = eo.select("detection_id", "detected_at", "lat", "lon")
    r = match_radius_deg
    hit = covered_counts(_points(positions, "timestamp"), _around(eo, match_window_min, "detection_id", "detected_at"), r, r)
    unmatched = cut_lineage(eo.join(hit.select(F.col("grp").alias("detection_id")), "detection_id", "left_anti"))
    matched = _detections_per_group(eo, _around(positions, match_window_min, "mmsi", "timestamp"), r, r, None)
    gaps = ais_gap_intervals(positions, gap_threshold_h)  # reuses prev_* when the caller passes lagged fixes
    dark = _detections_per_group(unmatched, _in_gaps(gaps), attribution_radius_deg, attribution_radius_deg, None)
    # Dark pairs come from unmatched detections and matched pairs from matched
    # ones, so the two sets are disjoint by detection id.
    allp = dark.select("mmsi", F.col("n").alias("dark"), "n").unionByName(matched.select("mmsi", F.lit(0).cast("long").alias("dark"), "n"))
    return allp.groupBy("mmsi").agg(
        F.sum("dark").cast("long").alias("eo_dark_count_30d"),
        (F.sum("dark") / F.sum("n")).alias("eo_ais_mismatch_ratio"),
    )
