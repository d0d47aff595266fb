"""Sensor-fusion queries (F9, F10) and their oracle SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..operators import fusion, tracks
from ..sources.fixtures import Fixtures
from .registry import finish, register
from .track_queries import AS_OF_SQL, haversine_sql, track_views


def detection_window(det: DataFrame, as_of: dt.datetime = C.FIXTURE_AS_OF, window_days: int = C.DEFAULT_WINDOW_DAYS) -> DataFrame:
    """S19 for detections: ``detected_at >= as_of - window_days``."""
    cutoff = F.lit(as_of).cast("timestamp") - F.make_dt_interval(days=F.lit(window_days))
    return det.where(F.col("detected_at") >= cutoff)


DET_WIN_SQL = f"SELECT detection_id, detected_at, lat, lon FROM detections WHERE detected_at >= {AS_OF_SQL} - INTERVAL 60 DAY"

SAR_SQL = track_views(
    ("det", DET_WIN_SQL),
    ("matched_sar", f"""SELECT DISTINCT s.detection_id FROM det s JOIN win a ON (
        abs(a.lat - s.lat) <= {5.0 / 111.0!r} AND abs(a.lon - s.lon) <= {5.0 / 78.0 * 2!r}
        AND abs(epoch(a.timestamp) - epoch(s.detected_at)) <= 3600
        AND {haversine_sql('s.lat', 's.lon', 'a.lat', 'a.lon')} <= 5.0)"""),
    ("unmatched_sar", "SELECT * FROM det WHERE detection_id NOT IN (SELECT detection_id FROM matched_sar)"),
    ("ais_gaps", """SELECT mmsi, timestamp AS gap_start, lead(timestamp) OVER (PARTITION BY mmsi ORDER BY timestamp) AS gap_end,
        lat AS last_lat, lon AS last_lon FROM win QUALIFY epoch(gap_end) - epoch(gap_start) > 36000"""),
    views=("detections",),
) + f"""SELECT g.mmsi, CAST(count(DISTINCT u.detection_id) AS BIGINT) AS unmatched_sar_detections_30d
FROM unmatched_sar u JOIN ais_gaps g ON (u.detected_at >= g.gap_start AND u.detected_at <= g.gap_end
  AND abs(u.lat - g.last_lat) <= {50.0 / 111.0!r} AND abs(u.lon - g.last_lon) <= {50.0 / 78.0 * 2!r}
  AND {haversine_sql('g.last_lat', 'g.last_lon', 'u.lat', 'u.lon')} <= 50.0)
GROUP BY g.mmsi"""

EO_SQL = track_views(
    ("eo", DET_WIN_SQL),
    ("matched_eo", """SELECT DISTINCT e.detection_id, a.mmsi FROM eo e JOIN win a ON (
        abs(a.lat - e.lat) <= 0.1 AND abs(a.lon - e.lon) <= 0.1 AND abs(epoch(a.timestamp) - epoch(e.detected_at)) <= 7200)"""),
    ("unmatched_eo", "SELECT * FROM eo WHERE detection_id NOT IN (SELECT detection_id FROM matched_eo)"),
    ("ais_gaps", """SELECT mmsi, timestamp AS gap_start, lead(timestamp) OVER (PARTITION BY mmsi ORDER BY timestamp) AS gap_end,
        lat AS last_lat, lon AS last_lon FROM win QUALIFY epoch(gap_end) - epoch(gap_start) > 21600"""),
    ("attributed_dark", """SELECT DISTINCT g.mmsi, u.detection_id FROM unmatched_eo u JOIN ais_gaps g ON (
        u.detected_at >= g.gap_start AND u.detected_at <= g.gap_end
        AND abs(u.lat - g.last_lat) <= 0.5 AND abs(u.lon - g.last_lon) <= 0.5)"""),
    ("all_attributed", """SELECT mmsi, detection_id, 1 AS is_dark FROM attributed_dark
        UNION SELECT mmsi, detection_id, 0 AS is_dark FROM matched_eo"""),
    views=("detections",),
) + """SELECT mmsi, CAST(sum(is_dark) AS BIGINT) AS eo_dark_count_30d,
       round(sum(is_dark) / CAST(count(*) AS DOUBLE), 6) AS eo_ais_mismatch_ratio
FROM all_attributed GROUP BY mmsi"""


def _inputs(spark, base):
    fx = Fixtures(spark, base)
    return detection_window(fx.detections), tracks.position_window(fx.ais_positions)


@register("sar_unmatched", SAR_SQL)
def q_sar_unmatched(spark, base):
    det, pos = _inputs(spark, base)
    return finish(fusion.unmatched_sar_detections(det, pos))


@register("eo_fusion", EO_SQL)
def q_eo_fusion(spark, base):
    det, pos = _inputs(spark, base)
    return finish(fusion.eo_features(det, pos))
