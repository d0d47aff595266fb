"""Track-feature queries (F1-F8, G2, G12) and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..oracle import with_views
from ..operators import tracks
from ..sources.fixtures import Fixtures
from .registry import finish, register

AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"

# DuckDB pieces shared by the track oracles.
WIN_SQL = f"""
SELECT mmsi, timestamp, lat, lon, COALESCE(sog, 0.0) AS sog, COALESCE(nav_status, 0) AS nav_status
FROM ais_positions WHERE timestamp >= {AS_OF_SQL} - INTERVAL 60 DAY"""

LAGGED_SQL = """
SELECT *, lag(timestamp) OVER w AS prev_ts, lag(lat) OVER w AS prev_lat, lag(lon) OVER w AS prev_lon
FROM win WINDOW w AS (PARTITION BY mmsi ORDER BY timestamp)"""

GAPS_SQL = """
SELECT *, (epoch_us(timestamp) - epoch_us(prev_ts)) // 60000000 AS gap_min FROM lagged"""


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"(2 * 6371.0 * asin(sqrt(greatest(pow(sin(radians({lat2} - {lat1}) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2), 0.0))))"
    )


def cell_sql(lat: str = "lat", lon: str = "lon") -> str:
    row = f"floor(({lat} + 90.0) / 0.0064)"
    return (
        f"CAST(CAST({row} AS BIGINT) AS VARCHAR) || '_' || "
        f"CAST(CAST(floor(({lon} + 180.0) * cos(radians(-90.0 + ({row} + 0.5) * 0.0064)) / 0.0064) AS BIGINT) AS VARCHAR)"
    )


NEAR_EXIT_SQL = " OR ".join(
    f"{haversine_sql('prev_lat', 'prev_lon', repr(lat), repr(lon))} <= {C.CHOKEPOINT_EXIT_RADIUS_KM!r}"
    for lat, lon, _ in C.CHOKEPOINT_EXITS
)


def track_views(*extra: tuple[str, str], views: tuple[str, ...] = ()) -> str:
    return with_views("ais_positions", *views,
                      extra=[("win", WIN_SQL), ("lagged", LAGGED_SQL), ("gaps", GAPS_SQL), *extra])


def positions(spark, base):
    return tracks.position_window(Fixtures(spark, base).ais_positions)


@register(
    "gap_features",
    track_views()
    + """SELECT mmsi, CAST(count(*) AS BIGINT) AS ais_gap_count_30d, round(max(gap_min) / 60.0, 6) AS ais_gap_max_hours
FROM gaps WHERE gap_min > 600 GROUP BY mmsi""",
)
def q_gap_features(spark, base):
    return finish(tracks.gap_features(positions(spark, base)))


@register(
    "position_jumps",
    track_views(
        ("d", """SELECT *, (epoch_us(timestamp) - epoch_us(prev_ts)) / 1000000 / 3600.0 AS delta_h FROM lagged
                 WHERE prev_ts IS NOT NULL AND prev_lat IS NOT NULL AND prev_lon IS NOT NULL""")
    )
    + f"""SELECT mmsi, CAST(count(*) AS BIGINT) AS position_jump_count FROM d
WHERE delta_h > 0 AND delta_h <= 1.0 AND {haversine_sql('lat', 'lon', 'prev_lat', 'prev_lon')} / 1.852 / delta_h > 50.0
GROUP BY mmsi""",
)
def q_position_jumps(spark, base):
    return finish(tracks.position_jumps(positions(spark, base)))


@register(
    "loitering",
    track_views(
        ("slow", "SELECT mmsi, timestamp FROM win WHERE sog < 2.0 AND nav_status <> 5"),
        ("sl", """SELECT mmsi, (epoch_us(timestamp) - epoch_us(lag(timestamp) OVER (PARTITION BY mmsi ORDER BY timestamp))) // 60000000 AS delta_min FROM slow"""),
    )
    + """SELECT mmsi, round(sum(delta_min) / 60.0, 6) AS loitering_hours_30d FROM sl
WHERE delta_min IS NOT NULL AND delta_min <= 60 GROUP BY mmsi""",
)
def q_loitering(spark, base):
    return finish(tracks.loitering(positions(spark, base)))


@register(
    "port_call_ratio",
    track_views()
    + """SELECT mmsi, round(count(*) FILTER (WHERE nav_status = 5) / CAST(count(*) AS DOUBLE), 6) AS port_call_ratio
FROM win WHERE nav_status IN (1, 5) GROUP BY mmsi""",
)
def q_port_call_ratio(spark, base):
    return finish(tracks.port_call_ratio(positions(spark, base)))


STS_BUCKETS_SQL = f"""SELECT mmsi, {cell_sql()} AS cell, epoch_us(timestamp) // 1800000000 AS bucket, nav_status FROM win
WHERE lat IS NOT NULL AND lon IS NOT NULL AND mmsi IS NOT NULL"""


@register(
    "sts_candidates",
    track_views(
        ("cb", STS_BUCKETS_SQL),
        ("stopped", "SELECT * FROM cb WHERE nav_status IN (0, 1, 3, 5)"),
        ("multi", "SELECT cell, bucket FROM stopped GROUP BY cell, bucket HAVING count(DISTINCT mmsi) >= 2"),
    )
    + """SELECT s.mmsi, CAST(count(*) AS BIGINT) AS sts_candidate_count
FROM stopped s JOIN multi m ON s.cell = m.cell AND s.bucket = m.bucket GROUP BY s.mmsi""",
)
def q_sts_candidates(spark, base):
    return finish(tracks.sts_candidates(positions(spark, base)))


STS_CONTACTS_SQL = """SELECT a.mmsi AS src_id, b.mmsi AS dst_id FROM cb a JOIN cb b
ON a.cell = b.cell AND a.bucket = b.bucket AND a.mmsi < b.mmsi
GROUP BY a.mmsi, b.mmsi HAVING count(*) >= 2"""


@register("sts_contacts", track_views(("cb", STS_BUCKETS_SQL)) + STS_CONTACTS_SQL)
def q_sts_contacts(spark, base):
    return tracks.sts_contacts(positions(spark, base))


@register(
    "sts_hub_degree",
    track_views(("cb", STS_BUCKETS_SQL), ("sts", STS_CONTACTS_SQL))
    + """SELECT mmsi, CAST(count(DISTINCT partner) AS BIGINT) AS sts_hub_degree FROM (
  SELECT src_id AS mmsi, dst_id AS partner FROM sts UNION ALL SELECT dst_id, src_id FROM sts) GROUP BY mmsi""",
)
def q_sts_hub_degree(spark, base):
    return finish(tracks.sts_hub_degree(tracks.sts_contacts(positions(spark, base), degrees=True)))


@register(
    "chokepoint_gaps",
    track_views()
    + f"""SELECT mmsi, CAST(count(*) FILTER (WHERE {NEAR_EXIT_SQL}) AS BIGINT) AS chokepoint_exit_gap_count
FROM gaps WHERE gap_min > 600 AND prev_lat IS NOT NULL AND prev_lon IS NOT NULL GROUP BY mmsi""",
)
def q_chokepoint_gaps(spark, base):
    return finish(tracks.chokepoint_exit_gaps(positions(spark, base)))


PRE_GAP_SQL = track_views(
    ("g", """SELECT mmsi, epoch_us(timestamp) AS gap_us, epoch_us(timestamp) - gap_min * 60000000 AS onset_us
             FROM gaps WHERE gap_min > 600"""),
    ("iv", """SELECT mmsi, epoch_us(timestamp) AS t_us, epoch_us(prev_ts) AS p_us FROM lagged WHERE prev_ts IS NOT NULL"""),
    ("pg", """SELECT g.mmsi, g.gap_us, count(*) AS m, avg(CAST(t_us - p_us AS DOUBLE)) AS mean_iv,
                     stddev_pop(CAST(t_us - p_us AS DOUBLE)) AS std_iv
              FROM g JOIN iv ON iv.mmsi = g.mmsi AND iv.p_us >= g.onset_us - 21600000000 AND iv.t_us <= g.onset_us
              GROUP BY g.mmsi, g.gap_us"""),
) + """SELECT mmsi, round(avg(std_iv / mean_iv), 6) AS ais_pre_gap_regularity FROM pg
WHERE m >= 2 AND mean_iv <> 0 GROUP BY mmsi"""


@register("pre_gap_regularity", PRE_GAP_SQL)
def q_pre_gap_regularity(spark, base):
    return finish(tracks.pre_gap_regularity(positions(spark, base)))


@register("ais_features")
def q_ais_features(spark, base):
    return finish(tracks.ais_features(positions(spark, base)))
