"""Geospatial column expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C

# Grid used for co-location (G1): ~0.7 km square cells, equal-area-ish in
# longitude by scaling with the cosine of the row's centre latitude.
CELL_DEG = 0.0064


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else (x if isinstance(x, Column) else F.lit(x))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km, R = 6371, square-root argument clamped."""
    lat1, lon1, lat2, lon2 = _c(lat1), _c(lon1), _c(lat2), _c(lon2)
    dlat = F.radians(lat2 - lat1)
    dlon = F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return 2 * F.lit(C.EARTH_RADIUS_KM) * F.asin(F.sqrt(F.greatest(a, F.lit(0.0))))


def cell_id(lat="lat", lon="lon", cell_deg: float = CELL_DEG) -> Column:
    """Native replacement for an H3 res-8 cell: 'row_col' of a ~0.7 km grid."""
    lat, lon = _c(lat), _c(lon)
    row = F.floor((lat + 90.0) / cell_deg)
    centre = F.radians(F.lit(-90.0) + (row + 0.5) * cell_deg)
    col = F.floor((lon + 180.0) * F.cos(centre) / cell_deg)
    return F.concat(row.cast("string"), F.lit("_"), col.cast("string"))


def time_bucket(ts="timestamp", minutes: int = 30) -> Column:
    """Integer id of the ``minutes``-wide tumbling bucket holding ``ts``."""
    return F.floor(F.unix_micros(_c(ts)) / F.lit(minutes * 60 * 1_000_000)).cast("long")


def in_bbox(lat, lon, bbox) -> Column:
    """Inclusive bounding box (lat_min, lat_max, lon_min, lon_max)."""
    lat_min, lat_max, lon_min, lon_max = bbox
    return _c(lat).between(lat_min, lat_max) & _c(lon).between(lon_min, lon_max)


def near_chokepoint_exit(lat, lon, radius_km: float = C.CHOKEPOINT_EXIT_RADIUS_KM) -> Column:
    """True when (lat, lon) lies within ``radius_km`` of any chokepoint exit."""
    cond = F.lit(False)
    for clat, clon, _ in C.CHOKEPOINT_EXITS:
        cond = cond | (haversine_km(lat, lon, F.lit(clat), F.lit(clon)) <= radius_km)
    return cond


def corridor_id(lat, lon) -> Column:
    """First matching corridor box (1..6), 99 elsewhere, 0 when unknown."""
    lat, lon = _c(lat), _c(lon)
    expr = F.when(lat.isNull() | lon.isNull(), F.lit(0))
    for cid, a, b, c, d in C.CORRIDORS:
        expr = expr.when(lat.between(a, b) & lon.between(c, d), F.lit(cid))
    return expr.otherwise(F.lit(99))


def minutes_between(later, earlier) -> Column:
    """Whole minutes from ``earlier`` to ``later``, truncated toward zero."""
    diff = F.unix_micros(_c(later)) - F.unix_micros(_c(earlier))
    return F.when(diff >= 0, F.floor(diff / F.lit(60_000_000))).otherwise(F.ceil(diff / F.lit(60_000_000))).cast("long")
