"""Counts of points in boxes, without forming a row a pair.

A request belongs to a group (a vessel, a detection) and asks for the points near a place within a
time span. ``covered_counts`` gives, for each group, how many points lie in at least one of its
requests. Points are dealt to bins of place and day, requests to the bins that they reach, so
every (group, point) pair meets in one bin and counts add up. Bins of more than ``MOST`` rows are cut further,
requests by group and points by row; no task holds more of either than that, but for the requests of one group in a bin.

Within a bin, points lie in cells of about equal counts, sorted by time. A cell whose own bounds lie within a
request counts by two binary searches, spans of a group are merged first; only cells that a request
cuts are looked at point by point.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..session import cut_lineage

DAY_US = 86_400_000_000
MOST = 200_000
CELL_POINTS = 512
MOST_STRIPS = 16
PAIRS = 1 << 21
_SAFETY = 1.0001  # as in ``rangejoin``


def _km(lat1, lon1, lat2, lon2):
    """``geo.haversine_km`` on arrays."""
    dlat, dlon = np.radians(lat2 - lat1), np.radians(lon2 - lon1)
    a = np.power(np.sin(dlat / 2), 2) + np.cos(np.radians(lat1)) * np.cos(np.radians(lat2)) * np.power(np.sin(dlon / 2), 2)
    return 2 * C.EARTH_RADIUS_KM * np.arcsin(np.sqrt(np.maximum(a, 0.0)))


def _cells(lat: np.ndarray, lon: np.ndarray) -> list[np.ndarray]:
    """The points' indices in strips of latitude, each cut by longitude, of about equal counts."""
    strips = max(1, min(MOST_STRIPS, int((len(lat) / CELL_POINTS) ** 0.5)))
    out = []
    for strip in np.array_split(np.argsort(lat, kind="stable"), strips):
        out += np.array_split(strip[np.argsort(lon[strip], kind="stable")], strips)
    return [c for c in out if len(c)]


def _in_union(group: np.ndarray, lo: np.ndarray, hi: np.ndarray, t: np.ndarray) -> np.ndarray:
    """For each span, the number of sorted times in it that no earlier span of its group holds; spans are in order of (group, lo)."""
    first, end = np.searchsorted(t, lo, "left"), np.searchsorted(t, hi, "right")
    step = len(t) + 1
    reached = np.maximum.accumulate(group * step + end)  # groups rise, so a group starts over by itself
    before = np.concatenate([[0], reached[:-1]]) - group * step
    return np.maximum(end - np.maximum(first, before), 0)


def _one_by_one(group, lat, lon, lo, hi, p_lat, p_lon, p_t, lat_tol, lon_tol, km, found) -> None:
    """Adds the number of distinct points in the requests of each group to ``found``; requests are in order of group."""
    first, end = np.searchsorted(p_t, lo, "left"), np.searchsorted(p_t, hi, "right")
    n = np.maximum(end - first, 0)
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sums = np.add.reduceat(n, starts)
    piece = np.repeat((np.cumsum(sums) - sums) // PAIRS, np.diff(np.append(starts, len(group))))  # whole groups a piece
    for at in np.unique(piece):
        own = np.flatnonzero((piece == at) & (n > 0))
        r = np.repeat(own, n[own])
        p = np.arange(len(r)) - np.repeat(np.cumsum(n[own]) - n[own], n[own]) + np.repeat(first[own], n[own])
        near = (np.abs(p_lat[p] - lat[r]) <= lat_tol) & (np.abs(p_lon[p] - lon[r]) <= lon_tol)
        r, p = r[near], p[near]
        if km is not None:
            near = _km(lat[r], lon[r], p_lat[p], p_lon[p]) <= km
            r, p = r[near], p[near]
        pairs = np.unique(group[r].astype(np.int64) * len(p_t) + p)
        np.add.at(found, pairs // len(p_t), 1)


def count_points(points: pd.DataFrame, requests: pd.DataFrame, lat_tol: float, lon_tol: float, km: float | None) -> pd.DataFrame:
    """(grp, n) of the groups of ``requests`` (grp, lat, lon, lo, hi) with points (lat, lon, lo) in them."""
    codes, names = pd.factorize(requests["grp"])
    order = np.lexsort((requests["lo"].to_numpy(), codes))
    group = codes[order].astype(np.int64)
    lat, lon, lo, hi = (requests[c].to_numpy()[order] for c in ("lat", "lon", "lo", "hi"))
    p_lat, p_lon, p_t = (points[c].to_numpy() for c in ("lat", "lon", "lo"))
    found = np.zeros(len(names), dtype=np.int64)
    for cell in _cells(p_lat, p_lon):
        cell = cell[np.argsort(p_t[cell], kind="stable")]
        c_lat, c_lon, c_t = p_lat[cell], p_lon[cell], p_t[cell]
        south, north, west, east = c_lat.min(), c_lat.max(), c_lon.min(), c_lon.max()
        out = (south - lat > lat_tol) | (lat - north > lat_tol) | (west - lon > lon_tol) | (lon - east > lon_tol)
        i = np.flatnonzero(~out & (hi >= c_t[0]) & (lo <= c_t[-1]))
        if not len(i):
            continue
        a, b = lat[i], lon[i]
        whole = (np.abs(south - a) <= lat_tol) & (np.abs(north - a) <= lat_tol) & (np.abs(west - b) <= lon_tol) & (np.abs(east - b) <= lon_tol)
        if km is not None:
            corners = np.stack([_km(a, b, y, x) for y in (south, north) for x in (west, east)])
            one_place = south == north and west == east
            # A point of the cell is at most this far from each corner.
            wide = 0.0 if one_place else C.EARTH_RADIUS_KM * (np.radians(north - south) + np.radians(east - west)) * _SAFETY
            whole &= (corners <= (km if one_place else km / _SAFETY)).all(axis=0)
            reached = ~(corners.max(axis=0) > km + wide)
            i, whole = i[reached], whole[reached]
        if not len(i):
            continue
        cut = np.zeros(len(names), dtype=bool)
        cut[group[i[~whole]]] = True
        by_span, by_point = i[~cut[group[i]]], i[cut[group[i]]]
        if len(by_span):
            np.add.at(found, group[by_span], _in_union(group[by_span], lo[by_span], hi[by_span], c_t))
        if len(by_point):
            _one_by_one(group[by_point], lat[by_point], lon[by_point], lo[by_point], hi[by_point], c_lat, c_lon, c_t, lat_tol, lon_tol, km, found)
    some = np.flatnonzero(found)
    return pd.DataFrame({"grp": np.asarray(names, dtype=object)[some], "n": found[some]})


def covered_counts(points: DataFrame, requests: DataFrame, lat_tol: float, lon_tol: float, km: float | None = None, most: int = MOST) -> DataFrame:
    """(grp, n): distinct rows of ``points`` (lat, lon, t) in at least one of a group's ``requests`` (grp, lat, lon, lo, hi).

    Times are microseconds; spans are closed. Rows with nulls match nothing; a null ``grp`` is left out.
    """
    def bins(x: str, tol: float, reach: float) -> tuple[Column, Column]:
        w = 2 * tol * _SAFETY
        return tuple(F.floor((F.col(x) + F.lit(s * reach * tol * _SAFETY)) / F.lit(w)).cast("long") for s in (-1, 1))

    def day(t: str) -> Column:
        return F.floor(F.col(t) / F.lit(DAY_US)).cast("long")

    keys = ["d", "y", "x"]
    p = points.where("lat is not null and lon is not null and t is not null").select(
        day("t").alias("d"), bins("lat", lat_tol, 0)[0].alias("y"), bins("lon", lon_tol, 0)[0].alias("x"), F.lit("").alias("grp"),
        F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"), F.col("t").alias("lo"), F.col("t").alias("hi"))
    r = requests.where("grp is not null and lat is not null and lon is not null and lo <= hi")
    r = r.withColumn("d", F.explode(F.sequence(day("lo"), day("hi"))))
    r = r.withColumn("y", F.explode(F.sequence(*bins("lat", lat_tol, 1)))).withColumn("x", F.explode(F.sequence(*bins("lon", lon_tol, 1))))
    r = r.select(*keys, "grp", F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"), "lo", "hi")
    # One slim row a bin, written: with it inside, the plan would hold points and requests four times, and so would each plan on top.
    sizes = cut_lineage(p.groupBy(*keys).agg(F.ceil(F.count("*") / F.lit(most)).alias("ps")).join(
        r.groupBy(*keys).agg(F.ceil(F.count("*") / F.lit(most)).alias("rs")), keys))

    def slices(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    p = p.join(sizes, keys).withColumn("ps", F.pmod(F.xxhash64("lat", "lon", "lo"), F.col("ps"))).withColumn("rs", slices("rs"))
    r = r.join(sizes, keys).withColumn("rs", F.pmod(F.xxhash64("grp"), F.col("rs"))).withColumn("ps", slices("ps"))

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        is_point = pdf["is_point"].to_numpy()
        return count_points(pdf[is_point], pdf[~is_point], lat_tol, lon_tol, km)

    both = p.withColumn("is_point", F.lit(True)).unionByName(r.withColumn("is_point", F.lit(False)))
    counts = both.groupBy(*keys, "ps", "rs").applyInPandas(count, "grp string, n long")
    return counts.groupBy("grp").agg(F.sum("n").alias("n"))
