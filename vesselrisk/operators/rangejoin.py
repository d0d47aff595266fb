"""Grid-bucketed band join.

Catalyst plans a join on ``abs(a.x - b.x) <= d AND ...`` as a nested loop. Here
both sides are binned with bin width >= tolerance on every banded dimension;
the probe side (the smaller one, e.g. detections) is replicated to its
neighbouring bins (3 per dimension) and the sides are equi-joined on the bin
ids, then the exact predicate is applied. Because the bin is never narrower
than the tolerance, no qualifying pair is lost; each pair meets in exactly one
bin combination, so no duplicates are produced.

Skew: a hot bin (a port) is handled by AQE's skew-join splitting; broadcast is
left to AQE's runtime size check (``autoBroadcastJoinThreshold``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bins are made slightly wider than the tolerance so float rounding in x / w
# can never put two qualifying values two bins apart.
_SAFETY = 1.0001


@dataclass(frozen=True)
class Band:
    """One banded dimension: probe expr, build expr and tolerance (same units)."""

    probe: Column
    build: Column
    tolerance: float


def _bin(x: Column, width: float) -> Column:
    return F.floor(x / F.lit(width)).cast("long")


def band_join(
    probe: DataFrame,
    build: DataFrame,
    bands: list[Band],
    condition: Column,
    how: str = "inner",
    extra_keys: list[str] | None = None,
) -> DataFrame:
    """Join ``probe`` and ``build`` where every band holds and ``condition`` is true.

    ``condition`` must reference columns of the two inputs by distinct names.
    ``extra_keys`` are plain equi-join columns present on both sides.
    """
    p = probe
    b = build
    keys = list(extra_keys or [])
    for i, band in enumerate(bands):
        w = band.tolerance * _SAFETY
        name = f"_band{i}"
        p = p.withColumn(name, F.explode(F.sequence(_bin(band.probe, w) - 1, _bin(band.probe, w) + 1)))
        b = b.withColumn(name, _bin(band.build, w))
        keys.append(name)
    joined = p.alias("p").join(b.alias("b"), keys, how)
    joined = joined.where(condition) if how in ("inner",) else joined
    return joined.drop(*[k for k in keys if k.startswith("_band")])


def band_semi(
    probe: DataFrame,
    build: DataFrame,
    bands: list[Band],
    condition: Column,
    probe_key: str,
) -> DataFrame:
    """Distinct ``probe_key`` values of probe rows with at least one band match."""
    p = probe
    b = build
    keys = []
    for i, band in enumerate(bands):
        w = band.tolerance * _SAFETY
        name = f"_band{i}"
        p = p.withColumn(name, F.explode(F.sequence(_bin(band.probe, w) - 1, _bin(band.probe, w) + 1)))
        b = b.withColumn(name, _bin(band.build, w))
        keys.append(name)
    cond = condition
    for k in keys:
        cond = cond & (F.col(f"p.{k}") == F.col(f"b.{k}"))
    return p.alias("p").join(b.alias("b"), cond, "left_semi").select(probe_key).distinct()
