"""Holdout evaluation against analysts' pre-labels (E11, E12, S18, V6), all windows in one frame.

A window is (window_id, end, region, min_tier): only labels dated at its end or before may be
used. The cutoff comes before the choice of a vessel's latest label, so a later label can
neither enter a window nor hide an earlier one; what the cutoff takes out is counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import top_k_per_group
from .evaluate import topk_metrics

# FIXED VALUES: label names and ranks of the tiers.
SUSPECT, CLEARED, UNCERTAIN = "suspected-positive", "analyst-negative", "uncertain"
TIERS = ("weak", "medium", "high")


def tier_rank(tier: Column) -> Column:
    """V6: weak 1, medium 2, high 3, any other 0."""
    t = F.lower(F.trim(tier))
    return F.coalesce(*[F.when(t == name, F.lit(i)) for i, name in enumerate(TIERS, 1)], F.lit(0))


def tidy(prelabels: DataFrame) -> DataFrame:
    """Trimmed ids, lower-case labels, tiers and regions, typed times."""
    low = lambda c: F.lower(F.trim(F.col(c).cast("string"))).alias(c)
    return prelabels.select(
        F.trim(F.col("mmsi").cast("string")).alias("mmsi"), low("pre_label"), low("confidence_tier"), low("region"),
        F.col("evidence_timestamp").try_cast("timestamp").alias("evidence_timestamp"))


def read_prelabels(spark, path: str) -> DataFrame:
    """An analysts' CSV; columns that it lacks are null."""
    raw = spark.read.option("header", True).csv(path)
    names = ("mmsi", "pre_label", "confidence_tier", "region", "evidence_timestamp")
    return tidy(raw.select(*[F.col(f"`{c}`") if c in raw.columns else F.lit(None).cast("string").alias(c) for c in names]))


def usable(prelabels: DataFrame, windows: DataFrame) -> DataFrame:
    """(window_id, mmsi, pre_label, confidence_tier) : each window's latest label of a vessel. ``windows`` is a broadcast configuration.

    Ties in time go to the higher tier, then the label's name.
    """
    w = windows.select("window_id", "end", F.lower("region").alias("w_region"), tier_rank(F.col("min_tier")).alias("least"))
    both = prelabels.join(F.broadcast(w), F.col("evidence_timestamp") <= F.col("end"))
    kept = both.where((F.col("w_region").isNull() | (F.col("region") == F.col("w_region"))) & (tier_rank(F.col("confidence_tier")) >= F.greatest("least", F.lit(1))))
    last = F.max(F.struct("evidence_timestamp", tier_rank(F.col("confidence_tier")).alias("rank"), "pre_label", "confidence_tier")).alias("x")
    return kept.groupBy("window_id", "mmsi").agg(last).select("window_id", "mmsi", "x.pre_label", "x.confidence_tier")


def leaked(prelabels: DataFrame, windows: DataFrame) -> DataFrame:
    """(window_id, n_leaked): labels after the window's end, or without a time."""
    late = F.col("evidence_timestamp").isNull() | (F.col("evidence_timestamp") > F.col("end"))
    w = windows.select("window_id", "end")
    n = prelabels.join(F.broadcast(w), late).groupBy("window_id").agg(F.count("*").alias("n"))
    return w.select("window_id").join(n, "window_id", "left").select("window_id", F.coalesce("n", F.lit(0)).alias("n_leaked"))


def label_windows(watchlist: DataFrame, labels: DataFrame) -> DataFrame:
    """The windows' watchlists (window_id, mmsi, confidence, ..) with ``pre_label``, ``confidence_tier`` and ``y_true`` (null: not decided)."""
    ranked = watchlist.withColumn("mmsi", F.trim(F.col("mmsi").cast("string"))).join(labels, ["window_id", "mmsi"], "left")
    y = F.when(F.col("pre_label") == SUSPECT, 1).when(F.col("pre_label") == CLEARED, 0)
    return ranked.withColumn("y_true", y).fillna({"pre_label": UNCERTAIN, "confidence_tier": "unknown"})


def evaluate(watchlist: DataFrame, prelabels: DataFrame, windows: DataFrame) -> DataFrame:
    """A row a window with the ranking metrics over decided rows, the tiers' counts and the leaked labels."""
    labelled = label_windows(watchlist, usable(prelabels, windows))
    metrics = topk_metrics(labelled)
    decided = F.col("y_true").isNotNull()
    tiers = labelled.groupBy("window_id").agg(
        *[F.count(F.when(decided & (F.col("confidence_tier") == t), 1)).alias(f"n_{t}") for t in TIERS],
        *[F.count(F.when((F.col("y_true") == 1) & (F.col("confidence_tier") == t), 1)).alias(f"positive_{t}") for t in TIERS])
    return metrics.join(tiers, "window_id").join(leaked(prelabels, windows), "window_id", "left")


def disagreements(labelled: DataFrame, threshold: float, most: int = 20) -> DataFrame:
    """Each window's first ``most`` cleared vessels at or above the threshold, and suspected ones below it, worst first."""
    high = labelled.where((F.col("confidence") >= threshold) & (F.col("y_true") == 0)).withColumn("kind", F.lit("model_high_analyst_negative"))
    low = labelled.where((F.col("confidence") < threshold) & (F.col("y_true") == 1)).withColumn("kind", F.lit("model_low_analyst_positive"))
    out = [top_k_per_group(f, ["window_id"], [o, F.col("mmsi")], most) for f, o in ((high, F.col("confidence").desc()), (low, F.col("confidence").asc()))]
    return out[0].unionByName(out[1]).select("window_id", "kind", "rk", "mmsi", "confidence", "pre_label", "confidence_tier")
