"""Source coverage (E8, J15): where a ranked list has the vessels that a source names as positive.

``ranked``: window_id (not null), mmsi, imo, confidence; ``labels``: window_id, mmsi, imo, label. A label finds the best row
of its mmsi, else of its imo: two equi-joins with one row per key. ``place`` is the row's exact
place (confidence down, then mmsi) if it is within the largest capacity, ``rank`` one more than the rows of higher
confidence, from prefix sums over distinct scores; neither needs a window in one task.

Defined results: blank and null ids match nothing; a row without a confidence (null or NaN) can be matched but has no rank and comes
last; repeated labels count each; a window without positives has zeros; no rows at all give no windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import exclusive_prefix_sums, top_k_per_group
from .evaluate import DEFAULT_CAPACITIES, POSITIVE_LABELS


def _id(c: str) -> Column:
    return F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))


def _best(rows: DataFrame, top: DataFrame, key: str) -> DataFrame:
    """(window_id, key, score, place) of the best row of each key."""
    score = rows.where(F.col(key).isNotNull()).groupBy("window_id", key).agg(F.max("confidence").alias(f"{key}_score"), F.lit(True).alias(f"{key}_hit"))
    place = top.where(F.col(key).isNotNull()).groupBy("window_id", key).agg(F.min("place").alias(f"{key}_place"))
    return score.join(place, ["window_id", key], "left")


def label_ranks(ranked: DataFrame, labels: DataFrame, capacities=DEFAULT_CAPACITIES) -> DataFrame:
    """(window_id, mmsi, imo, path, confidence, rank, place) of each positive label; null path and ranks if it is missed."""
    score = F.nanvl(F.col("confidence").cast("double"), F.lit(None).cast("double"))
    rows = ranked.select("window_id", _id("mmsi").alias("mmsi"), _id("imo").alias("imo"), score.alias("confidence"))
    top = top_k_per_group(rows, ["window_id"], [F.col("confidence").desc_nulls_last(), F.col("mmsi")], max(capacities), "place")
    counts = rows.where(F.col("confidence").isNotNull()).groupBy("window_id", F.col("confidence").alias("score")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    above = exclusive_prefix_sums(counts, "window_id", "score", ["n"], ascending=False).select(
        "window_id", F.col("score").alias("confidence"), (F.col("cum_n") + 1).cast("long").alias("rank"))
    positive = labels.where(F.lower(F.trim("label")).isin(*POSITIVE_LABELS)).select("window_id", _id("mmsi").alias("mmsi"), _id("imo").alias("imo"))
    found = positive.join(_best(rows, top, "mmsi"), ["window_id", "mmsi"], "left").join(_best(rows, top, "imo"), ["window_id", "imo"], "left")

    def of(c: str) -> Column:
        return F.when(F.col("mmsi_hit"), F.col(f"mmsi_{c}")).otherwise(F.col(f"imo_{c}"))

    path = F.when(F.col("mmsi_hit"), "mmsi").when(F.col("imo_hit"), "imo")
    hit = found.select("window_id", "mmsi", "imo", path.alias("path"), of("score").alias("confidence"), of("place").alias("place"))
    return hit.join(above, ["window_id", "confidence"], "left").select("window_id", "mmsi", "imo", "path", "confidence", "rank", "place")


def source_coverage(ranked: DataFrame, labels: DataFrame, capacities=DEFAULT_CAPACITIES) -> DataFrame:
    """Per window and review capacity the positives found within it, beside matched, missed and overall recall."""
    hits = [F.count(F.when(F.col("place") <= k, 1)).alias(f"hits_{k}") for k in capacities]
    per = label_ranks(ranked, labels, capacities).groupBy("window_id").agg(F.count(F.lit(1)).alias("total"), F.count("path").alias("matched"), *hits)
    windows = ranked.select("window_id").unionByName(labels.select("window_id")).distinct()
    per = windows.join(per, "window_id", "left").na.fill(0)
    stack = ", ".join(f"{k}, hits_{k}" for k in capacities)
    rows = per.selectExpr("window_id", "total", "matched", f"stack({len(capacities)}, {stack}) AS (review_capacity, hits)")

    def share(c: str) -> Column:
        return F.when(F.col("total") > 0, F.col(c) / F.col("total")).otherwise(0.0)

    return rows.select(
        "window_id", "review_capacity", "hits", share("hits").alias("recall"), F.col("total").alias("source_positive_total"),
        F.col("matched").alias("matched_total"), (F.col("total") - F.col("matched")).alias("missed_total"), share("matched").alias("source_recall"))
