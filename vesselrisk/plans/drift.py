"""Drift monitoring (C11-C15): four checks, each a one-row alert DataFrame."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..operators.ordered import exclusive_prefix_sums
from ..operators.tracks import with_previous

MIN_SAMPLE = 5
FLAG_REFERENCE = 0.35
# FIXED VALUES: review tier -> score used by the score-shift check.
TIER_SCORE = {"confirmed": 0.95, "probable": 0.75, "suspect": 0.55, "cleared": 0.10}
TIER_DEFAULT = 0.30


def severity(rel: Column, warn: float, crit: float) -> Column:
    a = F.abs(rel)
    return F.when(a >= crit, "critical").when(a >= warn, "warning").otherwise("ok")


def make_alert(df: DataFrame, check: str, metric: str, current: Column, reference: Column,
               thresholds: tuple[float, float], sufficient: Column | None = None) -> DataFrame:
    """Alert row; rel = (cur - ref) / (|ref| + 1e-9); insufficient data -> ok with zeros."""
    warn, crit = thresholds
    ok = sufficient if sufficient is not None else F.lit(True)
    cur = F.when(ok, current).otherwise(0.0)
    ref = F.when(ok, reference).otherwise(0.0)
    rel = F.when(ok, (current - reference) / (F.abs(reference) + 1e-9)).otherwise(0.0)
    return df.select(
        F.lit(check).alias("check_name"), severity(rel, warn, crit).alias("severity"), F.lit(metric).alias("metric_name"),
        cur.cast("double").alias("current_value"), ref.cast("double").alias("reference_value"),
        rel.cast("double").alias("relative_change"),
        F.lit(warn).alias("threshold_warning"), F.lit(crit).alias("threshold_critical"))


def _ts(x: dt.datetime) -> Column:
    return F.lit(x).cast("timestamp")


def gap_rate_check(positions: DataFrame, as_of: dt.datetime = C.FIXTURE_AS_OF,
                   gap_threshold_h: float = C.CAUSAL_GAP_THRESHOLD_H) -> DataFrame:
    """C11: gaps / (vessels with gaps x days), recent 30 d vs 30-90 d (lag inside each window)."""
    recent_start = as_of - dt.timedelta(days=30)
    base_start = as_of - dt.timedelta(days=90)
    t = F.col("timestamp")
    tagged = positions.select("mmsi", "timestamp").withColumn("win", F.explode(F.array_compact(F.array(
        F.when((t >= _ts(recent_start)) & (t <= _ts(as_of)), F.lit("recent")),
        F.when((t >= _ts(base_start)) & (t <= _ts(recent_start)), F.lit("baseline"))))))
    tagged = tagged.withColumn("_k", F.concat_ws("|", "win", "mmsi"))
    p = with_previous(tagged, cols=("timestamp",), key="_k")
    ms = F.floor(F.unix_micros("timestamp") / 1000) - F.floor(F.unix_micros("prev_timestamp") / 1000)
    gaps = p.where(F.col("prev_timestamp").isNotNull() & (ms > F.lit(gap_threshold_h * 3600000)))
    per = gaps.groupBy("win").agg(F.count(F.lit(1)).alias("g"), F.countDistinct("mmsi").alias("v"))
    days = {"recent": 30, "baseline": 60}
    rates = per.agg(*[
        F.coalesce(F.max(F.when(F.col("win") == w, F.col("g") / (F.col("v") * d))), F.lit(0.0)).alias(w)
        for w, d in days.items()])
    return make_alert(rates, "ais_gap_rate", "gaps_per_vessel_day", F.col("recent"), F.col("baseline"), C.DRIFT_GAPS)


def flag_distribution_check(features: DataFrame) -> DataFrame:
    """Mean high-risk flag ratio vs the fixed 0.35 reference (needs >= 5 vessels)."""
    agg = features.where(F.col("high_risk_flag_ratio").isNotNull()).agg(
        F.avg("high_risk_flag_ratio").alias("m"), F.count(F.lit(1)).alias("n"))
    return make_alert(agg, "flag_distribution", "high_risk_flag_ratio_mean", F.col("m"), F.lit(FLAG_REFERENCE),
                      C.DRIFT_FLAGS, F.col("n") >= MIN_SAMPLE)


def tier_score(tier: Column) -> Column:
    e = F.when(F.lit(False), F.lit(0.0))
    for k, v in TIER_SCORE.items():
        e = e.when(tier == k, F.lit(v))
    return e.otherwise(F.lit(TIER_DEFAULT))


def score_shift_check(reviews: DataFrame, as_of: dt.datetime = C.FIXTURE_AS_OF) -> DataFrame:
    """Mean tier score of the later half vs the earlier half of reviews (by time), n >= 10.

    Positions come from a distributed exclusive prefix count (no global window).
    """
    r = reviews.where(F.col("reviewed_at") <= _ts(as_of)).select(
        F.lit(0).alias("g"), F.unix_micros("reviewed_at").cast("double").alias("t"),
        tier_score(F.col("review_tier")).alias("s"), F.lit(1.0).alias("one"))
    pos = exclusive_prefix_sums(r, "g", "t", ["one"])
    n = r.count()  # a single scalar
    mid = n // 2
    agg = pos.agg(F.avg(F.when(F.col("cum_one") >= mid, F.col("s"))).alias("recent"),
                  F.avg(F.when(F.col("cum_one") < mid, F.col("s"))).alias("baseline"))
    return make_alert(agg, "watchlist_score_shift", "mean_confidence_score", F.col("recent"), F.col("baseline"),
                      C.DRIFT_SCORE, F.lit(n >= 2 * MIN_SAMPLE))


def concept_drift_check(reviews: DataFrame, as_of: dt.datetime = C.FIXTURE_AS_OF, window_days: int = 90) -> DataFrame:
    """C14: confirmed+probable share, last 90 d vs the 90 d before (>= 5 reviews each)."""
    a, b, c = as_of - dt.timedelta(days=2 * window_days), as_of - dt.timedelta(days=window_days), as_of
    t = F.col("reviewed_at")
    hit = F.col("review_tier").isin("confirmed", "probable")
    agg = reviews.agg(
        F.count_if((t >= _ts(a)) & (t < _ts(b))).alias("n0"), F.count_if((t >= _ts(a)) & (t < _ts(b)) & hit).alias("h0"),
        F.count_if((t >= _ts(b)) & (t < _ts(c))).alias("n1"), F.count_if((t >= _ts(b)) & (t < _ts(c)) & hit).alias("h1"))
    return make_alert(agg, "concept_drift_proxy", "confirmed_probable_ratio", F.col("h1") / F.col("n1"),
                      F.col("h0") / F.col("n0"), C.DRIFT_PRECISION, (F.col("n0") >= MIN_SAMPLE) & (F.col("n1") >= MIN_SAMPLE))


def drift_checks(positions: DataFrame, features: DataFrame, reviews: DataFrame,
                 as_of: dt.datetime = C.FIXTURE_AS_OF) -> DataFrame:
    """All four alerts, always four rows."""
    return (gap_rate_check(positions, as_of).unionByName(flag_distribution_check(features))
            .unionByName(score_shift_check(reviews, as_of)).unionByName(concept_drift_check(reviews, as_of)))
