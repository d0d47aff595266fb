"""Multi-window backtest (E9, E10, A10): all windows and metrics of one frame together.

``ranked`` holds one row a candidate: window_id (not null), mmsi, vessel_type, confidence and
``y_true`` (1, 0 or null for no label). The labelled rows are folded to one row per window and
distinct score, and one pass of prefix sums over these gives AUROC, average precision, the
best-F1 threshold and the rank of every positive, so no task holds a window.

Defined results: a labelled row without a confidence (null or NaN) is counted and ranked last, but is
not on the curve, in an error list or in the list of ranks; a window without labels has null AUROC, precision curve,
calibration error and threshold; one with a single class takes the default threshold; no rows give no windows, and
intervals with a null mean over 0 windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import exclusive_prefix_sums, top_k_per_group
from ..session import cut_lineage
from . import evaluate as E

INTERVAL_METRICS = ("precision_at_50", "precision_at_100", "recall_at_200", "auroc")
ERRORS_PER_WINDOW = 10  # a report's length; the counts beside it are of all errors


def _clean(ranked: DataFrame) -> DataFrame:
    return ranked.withColumn("confidence", F.nanvl(F.col("confidence").cast("double"), F.lit(None).cast("double")))


def score_curve(ranked: DataFrame) -> DataFrame:
    """(window_id, score, pos, neg, cum_pos, cum_neg): labelled rows of a score, and of all higher scores of the window."""
    h = E.score_histogram(_clean(ranked).where(F.col("confidence").isNotNull()))
    return cut_lineage(exclusive_prefix_sums(h, "window_id", "score", ["pos", "neg"], ascending=False))


def curve_metrics(curve: DataFrame) -> DataFrame:
    """(window_id, auroc, pr_auc, best_threshold) from one aggregate over the curve; null for a single class."""
    tot = curve.groupBy("window_id").agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    tp, fp = F.col("cum_pos") + F.col("pos"), F.col("cum_neg") + F.col("neg")
    below = F.col("N") - fp
    f1 = F.when(tp > 0, 2 * tp / (tp + fp + F.col("P"))).otherwise(0.0)
    both = (F.col("P") > 0) & (F.col("N") > 0)
    per = curve.join(tot, "window_id").where(both).groupBy("window_id", "P", "N").agg(
        F.sum(F.col("pos") * (below + 0.5 * F.col("neg"))).alias("u"),
        F.sum(F.col("pos") * tp / (tp + fp)).alias("ap"),
        F.max_by("score", F.struct(f1, F.col("score"))).alias("best_threshold"))
    return per.select("window_id", (F.col("u") / (F.col("P") * F.col("N"))).alias("auroc"), (F.col("ap") / F.col("P")).alias("pr_auc"), "best_threshold")


def backtest_windows(ranked: DataFrame, curve: DataFrame | None = None) -> DataFrame:
    """A row per window with all metrics and the threshold that its error lists use."""
    clean = _clean(ranked)
    curve = score_curve(ranked) if curve is None else curve
    threshold = F.when(F.col("labeled_count") > 0, F.coalesce("best_threshold", F.lit(E.DEFAULT_ERROR_THRESHOLD)))
    return (E.topk_metrics(clean).join(curve_metrics(curve), "window_id", "left")
            .join(E.calibration_error(clean), "window_id", "left")
            .withColumn("recommended_threshold", threshold).drop("best_threshold"))


def metric_intervals(per_window: DataFrame, metrics=INTERVAL_METRICS) -> DataFrame:
    """A10: (metric, mean, windows, ci95_low, ci95_high) of all metrics from one aggregate; null values do not count."""
    def half(m: str) -> Column:
        return F.when(F.count(m) > 1, 1.96 * F.stddev_samp(m) / F.sqrt(F.count(m)))

    aggs = [c for m in metrics for c in (
        F.avg(m).alias(f"{m}_mean"), F.count(m).alias(f"{m}_n"), (F.avg(m) - half(m)).alias(f"{m}_low"), (F.avg(m) + half(m)).alias(f"{m}_high"))]
    rows = ", ".join(f"'{m}', {m}_mean, {m}_n, {m}_low, {m}_high" for m in metrics)
    return per_window.agg(*aggs).selectExpr(f"stack({len(metrics)}, {rows}) AS (metric, mean, windows, ci95_low, ci95_high)")


def _errors(ranked: DataFrame, windows: DataFrame) -> DataFrame:
    """Labelled rows on the wrong side of their window's threshold, with their kind."""
    lab = _clean(ranked).where(F.col("y_true").isNotNull() & F.col("confidence").isNotNull())
    j = lab.join(windows.select("window_id", "recommended_threshold"), "window_id")
    high = F.col("confidence") >= F.col("recommended_threshold")
    kind = F.when(high & (F.col("y_true") == 0), "false_positive").when(~high & (F.col("y_true") == 1), "false_negative")
    return j.withColumn("kind", kind).where(F.col("kind").isNotNull())


def error_lists(ranked: DataFrame, windows: DataFrame, n: int = ERRORS_PER_WINDOW) -> DataFrame:
    """The ``n`` errors of highest confidence of each window and kind (ties by mmsi), with the number of all of them."""
    errors = _errors(ranked, windows)
    total = errors.groupBy("window_id", "kind").agg(F.count(F.lit(1)).alias("errors"))
    top = top_k_per_group(errors, ["window_id", "kind"], [F.col("confidence").desc(), F.col("mmsi")], n, "place")
    return top.join(total, ["window_id", "kind"]).select("window_id", "kind", "place", "mmsi", "vessel_type", "confidence", "errors")


def positive_ranks(ranked: DataFrame, curve: DataFrame | None = None) -> DataFrame:
    """The rank of every positive among its window's labelled rows; rows of equal confidence share the best rank."""
    curve = score_curve(ranked) if curve is None else curve
    above = curve.where(F.col("pos") > 0).select(
        "window_id", F.col("score").alias("confidence"), (F.col("cum_pos") + F.col("cum_neg") + 1).cast("long").alias("rank"))
    positives = _clean(ranked).where(F.col("y_true") == 1).select("window_id", "mmsi", "confidence")
    return positives.join(above, ["window_id", "confidence"]).select("window_id", "mmsi", "confidence", "rank")
