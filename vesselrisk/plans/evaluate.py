"""Ranking evaluation (E1-E10, A10): labels, top-k metrics, AUROC/AP, ECE,
best-F1 threshold, review-capacity thresholds, strata and multi-window summary.

Input: a ranked frame with ``window_id`` (window/region key), ``mmsi``,
``confidence`` and ``y_true`` (1/0, null = unlabelled). Ordering is always
confidence desc with an mmsi tiebreak.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import exclusive_prefix_sums, top_k_per_group

POSITIVE_LABELS = ("positive", "confirmed", "probable")
NEGATIVE_LABELS = ("negative", "cleared")
DEFAULT_CAPACITIES = (50, 100, 200)


def label_watchlist(watchlist: DataFrame, labels: DataFrame) -> DataFrame:
    """y_true by mmsi or imo; a positive label on either key wins over a negative one.

    ``label_confidence`` (where the labels have one) comes from the mmsi match, else from
    the imo match. Two equi-joins (never an OR join), folded per row.
    """
    conf = F.col("label_confidence") if "label_confidence" in labels.columns else F.lit(None)
    lab = labels.select(
        F.coalesce(F.trim("mmsi"), F.lit("")).alias("l_mmsi"), F.coalesce(F.trim("imo"), F.lit("")).alias("l_imo"),
        F.when(F.lower(F.trim("label")).isin(*POSITIVE_LABELS), 1)
        .when(F.lower(F.trim("label")).isin(*NEGATIVE_LABELS), 0).alias("y"), conf.cast("string").alias("c"))
    lab = lab.where(F.col("y").isNotNull())
    by_mmsi = lab.where(F.col("l_mmsi") != "").groupBy("l_mmsi").agg(F.max("y").alias("y_m"), F.max_by("c", F.struct("y", "c")).alias("c_m"))
    by_imo = lab.where(F.col("l_imo") != "").groupBy("l_imo").agg(F.max("y").alias("y_i"), F.max_by("c", F.struct("y", "c")).alias("c_i"))
    w = watchlist.withColumn("_imo", F.coalesce(F.trim(F.col("imo")), F.lit("")))
    j = (w.join(by_mmsi, w.mmsi == by_mmsi.l_mmsi, "left")
         .join(by_imo, (F.col("_imo") != "") & (F.col("_imo") == by_imo.l_imo), "left"))
    return (j.withColumn("y_true", F.greatest("y_m", "y_i")).withColumn("label_confidence", F.coalesce("c_m", "c_i"))
            .drop("l_mmsi", "l_imo", "y_m", "y_i", "c_m", "c_i", "_imo"))


def _order() -> list[Column]:
    return [F.col("confidence").desc(), F.col("mmsi")]


def topk_metrics(ranked: DataFrame, ks_precision=(50, 100), ks_recall=(100, 200)) -> DataFrame:
    """E2 per window over labelled rows: precision@k (denominator min(k, n)) and recall@k."""
    lab = ranked.where(F.col("y_true").isNotNull())
    kmax = max(*ks_precision, *ks_recall)
    top = top_k_per_group(lab, ["window_id"], _order(), kmax)
    tk = top.groupBy("window_id").agg(
        *[F.sum(F.when(F.col("rk") <= k, F.col("y_true"))).alias(f"hits_{k}") for k in sorted(set(ks_precision) | set(ks_recall))])
    base = ranked.groupBy("window_id").agg(
        F.count(F.lit(1)).alias("candidate_count"), F.count("y_true").alias("labeled_count"),
        F.coalesce(F.sum("y_true"), F.lit(0)).alias("positive_count"))
    j = base.join(tk, "window_id", "left")
    cols = [F.col("window_id"), "candidate_count", "labeled_count", "positive_count"]
    for k in ks_precision:
        cols.append(F.when(F.col("labeled_count") > 0, F.coalesce(F.col(f"hits_{k}"), F.lit(0))
                           / F.least(F.lit(k), F.col("labeled_count"))).otherwise(0.0).alias(f"precision_at_{k}"))
    for k in ks_recall:
        cols.append(F.when(F.col("positive_count") > 0, F.coalesce(F.col(f"hits_{k}"), F.lit(0))
                           / F.col("positive_count")).otherwise(0.0).alias(f"recall_at_{k}"))
    return j.select(*cols)


def score_histogram(ranked: DataFrame, group: str = "window_id") -> DataFrame:
    """Labelled rows aggregated to (group, score): pos / neg counts (the distinct-score table)."""
    lab = ranked.where(F.col("y_true").isNotNull())
    return lab.groupBy(group, F.col("confidence").alias("score")).agg(
        F.sum(F.col("y_true")).cast("double").alias("pos"),
        F.sum(1 - F.col("y_true")).cast("double").alias("neg"))


def auroc_ap(ranked: DataFrame, group: str = "window_id") -> DataFrame:
    """E5: AUROC (Mann-Whitney with half ties) and average precision; null for one class."""
    h = score_histogram(ranked, group)
    asc = exclusive_prefix_sums(h, group, "score", ["neg"], ascending=True)  # negatives strictly below
    desc = exclusive_prefix_sums(h, group, "score", ["pos", "neg"], ascending=False)  # strictly above
    a = asc.groupBy(group).agg(
        F.sum(F.col("pos") * (F.col("cum_neg") + 0.5 * F.col("neg"))).alias("u"),
        F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    tp = F.col("cum_pos") + F.col("pos")
    fp = F.col("cum_neg") + F.col("neg")
    b = desc.withColumn("prec", tp / (tp + fp)).groupBy(group).agg(
        F.sum(F.col("pos") * F.col("prec")).alias("ap_num"))
    j = a.join(b, group)
    ok = (F.col("P") > 0) & (F.col("N") > 0)
    return j.select(group,
                    F.when(ok, F.col("u") / (F.col("P") * F.col("N"))).alias("auroc"),
                    F.when(ok, F.col("ap_num") / F.col("P")).alias("pr_auc"))


def best_f1_threshold(ranked: DataFrame, group: str = "window_id") -> DataFrame:
    """Threshold over distinct scores maximising F1 (ties -> highest score); null for one class."""
    h = score_histogram(ranked, group)
    d = exclusive_prefix_sums(h, group, "score", ["pos", "neg"], ascending=False)
    tot = h.groupBy(group).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    tp = F.col("cum_pos") + F.col("pos")
    fp = F.col("cum_neg") + F.col("neg")
    f1 = F.when(tp > 0, 2 * tp / (2 * tp + fp + (F.col("P") - tp))).otherwise(0.0)
    best = d.join(tot, group).withColumn("f1", f1).groupBy(group).agg(
        F.max_by("score", F.struct("f1", "score")).alias("thr"), F.first("P").alias("P"), F.first("N").alias("N"))
    return best.select(group, F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("thr")).alias("recommended_threshold"))


def ece_bin(s: Column, bins: int = 10) -> Column:
    """Bin b with b/bins <= s < (b+1)/bins (last bin closed), computed by exact comparison."""
    b0 = F.floor(s * bins).cast("int")
    b1 = F.when(s < b0 / F.lit(float(bins)), b0 - 1).when(s >= (b0 + 1) / F.lit(float(bins)), b0 + 1).otherwise(b0)
    return F.least(F.greatest(b1, F.lit(0)), F.lit(bins - 1))


def calibration_error(ranked: DataFrame, bins: int = 10, group: str = "window_id") -> DataFrame:
    """Expected calibration error over labelled rows with equal-width bins."""
    lab = ranked.where(F.col("y_true").isNotNull() & (F.col("confidence") >= 0) & (F.col("confidence") <= 1))
    per = lab.groupBy(group, ece_bin(F.col("confidence"), bins).alias("b")).agg(
        F.avg("confidence").alias("conf"), F.avg("y_true").alias("emp"), F.count(F.lit(1)).alias("n"))
    tot = lab.groupBy(group).agg(F.count(F.lit(1)).alias("total"))
    return per.join(tot, group).groupBy(group).agg(
        F.sum(F.abs(F.col("conf") - F.col("emp")) * F.col("n") / F.col("total")).alias("calibration_error"))


def capacity_thresholds(ranked: DataFrame, capacities=DEFAULT_CAPACITIES, group: str = "window_id") -> DataFrame:
    """For each review capacity k: min score in the top k (all rows) and hit rate of labelled ones."""
    kmax = max(capacities)
    top = top_k_per_group(ranked, [group], _order(), kmax)
    aggs = []
    for k in capacities:
        inside = F.col("rk") <= k
        aggs += [F.min(F.when(inside, F.col("confidence"))).alias(f"min_{k}"),
                 F.coalesce(F.avg(F.when(inside, F.col("y_true"))), F.lit(0.0)).alias(f"hit_{k}")]
    per = top.groupBy(group).agg(*aggs)
    stack = ", ".join(f"{k}, min_{k}, hit_{k}" for k in capacities)
    return per.selectExpr(group, f"stack({len(capacities)}, {stack}) AS (review_capacity, min_score, hit_rate)")


def stratified(ranked: DataFrame, by: str = "vessel_type", min_n: int = 3, group: str = "window_id") -> DataFrame:
    """Per stratum (n >= 3 labelled): n, positives, precision@50, recall@100, AUROC."""
    lab = ranked.where(F.col("y_true").isNotNull()).withColumn("_g", F.concat_ws("\u0001", F.col(group), F.col(by)))
    g = lab.drop(group).withColumn("window_id", F.col("_g"))
    m = topk_metrics(g, ks_precision=(50,), ks_recall=(100,))
    a = auroc_ap(g)
    keys = lab.select(F.col("_g").alias("window_id"), F.col(group).alias("_grp"), by).distinct()
    out = m.join(a, "window_id", "left").join(keys, "window_id").drop("window_id").withColumnRenamed("_grp", group)
    return out.where(F.col("labeled_count") >= min_n).select(
        group, by, F.col("labeled_count").alias("n"), "positive_count", "precision_at_50", "recall_at_100", "auroc")


def metric_ci(per_window: DataFrame, metric: str) -> DataFrame:
    """A10: mean and 95% CI (1.96 * sample se) of a per-window metric; CI null for one window."""
    return per_window.agg(
        F.avg(metric).alias("mean"), F.count(metric).alias("windows"),
        F.when(F.count(metric) > 1, F.avg(metric) - 1.96 * F.stddev_samp(metric) / F.sqrt(F.count(metric))).alias("ci95_low"),
        F.when(F.count(metric) > 1, F.avg(metric) + 1.96 * F.stddev_samp(metric) / F.sqrt(F.count(metric))).alias("ci95_high"),
    ).withColumn("metric", F.lit(metric))


# FIXED VALUES: regression gate (metric, floor, ceiling) and the near-zero false-negative cut.
GATE_THRESHOLDS = (
    ("precision_at_50", 0.25, 0.95),
    ("auroc", 0.65, 0.99),
    ("recall_at_200", 0.50, None),
    ("total_known_cases", 5, 500),
)
NEAR_ZERO_CONFIDENCE = 0.10
DEFAULT_ERROR_THRESHOLD = 0.7


def metric_gate(ranked: DataFrame, group: str = "window_id") -> DataFrame:
    """floor/ceiling checks on mean per-window metrics plus near-zero false negatives.

    When every labelled row is positive, the P@50 ceiling and AUROC are not
    checked (AUROC is also skipped when undefined). One row per check.
    """
    tk = topk_metrics(ranked)
    auc = auroc_ap(ranked, group).select(group, "auroc")
    thr = best_f1_threshold(ranked, group)
    fn = (
        ranked.where(F.col("y_true") == 1).join(thr, group, "left")
        .where(F.col("confidence") < F.coalesce("recommended_threshold", F.lit(DEFAULT_ERROR_THRESHOLD)))
        .where(F.col("confidence") < NEAR_ZERO_CONFIDENCE)
        .agg(F.count(F.lit(1)).alias("false_negatives"))
    )
    summ = tk.agg(
        F.avg("precision_at_50").alias("precision_at_50"), F.avg("recall_at_200").alias("recall_at_200"),
        F.sum("positive_count").cast("double").alias("total_known_cases"),
        F.bool_and((F.col("labeled_count") == 0) | (F.col("labeled_count") == F.col("positive_count"))).alias("all_pos"),
    )
    a = auc.agg(F.avg("auroc").alias("auroc"))
    # The gate reads a handful of scalars (one aggregate row each) back to the driver.
    row = summ.first()
    vals = {"precision_at_50": row["precision_at_50"], "recall_at_200": row["recall_at_200"],
            "total_known_cases": row["total_known_cases"], "auroc": a.first()["auroc"]}
    all_pos = bool(row["all_pos"])
    checks = []
    for metric, lo, hi in GATE_THRESHOLDS:
        v = vals[metric]
        skip = (metric == "auroc" and (v is None or all_pos))
        ceil = None if (metric == "precision_at_50" and all_pos) else hi
        ok = skip or (v is not None and (lo is None or v >= lo) and (ceil is None or v <= ceil))
        checks.append((metric, None if v is None else float(v), float(lo) if lo is not None else None,
                       float(ceil) if ceil is not None else None, skip, bool(ok)))
    n_fn = fn.first()["false_negatives"]
    checks.append(("false_negatives", float(n_fn), None, 0.0, False, n_fn == 0))
    spark = ranked.sparkSession
    return spark.createDataFrame(checks, "metric string, value double, floor double, ceiling double, "
                                         "skipped boolean, passed boolean")


# FIXED VALUES: review tiers that count as positive / negative labels.
REVIEW_POSITIVE = ("confirmed", "probable", "suspect")
REVIEW_NEGATIVE = ("cleared",)


def latest_reviews(reviews: DataFrame, as_of) -> DataFrame:
    """W4 for E13: each vessel's latest review at or before ``as_of`` (ties -> larger tier), with its label.

    Expressed as a partial aggregation (max of a (time, tier) struct), so a
    vessel with many reviews never needs a sorted window.
    """
    r = reviews.where(F.col("reviewed_at") <= F.lit(as_of).cast("timestamp")).select(
        F.trim(F.col("mmsi").cast("string")).alias("mmsi"), "reviewed_at",
        F.lower(F.trim("review_tier")).alias("review_tier"))
    last = r.groupBy("mmsi").agg(F.max(F.struct("reviewed_at", "review_tier")).alias("l"))
    tier = F.col("l.review_tier")
    return last.select(
        "mmsi", F.col("l.reviewed_at").alias("reviewed_at"), tier.alias("review_tier"),
        F.when(tier.isin(*REVIEW_POSITIVE), F.lit(1)).when(tier.isin(*REVIEW_NEGATIVE), F.lit(0)).alias("y_true"))


def review_tier_counts(latest: DataFrame) -> DataFrame:
    """E13 tier counts over the latest reviews."""
    return latest.groupBy("review_tier").agg(F.count(F.lit(1)).alias("n"),
                                             F.first("y_true").alias("y_true"))
