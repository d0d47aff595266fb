"""Evaluation queries (E1-E7, E10/A10, M10) over ranked_items, with oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..oracle import with_views
from ..sources.fixtures import Fixtures
from . import evaluate as E
from .registry import finish, register

R_SQL = "SELECT region AS window_id, mmsi, vessel_type, confidence, y_true FROM ranked_items"


def ranked(spark, base):
    return Fixtures(spark, base).ranked_items.select(
        F.col("region").alias("window_id"), "mmsi", "vessel_type", "confidence", "y_true")


def eval_sql(body: str, *extra) -> str:
    return with_views("ranked_items", extra=[("r", R_SQL), *extra]) + body


TOPK_CTES = [
    ("lab", """SELECT *, row_number() OVER (PARTITION BY window_id ORDER BY confidence DESC, mmsi) AS rk
               FROM r WHERE y_true IS NOT NULL"""),
    ("base", """SELECT window_id, count(*) AS candidate_count, count(y_true) AS labeled_count,
                COALESCE(sum(y_true), 0) AS positive_count FROM r GROUP BY window_id"""),
    ("tk", """SELECT window_id, sum(CASE WHEN rk <= 50 THEN y_true END) AS h50, sum(CASE WHEN rk <= 100 THEN y_true END) AS h100,
              sum(CASE WHEN rk <= 200 THEN y_true END) AS h200 FROM lab GROUP BY window_id"""),
]


@register(
    "precision_recall",
    eval_sql("""SELECT b.window_id, CAST(candidate_count AS BIGINT) AS candidate_count,
       CAST(labeled_count AS BIGINT) AS labeled_count, CAST(positive_count AS BIGINT) AS positive_count,
       round(CASE WHEN labeled_count > 0 THEN COALESCE(h50, 0) / least(50, labeled_count) ELSE 0.0 END, 6) AS precision_at_50,
       round(CASE WHEN labeled_count > 0 THEN COALESCE(h100, 0) / least(100, labeled_count) ELSE 0.0 END, 6) AS precision_at_100,
       round(CASE WHEN positive_count > 0 THEN COALESCE(h100, 0) / positive_count ELSE 0.0 END, 6) AS recall_at_100,
       round(CASE WHEN positive_count > 0 THEN COALESCE(h200, 0) / positive_count ELSE 0.0 END, 6) AS recall_at_200
FROM base b LEFT JOIN tk ON tk.window_id = b.window_id""", *TOPK_CTES),
)
def q_precision_recall(spark, base):
    return finish(E.topk_metrics(ranked(spark, base)))


AUC_CTES = [
    ("h", """SELECT window_id, confidence AS score, CAST(sum(y_true) AS DOUBLE) AS pos, CAST(sum(1 - y_true) AS DOUBLE) AS neg
             FROM r WHERE y_true IS NOT NULL GROUP BY window_id, confidence"""),
    ("hc", """SELECT *, COALESCE(sum(neg) OVER (PARTITION BY window_id ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
              sum(pos) OVER (PARTITION BY window_id ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
              sum(neg) OVER (PARTITION BY window_id ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
              sum(pos) OVER (PARTITION BY window_id) AS P, sum(neg) OVER (PARTITION BY window_id) AS N FROM h"""),
]


@register(
    "auroc_ap",
    eval_sql("""SELECT window_id,
       round(CASE WHEN max(P) > 0 AND max(N) > 0 THEN sum(pos * (neg_below + 0.5 * neg)) / (max(P) * max(N)) END, 6) AS auroc,
       round(CASE WHEN max(P) > 0 AND max(N) > 0 THEN sum(pos * tp / (tp + fp)) / max(P) END, 6) AS pr_auc
FROM hc GROUP BY window_id""", *AUC_CTES),
)
def q_auroc_ap(spark, base):
    return finish(E.auroc_ap(ranked(spark, base)))


@register(
    "best_f1",
    eval_sql("""SELECT window_id, CASE WHEN max(P) > 0 AND max(N) > 0 THEN arg_max(score, f1 * 1e9 + score) END AS recommended_threshold
FROM (SELECT *, CASE WHEN tp > 0 THEN 2 * tp / (2 * tp + fp + (P - tp)) ELSE 0.0 END AS f1 FROM hc) GROUP BY window_id""", *AUC_CTES),
)
def q_best_f1(spark, base):
    return finish(E.best_f1_threshold(ranked(spark, base)))


@register(
    "ece",
    eval_sql("""SELECT window_id, round(sum(abs(conf - emp) * n / total), 6) AS calibration_error FROM (
  SELECT window_id, b, avg(confidence) AS conf, avg(y_true) AS emp, count(*) AS n, max(total) AS total FROM (
    SELECT *, least(greatest(CASE WHEN confidence < b0 / 10.0 THEN b0 - 1 WHEN confidence >= (b0 + 1) / 10.0 THEN b0 + 1 ELSE b0 END, 0), 9) AS b,
           count(*) OVER (PARTITION BY window_id) AS total
    FROM (SELECT *, CAST(floor(confidence * 10) AS INTEGER) AS b0 FROM r WHERE y_true IS NOT NULL AND confidence BETWEEN 0 AND 1))
  GROUP BY window_id, b) GROUP BY window_id"""),
)
def q_ece(spark, base):
    return finish(E.calibration_error(ranked(spark, base)))


@register(
    "capacity_thresholds",
    eval_sql("""SELECT window_id, CAST(k AS BIGINT) AS review_capacity, round(min(confidence), 6) AS min_score,
       round(COALESCE(avg(y_true), 0.0), 6) AS hit_rate
FROM (SELECT *, row_number() OVER (PARTITION BY window_id ORDER BY confidence DESC, mmsi) AS rk FROM r) t
JOIN (VALUES (50), (100), (200)) c(k) ON t.rk <= c.k GROUP BY window_id, k"""),
)
def q_capacity_thresholds(spark, base):
    return finish(E.capacity_thresholds(ranked(spark, base)))


@register(
    "stratified",
    eval_sql("""SELECT window_id, vessel_type, CAST(n AS BIGINT) AS n, CAST(positive_count AS BIGINT) AS positive_count,
       round(COALESCE(h50, 0) / least(50, n), 6) AS precision_at_50,
       round(CASE WHEN positive_count > 0 THEN COALESCE(h100, 0) / positive_count ELSE 0.0 END, 6) AS recall_at_100,
       round(auroc, 6) AS auroc
FROM (SELECT window_id, vessel_type, count(*) AS n, sum(y_true) AS positive_count,
             sum(CASE WHEN rk <= 50 THEN y_true END) AS h50, sum(CASE WHEN rk <= 100 THEN y_true END) AS h100
      FROM (SELECT *, row_number() OVER (PARTITION BY window_id, vessel_type ORDER BY confidence DESC, mmsi) AS rk
            FROM r WHERE y_true IS NOT NULL) GROUP BY window_id, vessel_type) m
LEFT JOIN (SELECT window_id AS w2, vessel_type AS v2,
       CASE WHEN max(P) > 0 AND max(N) > 0 THEN sum(pos * (neg_below + 0.5 * neg)) / (max(P) * max(N)) END AS auroc
   FROM (SELECT *, COALESCE(sum(neg) OVER (PARTITION BY window_id, vessel_type ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
                sum(pos) OVER (PARTITION BY window_id, vessel_type) AS P, sum(neg) OVER (PARTITION BY window_id, vessel_type) AS N
         FROM (SELECT window_id, vessel_type, confidence AS score, CAST(sum(y_true) AS DOUBLE) AS pos, CAST(sum(1 - y_true) AS DOUBLE) AS neg
               FROM r WHERE y_true IS NOT NULL GROUP BY window_id, vessel_type, confidence))
   GROUP BY window_id, vessel_type) a ON a.w2 = m.window_id AND a.v2 = m.vessel_type
WHERE n >= 3"""),
)
def q_stratified(spark, base):
    return finish(E.stratified(ranked(spark, base)))


@register(
    "backtest_summary",
    eval_sql("""SELECT 'precision_at_50' AS metric, round(avg(p50), 6) AS mean, CAST(count(p50) AS BIGINT) AS windows,
       round(CASE WHEN count(p50) > 1 THEN avg(p50) - 1.96 * stddev_samp(p50) / sqrt(count(p50)) END, 6) AS ci95_low,
       round(CASE WHEN count(p50) > 1 THEN avg(p50) + 1.96 * stddev_samp(p50) / sqrt(count(p50)) END, 6) AS ci95_high
FROM (SELECT b.window_id, CASE WHEN labeled_count > 0 THEN COALESCE(h50, 0) / least(50, labeled_count) ELSE 0.0 END AS p50
      FROM base b LEFT JOIN tk ON tk.window_id = b.window_id)""", *TOPK_CTES),
)
def q_backtest_summary(spark, base):
    return finish(E.metric_ci(E.topk_metrics(ranked(spark, base)), "precision_at_50"))


def _metric_gate_sql() -> str:
    from .registry import ORACLE

    return eval_sql("""SELECT 'precision_at_50' AS metric, round(p50, 4) AS value, 0.25 AS floor,
    CASE WHEN allpos THEN NULL ELSE 0.95 END AS ceiling, false AS skipped,
    p50 IS NOT NULL AND p50 >= 0.25 AND (allpos OR p50 <= 0.95) AS passed FROM s
  UNION ALL SELECT 'auroc', round(auc, 4), 0.65, 0.99, auc IS NULL OR allpos,
    (auc IS NULL OR allpos) OR (auc >= 0.65 AND auc <= 0.99) FROM s, a
  UNION ALL SELECT 'recall_at_200', round(r200, 4), 0.5, NULL, false, r200 IS NOT NULL AND r200 >= 0.5 FROM s
  UNION ALL SELECT 'total_known_cases', tkc, 5.0, 500.0, false, tkc IS NOT NULL AND tkc >= 5 AND tkc <= 500 FROM s
  UNION ALL SELECT 'false_negatives', CAST(n AS DOUBLE), NULL, 0.0, false, n = 0 FROM f""",
        ("pr", ORACLE["precision_recall"]), ("au", ORACLE["auroc_ap"]), ("bf", ORACLE["best_f1"]),
        ("s", """SELECT avg(precision_at_50) AS p50, avg(recall_at_200) AS r200, CAST(sum(positive_count) AS DOUBLE) AS tkc,
                 bool_and(labeled_count = 0 OR labeled_count = positive_count) AS allpos FROM pr"""),
        ("a", "SELECT avg(auroc) AS auc FROM au"),
        ("f", """SELECT count(*) AS n FROM r LEFT JOIN bf ON bf.window_id = r.window_id
                 WHERE y_true = 1 AND confidence < COALESCE(recommended_threshold, 0.7) AND confidence < 0.1"""))


@register("metric_gate", _metric_gate_sql())
def q_metric_gate(spark, base):
    return finish(E.metric_gate(ranked(spark, base)), 4)


@register("review_tiers", with_views("vessel_reviews", extra=[
    ("lr", """SELECT mmsi, max({'t': reviewed_at, 'tier': lower(trim(review_tier))}) AS l
              FROM vessel_reviews WHERE reviewed_at <= TIMESTAMP '2024-01-31 00:00:00' GROUP BY mmsi"""),
]) + """SELECT l.tier AS review_tier, CAST(count(*) AS BIGINT) AS n,
  CAST(CASE WHEN l.tier IN ('confirmed', 'probable', 'suspect') THEN 1 WHEN l.tier = 'cleared' THEN 0 END AS DOUBLE) AS y_true
FROM lr GROUP BY ALL""")
def q_review_tiers(spark, base):
    from .. import config as C

    out = E.review_tier_counts(E.latest_reviews(Fixtures(spark, base).vessel_reviews, C.FIXTURE_AS_OF))
    return finish(out.withColumn("y_true", F.col("y_true").cast("double")))
