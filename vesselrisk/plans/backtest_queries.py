"""Multi-window backtest (E9, E10, A10) over ranked_items and source coverage (E8, J15) over the segment lists, with oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..oracle import with_views
from ..sources.tables import read_table
from . import backtest as B
from . import coverage as S
from .eval_queries import eval_sql, ranked
from .label_queries import WATCHLIST_SQL, watchlist
from .registry import ORACLE, finish, register

WINDOW_CTES = [
    ("pr", ORACLE["precision_recall"]), ("au", ORACLE["auroc_ap"]), ("bf", ORACLE["best_f1"]), ("ec", ORACLE["ece"]),
    ("w", """SELECT pr.*, auroc, pr_auc, calibration_error,
             CASE WHEN labeled_count > 0 THEN COALESCE(recommended_threshold, 0.7) END AS recommended_threshold
             FROM pr LEFT JOIN au USING (window_id) LEFT JOIN bf USING (window_id) LEFT JOIN ec USING (window_id)"""),
]
ERROR_CTES = [
    *WINDOW_CTES,
    ("err", """SELECT * FROM (SELECT r.*, CASE WHEN confidence >= recommended_threshold AND y_true = 0 THEN 'false_positive'
                 WHEN confidence < recommended_threshold AND y_true = 1 THEN 'false_negative' END AS kind
               FROM r JOIN w USING (window_id) WHERE y_true IS NOT NULL) WHERE kind IS NOT NULL"""),
]


@register("backtest_windows", eval_sql("SELECT * FROM w", *WINDOW_CTES))
def q_backtest_windows(spark, base):
    return finish(B.backtest_windows(ranked(spark, base)))


def _interval(metric: str) -> str:
    half = f"CASE WHEN count({metric}) > 1 THEN 1.96 * stddev_samp({metric}) / sqrt(count({metric})) END"
    return (f"SELECT '{metric}' AS metric, round(avg({metric}), 4) AS mean, CAST(count({metric}) AS BIGINT) AS windows, "
            f"round(avg({metric}) - {half}, 4) AS ci95_low, round(avg({metric}) + {half}, 4) AS ci95_high FROM w")


@register("backtest_intervals", eval_sql(" UNION ALL ".join(map(_interval, B.INTERVAL_METRICS)), *WINDOW_CTES))
def q_backtest_intervals(spark, base):
    return finish(B.metric_intervals(B.backtest_windows(ranked(spark, base))), 4)


@register("error_lists", eval_sql("""SELECT window_id, kind, CAST(place AS BIGINT) AS place, mmsi, vessel_type, round(confidence, 6) AS confidence,
  CAST(errors AS BIGINT) AS errors
FROM (SELECT *, row_number() OVER (PARTITION BY window_id, kind ORDER BY confidence DESC, mmsi) AS place,
             count(*) OVER (PARTITION BY window_id, kind) AS errors FROM err) WHERE place <= 10""", *ERROR_CTES))
def q_error_lists(spark, base):
    items = ranked(spark, base)
    return finish(B.error_lists(items, B.backtest_windows(items)))


@register("positive_ranks", eval_sql("""SELECT window_id, mmsi, round(confidence, 6) AS confidence, CAST(rank AS BIGINT) AS rank
FROM (SELECT *, rank() OVER (PARTITION BY window_id ORDER BY confidence DESC) AS rank FROM r WHERE y_true IS NOT NULL) WHERE y_true = 1"""))
def q_positive_ranks(spark, base):
    return finish(B.positive_ranks(ranked(spark, base)))


def source_labels(spark, base):
    """Customers in debt as positives of their segment: by mmsi, by imo alone, or by an mmsi that no list has."""
    c = read_table(spark, base, "customer").where("c_acctbal < 0")
    key, kind = F.col("c_custkey"), F.col("c_nationkey") % 3
    return c.select(
        F.col("c_mktsegment").alias("window_id"),
        F.when(kind == 0, (F.lit(200000000) + key).cast("string")).when(kind == 2, (F.lit(700000000) + key).cast("string")).alias("mmsi"),
        F.when(kind != 2, (F.lit(9000000) + key).cast("string")).alias("imo"), F.lit("positive").alias("label"))


COVERAGE_CTES = [
    ("w", WATCHLIST_SQL),
    ("placed", """SELECT *, row_number() OVER (PARTITION BY window_id ORDER BY confidence DESC, mmsi) AS place,
        rank() OVER (PARTITION BY window_id ORDER BY confidence DESC) AS rk FROM w"""),
    ("l", """SELECT c_mktsegment AS window_id, CASE c_nationkey % 3 WHEN 0 THEN CAST(200000000 + c_custkey AS VARCHAR)
        WHEN 2 THEN CAST(700000000 + c_custkey AS VARCHAR) END AS mmsi,
        CASE WHEN c_nationkey % 3 <> 2 THEN CAST(9000000 + c_custkey AS VARCHAR) END AS imo FROM customer WHERE c_acctbal < 0"""),
    ("lr", """SELECT l.window_id, l.mmsi, l.imo, CASE WHEN a.mmsi IS NOT NULL THEN 'mmsi' WHEN b.imo IS NOT NULL THEN 'imo' END AS path,
        CASE WHEN a.mmsi IS NOT NULL THEN a.confidence ELSE b.confidence END AS confidence,
        CASE WHEN a.mmsi IS NOT NULL THEN a.rk ELSE b.rk END AS rank,
        CASE WHEN a.mmsi IS NOT NULL THEN a.place ELSE b.place END AS place
        FROM l LEFT JOIN placed a ON a.window_id = l.window_id AND a.mmsi = l.mmsi LEFT JOIN placed b ON b.window_id = l.window_id AND b.imo = l.imo"""),
]


@register("label_ranks", with_views(extra=COVERAGE_CTES) + """SELECT window_id, mmsi, imo, path, round(confidence, 6) AS confidence,
  CAST(rank AS DOUBLE) AS rank, CAST(CASE WHEN place <= 200 THEN place END AS DOUBLE) AS place FROM lr""")
def q_label_ranks(spark, base):
    out = S.label_ranks(watchlist(spark, base), source_labels(spark, base))
    return finish(out.withColumns({c: F.col(c).cast("double") for c in ("rank", "place")}))  # null where a label is missed


@register("source_coverage", with_views(extra=COVERAGE_CTES) + """SELECT window_id, CAST(k AS BIGINT) AS review_capacity,
  CAST(count(*) FILTER (place <= k) AS BIGINT) AS hits, round(count(*) FILTER (place <= k) / count(*), 6) AS recall,
  CAST(count(*) AS BIGINT) AS source_positive_total, CAST(count(path) AS BIGINT) AS matched_total,
  CAST(count(*) - count(path) AS BIGINT) AS missed_total, round(count(path) / count(*), 6) AS source_recall
FROM lr, (VALUES (50), (100), (200)) c(k) GROUP BY window_id, k""")
def q_source_coverage(spark, base):
    return finish(S.source_coverage(watchlist(spark, base), source_labels(spark, base)))
