"""Data-quality and sink queries (D1-D4, K1, K2, K6) with oracle SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import config as C
from ..oracle import with_views
from ..sources import publish, sinks
from ..sources.fixtures import Fixtures
from ..streaming.positions import scratch_path
from . import quality
from .registry import finish, register

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"

# Landed partitions: the region goes by the payload value k; some payload values stand for faulty receivers,
# whose rows have no latitude, an impossible one, no mmsi, or come twice.
_NAMES = [r[0] for r in C.REGIONS]
_REGION_LIST = ", ".join(f"'{n}'" for n in _NAMES)
LANDED_SQL = f"""SELECT [{_REGION_LIST}][1 + CAST(round(cog / 3.6) AS BIGINT) % {len(_NAMES)}] AS region, CAST(timestamp AS DATE) AS date,
    CASE WHEN round(cog / 3.6) = 17 THEN NULL ELSE mmsi END AS mmsi, timestamp,
    CASE round(cog / 3.6) WHEN 13 THEN NULL WHEN 31 THEN CAST(95.0 AS DOUBLE) ELSE lat END AS lat, lon
  FROM ais_positions, (SELECT unnest([1, 2]) AS copy) c WHERE copy = 1 OR round(cog / 3.6) = 22"""


def _landed(spark, base):
    pos = Fixtures(spark, base).ais_positions
    k = F.round(F.col("cog") / 3.6)
    names = F.array(*[F.lit(n) for n in _NAMES])
    copies = F.explode(F.when(k == 22, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return pos.select(
        F.element_at(names, (k.cast("int") % len(_NAMES)) + 1).alias("region"),
        F.when(k == 17, F.lit(None)).otherwise(F.col("mmsi")).alias("mmsi"), "timestamp",
        F.when(k == 13, F.lit(None)).when(k == 31, F.lit(95.0)).otherwise(F.col("lat")).alias("lat"), "lon", copies.alias("copy"),
    )


DQ_CTES = [
    ("rp", LANDED_SQL),
    ("rk", """SELECT region, date, mmsi, timestamp, count(*) AS n,
        count(*) FILTER (WHERE lat < -90 OR lat > 90 OR lon < -180 OR lon > 180) AS bad,
        count(*) FILTER (WHERE lat IS NULL) + count(*) FILTER (WHERE lon IS NULL) AS cn
      FROM rp GROUP BY ALL"""),
    ("pc", f"""SELECT region, date, sum(n) AS row_count, sum(CASE WHEN mmsi IS NULL THEN n ELSE 0 END) AS mn, sum(bad) AS bad,
        sum(cn) AS cn, sum(CASE WHEN timestamp < {AS_OF} - INTERVAL 48 HOUR THEN n ELSE 0 END) AS stale, count(*) AS dk,
        date = (SELECT max(date) FROM rp) AS is_recent
      FROM rk GROUP BY region, date"""),
    ("checks", """SELECT region, date, CAST(row_count AS BIGINT) AS row_count, CAST(mn AS BIGINT) AS mmsi_null_count,
        CAST(bad AS BIGINT) AS out_of_range, round(cn / (2.0 * row_count), 4) AS coord_null_rate,
        CASE WHEN is_recent THEN round(stale / row_count, 4) END AS stale_fraction,
        round((row_count - dk) / row_count, 4) AS duplicate_rate,
        row_count = 0 OR (mn = 0 AND bad = 0 AND cn / (2.0 * row_count) < 0.05
            AND COALESCE(CASE WHEN is_recent THEN stale / row_count < 0.5 END, true) AND (row_count - dk) / row_count < 0.01) AS passed
      FROM pc"""),
]


def _checks(spark, base):
    return quality.partition_checks(_landed(spark, base))


def _date_str(df):
    return df.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@register("dq_partition", with_views("ais_positions", extra=DQ_CTES)
          + "SELECT * REPLACE (strftime(date, '%Y-%m-%d') AS date) FROM checks")
def q_dq_partition(spark, base):
    return finish(_date_str(_checks(spark, base)), 4)


# The day after the last fix has no partition and must fail.
DAYS = (dt.date(2024, 1, 1), dt.date(2024, 1, 31))
_ACTIVE_LIST = ", ".join(f"'{r}'" for r in C.ACTIVE_REGIONS)


@register("dq_coverage", with_views("ais_positions", extra=[
    *DQ_CTES,
    ("scaf", f"""SELECT CAST(d AS DATE) AS date, unnest([{_REGION_LIST}]) AS region
      FROM (SELECT unnest(generate_series(DATE '{DAYS[0]}', DATE '{DAYS[1]}', INTERVAL 1 DAY)) AS d)"""),
]) + f"""SELECT strftime(s.date, '%Y-%m-%d') AS date,
  CAST(count(*) FILTER (WHERE s.region IN ({_ACTIVE_LIST}) AND COALESCE(c.passed, false)) AS BIGINT) AS active_passing,
  CAST(count(*) FILTER (WHERE COALESCE(c.passed, false)) AS BIGINT) AS regions_passing,
  count(*) FILTER (WHERE s.region IN ({_ACTIVE_LIST}) AND COALESCE(c.passed, false)) >= {C.MIN_ACTIVE_REGIONS} AS passed
FROM scaf s LEFT JOIN checks c ON c.region = s.region AND c.date = s.date GROUP BY s.date""")
def q_dq_coverage(spark, base):
    return finish(_date_str(quality.coverage(_checks(spark, base), *DAYS)))


@register("dq_contract", with_views("ranked_items") + """SELECT * FROM (VALUES
  ('min_rows', NULL, CAST(greatest(1 - (SELECT count(*) FROM ranked_items), 0) AS BIGINT)),
  ('not_null', 'mmsi', (SELECT CAST(count(*) FILTER (WHERE mmsi IS NULL) AS BIGINT) FROM ranked_items)),
  ('range:0:1', 'confidence', (SELECT CAST(count(*) FILTER (WHERE confidence < 0 OR confidence > 1) AS BIGINT) FROM ranked_items)),
  ('range:0:1', 'y_true', (SELECT CAST(count(*) FILTER (WHERE y_true < 0 OR y_true > 1) AS BIGINT) FROM ranked_items))
) t("check", "column", failures)""")
def q_dq_contract(spark, base):
    rules = [("mmsi", "not_null"), ("confidence", "range:0:1"), ("y_true", "range:0:1")]
    return finish(quality.contract_checks(Fixtures(spark, base).ranked_items, rules).drop("passed"))


@register("date_export", with_views("ais_positions") + """SELECT strftime(CAST(timestamp AS DATE), '%Y-%m-%d') AS date, CAST(count(*) AS BIGINT) AS rows
FROM ais_positions GROUP BY 1""")
def q_date_export(spark, base):
    path = scratch_path(spark, "export")
    pos = Fixtures(spark, base).ais_positions.drop("event_id")
    first = sinks.export_by_date(pos, path)
    # A second export finds every date present and adds no counts.
    return finish(_date_str(first.unionByName(sinks.export_by_date(pos, path))))


@register("insert_ignore", with_views("ais_positions") + """SELECT CAST(count(*) AS BIGINT) AS first_inserted,
  CAST(0 AS BIGINT) AS second_inserted, CAST(count(*) AS BIGINT) AS stored FROM (SELECT DISTINCT mmsi, timestamp FROM ais_positions)""")
def q_insert_ignore(spark, base):
    path = scratch_path(spark, "positions-pk")
    pos = Fixtures(spark, base).ais_positions.withColumn("date", F.to_date("timestamp"))
    first = sinks.insert_or_ignore(pos, path, ["mmsi", "timestamp"], ["date"])
    second = sinks.insert_or_ignore(pos, path, ["mmsi", "timestamp"], ["date"])
    stored = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("stored"))
    return stored.select(F.lit(first).cast("long").alias("first_inserted"),
                         F.lit(second).cast("long").alias("second_inserted"), F.col("stored").cast("long"))


@register("upsert_ref", with_views("vessel_meta", "equasis_vessel_ref") + """SELECT COALESCE(n.imo, o.imo) AS imo,
  CAST(COALESCE(n.vessel_type, o.vessel_type) AS DOUBLE) AS vessel_type, CAST(o.build_year AS DOUBLE) AS build_year,
  CASE WHEN n.imo IS NOT NULL THEN n.scrapped ELSE o.scrapped END AS scrapped
FROM (SELECT imo, CASE WHEN ship_type = 30 THEN NULL ELSE ship_type END AS vessel_type, false AS scrapped FROM vessel_meta) n
FULL OUTER JOIN equasis_vessel_ref o ON o.imo = n.imo""")
def q_upsert_ref(spark, base):
    """K2: registry rows from the vessel registry upserted onto the reference table."""
    fx = Fixtures(spark, base)
    new = fx.vessel_meta.select(
        "imo", F.when(F.col("ship_type") == 30, F.lit(None)).otherwise(F.col("ship_type")).alias("vessel_type"),
        F.lit(False).alias("scrapped"))
    out = sinks.upsert(new, fx.equasis_vessel_ref, "imo", overwrite=("scrapped",))
    return finish(out.withColumn("vessel_type", F.col("vessel_type").cast("double"))
                  .withColumn("build_year", F.col("build_year").cast("double")))


# Required vs optional outputs of the batch pipeline, as landed views.
_STEPS = (("ais_positions", True), ("vessel_meta", True), ("sanctions_entities", True), ("detections", False),
          ("owned_by", False), ("managed_by", False), ("trade_flow", False), ("equasis_vessel_ref", False),
          ("vessel_reviews", False))


@register("dq_steps", with_views(*[s for s, _ in _STEPS]) + " UNION ALL ".join(
    f"SELECT '{s}' AS step, CAST(count(*) AS BIGINT) AS rows, {str(r).lower()} AS required, "
    f"CASE WHEN count(*) > 0 THEN 'ok' WHEN {str(r).lower()} THEN 'fail' ELSE 'warn' END AS status FROM {s}"
    for s, r in _STEPS))
def q_dq_steps(spark, base):
    fx = Fixtures(spark, base)
    return quality.step_checks({s: (getattr(fx, s), r) for s, r in _STEPS})


@register("publish_gate", with_views("vessel_meta") + """SELECT mmsi, imo, name, flag, CAST(ship_type AS BIGINT) AS ship_type,
  CAST(1 AS BIGINT) AS version, 'published,rejected,skipped' AS outcomes FROM vessel_meta""")
def q_publish_gate(spark, base):
    """K7/K8: the registry goes live; a batch with broken ids is rejected, a too short optional one skipped; readers keep the first version."""
    root = scratch_path(spark, "published-meta")
    meta = Fixtures(spark, base).vessel_meta
    broken = meta.withColumn("mmsi", F.when(F.col("flag") == "IR", F.concat(F.lit("x"), "mmsi")).otherwise(F.col("mmsi")))
    done = [publish.publish_vessel_meta(meta, root), publish.publish_vessel_meta(broken, root),
            publish.publish(meta.where("flag is null"), root, ["mmsi"], min_rows=1, optional=True)]
    live = publish.read_published(spark, root)
    return finish(live.withColumn("version", F.lit(publish.newest(spark, root).version))
                  .withColumn("outcomes", F.lit(",".join(o.status for o in done))))
