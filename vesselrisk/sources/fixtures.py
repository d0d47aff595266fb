"""Adapter views: the driver's landed tables expressed in the vessel data model.

Each function maps a landed table onto one domain table (positions, registry,
sanctions, ownership edges, ...). The mapping rules are fixed so that the same
views can be written in DuckDB SQL for the oracle (see ``vesselrisk.oracle``).
Which entities exist follows from attributes (status, balance, segment, priority,
event type) of all rows; ids only choose values such as a vessel's type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table


def _flag_of(nationkey: Column) -> Column:
    # FIXED VALUES: nation bucket -> flag code used by the fixtures.
    m = nationkey % 8
    return (
        F.when(m == 0, "IR").when(m == 1, "RU").when(m == 2, "KP").when(m == 3, "SG")
        .when(m == 4, "PA").when(m == 5, "KM").when(m == 6, "VE").otherwise("LR")
    )


def _ship_type_of(key: Column) -> Column:
    m = key % 5
    return (
        F.when(m == 0, 82).when(m == 1, 70).when(m == 2, 60).when(m == 3, 52).otherwise(30)
    ).cast("int")


def _mmsi_of(key: Column) -> Column:
    return (F.lit(200000000) + key).cast("string")


def _imo_of(key: Column) -> Column:
    return (F.lit(9000000) + key).cast("string")


def positions_from_events(ev: DataFrame) -> DataFrame:
    """Row-wise mapping events -> positions (works on a batch or a streaming frame)."""
    k = F.get_json_object("props", "$.k").cast("int")
    return ev.select(
        _mmsi_of(F.col("user_id")).alias("mmsi"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        (F.lit(1.0) + (k % 10) * F.lit(0.5)).alias("lat"),
        (F.lit(103.5) + F.floor(k / 10) * F.lit(0.001)).alias("lon"),
        F.least(F.col("value") / 10, F.lit(30.0)).alias("sog"),
        (k.cast("double") * 3.6).alias("cog"),
        F.when(F.col("event_type") == "view", 0).when(F.col("event_type") == "click", 1)
        .when(F.col("event_type") == "purchase", 5).when(F.col("event_type") == "signup", 3)
        .otherwise(8).cast("int").alias("nav_status"),
        _ship_type_of(F.col("user_id")).alias("ship_type"),
        F.col("event_id"),
    )


def ais_positions(spark: SparkSession, base: str) -> DataFrame:
    return positions_from_events(read_table(spark, base, "events"))


def vessel_meta(spark: SparkSession, base: str) -> DataFrame:
    c = read_table(spark, base, "customer")
    return c.select(
        _mmsi_of(F.col("c_custkey")).alias("mmsi"),
        _imo_of(F.col("c_custkey")).alias("imo"),
        F.col("c_name").alias("name"),
        _flag_of(F.col("c_nationkey")).alias("flag"),
        _ship_type_of(F.col("c_custkey")).alias("ship_type"),
    )


def detections(spark: SparkSession, base: str) -> DataFrame:
    p = ais_positions(spark, base)
    hit = F.col("nav_status").isin(0, 5)
    return p.select(
        F.concat(F.lit("D"), F.col("event_id").cast("string")).alias("detection_id"),
        F.when(hit, F.col("timestamp") + F.expr("INTERVAL 20 MINUTES"))
        .otherwise(F.col("timestamp") + F.expr("INTERVAL 5 HOURS")).alias("detected_at"),
        (F.col("lat") + F.when(hit, F.lit(0.02)).otherwise(F.lit(0.1))).alias("lat"),
        F.col("lon"),
    )


def sanctions_entities(spark: SparkSession, base: str) -> DataFrame:
    s = read_table(spark, base, "supplier")
    c = read_table(spark, base, "customer")
    m3 = F.col("s_suppkey") % 3
    companies = s.where(F.col("s_acctbal") < 500).select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("entity_id"),
        F.col("s_name").alias("name"),
        F.lit(None).cast("string").alias("mmsi"),
        F.lit(None).cast("string").alias("imo"),
        F.lit(None).cast("string").alias("flag"),
        F.lit("Company").alias("type"),
        F.when(m3 == 0, "us_ofac_sdn;eu_fsf").when(m3 == 1, "un_sc_sanctions").otherwise("us_ofac_sdn").alias("list_source"),
    )
    vessels = c.where(F.col("c_acctbal") < -700).select(
        F.concat(F.lit("V"), F.col("c_custkey").cast("string")).alias("entity_id"),
        F.col("c_name").alias("name"),
        _mmsi_of(F.col("c_custkey")).alias("mmsi"),
        _imo_of(F.col("c_custkey")).alias("imo"),
        F.lit(None).cast("string").alias("flag"),
        F.lit("Vessel").alias("type"),
        F.when(F.col("c_custkey") % 2 == 0, "us_ofac_sdn").otherwise("eu_fsf;us_ofac_sdn").alias("list_source"),
    )
    return companies.unionByName(vessels)


def _order_company_edges(spark: SparkSession, base: str, linenumber: int, priority: str) -> DataFrame:
    o = read_table(spark, base, "orders").where(F.col("o_orderpriority") == priority).select("o_orderkey", "o_custkey")
    li = read_table(spark, base, "lineitem").where(F.col("l_linenumber") == linenumber).select("l_orderkey", "l_suppkey")
    return (
        o.join(li, o.o_orderkey == li.l_orderkey)
        .select(
            _mmsi_of(F.col("o_custkey")).alias("src_id"),
            F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("dst_id"),
        )
        .distinct()
    )


def owned_by(spark: SparkSession, base: str) -> DataFrame:
    return _order_company_edges(spark, base, 1, "1-URGENT")


def managed_by(spark: SparkSession, base: str) -> DataFrame:
    return _order_company_edges(spark, base, 2, "2-HIGH")


def controlled_by(spark: SparkSession, base: str) -> DataFrame:
    s = read_table(spark, base, "supplier")
    return s.where(F.col("s_suppkey") > 0).select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("src_id"),
        F.concat(F.lit("S"), F.floor(F.col("s_suppkey") / 3).cast("long").cast("string")).alias("dst_id"),
    )


def registered_in(spark: SparkSession, base: str) -> DataFrame:
    s = read_table(spark, base, "supplier")
    return s.select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("src_id"),
        _flag_of(F.col("s_nationkey")).alias("dst_id"),
    )


def registered_at(spark: SparkSession, base: str) -> DataFrame:
    s = read_table(spark, base, "supplier")
    return s.select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("src_id"),
        F.concat(F.lit("A"), (F.col("s_suppkey") % 17).cast("string")).alias("dst_id"),
    )


def trade_flow(spark: SparkSession, base: str) -> DataFrame:
    o = read_table(spark, base, "orders").where(F.col("o_orderstatus") == "F").select("o_custkey", "o_totalprice")
    c = read_table(spark, base, "customer").select("c_custkey", "c_nationkey")
    m = F.col("c_nationkey") % 8
    partner = F.when(m == 0, "IR").when(m == 1, "RU").when(m == 4, "PA").otherwise("SG")
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .groupBy(partner.alias("partner"))
        .agg(F.round(F.sum("o_totalprice"), 2).alias("trade_value_usd"))
        .select(
            F.lit("702").alias("reporter"), "partner", F.lit("2709").alias("hs_code"),
            F.lit("1996").alias("period"), "trade_value_usd",
        )
    )


def equasis_vessel_ref(spark: SparkSession, base: str) -> DataFrame:
    c = read_table(spark, base, "customer")
    m7 = F.col("c_custkey") % 7
    return c.where(F.col("c_mktsegment") != "BUILDING").select(
        _imo_of(F.col("c_custkey")).alias("imo"),
        F.when(m7 == 0, 82).when(m7 == 1, 70).when(m7 == 2, 60).when(m7 == 3, 0).otherwise(30).cast("int").alias("vessel_type"),
        (F.lit(1980) + F.col("c_custkey") % 50).cast("int").alias("build_year"),
        (F.col("c_custkey") % 23 == 0).alias("scrapped"),
    )


def vessel_reviews(spark: SparkSession, base: str) -> DataFrame:
    ev = read_table(spark, base, "events")
    et = F.col("event_type")
    return ev.select(
        _mmsi_of(F.col("user_id")).alias("mmsi"),
        F.when(et == "purchase", "confirmed").when(et == "signup", "probable").when(et == "click", "suspect")
        .when(et == "view", "cleared").otherwise("inconclusive").alias("review_tier"),
        F.col("ts").cast("timestamp").alias("reviewed_at"),
    )


def ranked_items(spark: SparkSession, base: str) -> DataFrame:
    d = read_table(spark, base, "documents").select("doc_id", "source", "lang", "n_chars")
    lab = read_table(spark, base, "labels").select("doc_id", "quality")
    return d.join(lab, "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("mmsi"),
        F.col("source").alias("vessel_type"),
        F.col("lang").alias("region"),
        ((F.col("n_chars") % 1000) / F.lit(1000.0)).alias("confidence"),
        F.col("quality").alias("y_true"),
    )


def designations(spark: SparkSession, base: str) -> DataFrame:
    c = read_table(spark, base, "customer").where(F.col("c_mktsegment").isin("MACHINERY", "FURNITURE"))
    return c.select(
        _mmsi_of(F.col("c_custkey")).alias("mmsi"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp")
         + F.make_dt_interval(days=(F.col("c_custkey") % 90).cast("int"))
         - F.expr("INTERVAL 30 DAYS")).alias("first_seen"),
    )


ADAPTERS = {
    "ais_positions": ais_positions,
    "vessel_meta": vessel_meta,
    "detections": detections,
    "sanctions_entities": sanctions_entities,
    "owned_by": owned_by,
    "managed_by": managed_by,
    "controlled_by": controlled_by,
    "registered_in": registered_in,
    "registered_at": registered_at,
    "trade_flow": trade_flow,
    "equasis_vessel_ref": equasis_vessel_ref,
    "vessel_reviews": vessel_reviews,
    "ranked_items": ranked_items,
    "designations": designations,
}


class Fixtures:
    """Lazily built adapter views over one landed-table directory."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in ADAPTERS:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = ADAPTERS[name](self.spark, self.base)
        return self._cache[name]
