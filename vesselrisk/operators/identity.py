"""Registry-based identity (F12) and trade-flow (F11) features."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C


def ship_type_category(x: Column) -> Column:
    """1 fishing, 2 service, 3 passenger, 4 cargo, 5 tanker, 0 unknown/other."""
    return (
        F.when(x.isNull(), 0).when(x == 30, 1).when(x.between(31, 57), 2).when(x.between(60, 69), 3)
        .when(x.between(70, 79), 4).when(x.between(80, 89), 5).otherwise(0)
    )


def ship_type_label(x: Column) -> Column:
    """P4 label: Tanker / Cargo / Passenger / Unknown / 'Type n'."""
    return (
        F.when(x.between(80, 89), "Tanker").when(x.between(70, 79), "Cargo").when(x.between(60, 69), "Passenger")
        .when(x == 0, "Unknown").otherwise(F.concat(F.lit("Type "), x.cast("string")))
    )


def imo_mismatch(vessel_meta: DataFrame, vessel_ref: DataFrame, as_of: dt.datetime = C.FIXTURE_AS_OF) -> DataFrame:
    """type-category mismatch, scrapped flag and build-year-in-future flag per vessel."""
    meta = vessel_meta.where(F.col("mmsi").isNotNull()).select(
        "mmsi", F.coalesce("imo", F.lit("")).alias("imo"), F.col("ship_type").alias("ais_type")
    )
    ref = vessel_ref.select("imo", "vessel_type", "build_year", "scrapped")
    j = meta.where(F.col("imo") != "").join(ref, "imo", "left")
    a = ship_type_category(F.col("ais_type"))
    e = ship_type_category(F.col("vessel_type"))
    res = j.select(
        "mmsi",
        ((a != 0) & (e != 0) & (a != e)).alias("imo_type_mismatch"),
        F.coalesce(F.col("scrapped"), F.lit(False)).alias("imo_scrapped_flag"),
        F.coalesce(F.col("build_year") > F.lit(as_of.year), F.lit(False)).alias("imo_under_construction_flag"),
    )
    cols = ["imo_type_mismatch", "imo_scrapped_flag", "imo_under_construction_flag"]
    return meta.select("mmsi").join(res, "mmsi", "left").select(
        "mmsi", *[F.coalesce(F.col(c), F.lit(False)).alias(c) for c in cols]
    )


def trade_mismatch(
    vessel_meta: DataFrame,
    trade_flow: DataFrame,
    reporter: str = C.TRADE_REPORTER,
    hs_code: str = C.TRADE_HS_CODE,
) -> DataFrame:
    """route_cargo_mismatch and declared_vs_estimated_cargo_value per vessel.

    Tankers flagged to a sanctioned exporter: mismatch 1.0 when the reporter
    has no trade with that flag, else 0.0 with value = trade / vessels with
    that flag. Flags are free text, so the joins carry no hint; adaptive
    execution broadcasts the two tables when they turn out small.
    """
    vm = vessel_meta.where(F.col("mmsi").isNotNull()).select(
        "mmsi", F.coalesce("flag", F.lit("")).alias("flag"), F.coalesce("ship_type", F.lit(0)).alias("ship_type")
    )
    trade = (
        trade_flow.where((F.col("reporter") == reporter) & (F.col("hs_code") == hs_code))
        .groupBy(F.col("partner").alias("flag")).agg(F.sum("trade_value_usd").alias("total_usd"))
    )
    counts = vm.groupBy("flag").agg(F.count(F.lit(1)).alias("vessel_count"))
    j = vm.join(counts, "flag", "left").join(trade, "flag", "left")
    hit = F.col("ship_type").isin(*C.TANKER_TYPES) & F.col("flag").isin(*C.SANCTIONED_EXPORTERS)
    tv = F.coalesce("total_usd", F.lit(0.0))
    return j.select(
        "mmsi",
        F.when(hit, F.when(tv > 0, 0.0).otherwise(1.0)).otherwise(0.0).alias("route_cargo_mismatch"),
        F.when(hit & (tv > 0), tv / F.coalesce("vessel_count", F.lit(1))).otherwise(0.0).alias("declared_vs_estimated_cargo_value"),
    )
