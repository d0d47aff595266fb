"""Reader queries (S1, S9): files written from the adapter views, read back by the loaders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..oracle import with_views
from ..sources import readers
from ..sources.fixtures import Fixtures
from ..streaming.positions import scratch_path
from .registry import finish, register


@register("csv_load", with_views("ais_positions") + """SELECT mmsi, timestamp, lat, lon, round(CAST(CAST(sog AS FLOAT) AS DOUBLE), 4) AS sog,
  CAST(COALESCE(nav_status, 0) AS BIGINT) AS nav_status, CAST(COALESCE(ship_type, 0) AS BIGINT) AS ship_type
FROM ais_positions WHERE mmsi IS NOT NULL AND timestamp IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL""")
def q_csv_load(spark, base):
    """Positions written in the provider CSV layout, then loaded through the column map."""
    path = scratch_path(spark, "ais-csv")
    pos = Fixtures(spark, base).ais_positions
    pos.select(
        F.col("mmsi").alias("MMSI"), F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("BaseDateTime"),
        F.col("lat").alias("LAT"), F.col("lon").alias("LON"), F.col("sog").alias("SOG"), F.col("cog").alias("COG"),
        F.col("nav_status").alias("Status"), F.col("ship_type").alias("VesselType"),
    ).write.option("header", True).csv(path)
    out = readers.read_ais_csv(spark, path)
    return finish(out.select("mmsi", "timestamp", "lat", "lon", F.round(F.col("sog").cast("double"), 4).alias("sog"),
                             "nav_status", "ship_type"))


@register("ftm_flatten", with_views("sanctions_entities") + """SELECT entity_id, name, mmsi, imo, flag, type,
  array_to_string(list_sort(list_distinct(string_split(list_source, ';'))), ';') AS list_source
FROM sanctions_entities""")
def q_ftm_flatten(spark, base):
    """Sanctions entities written as FtM JSON lines (imo with its 'IMO' prefix), then parsed."""
    path = scratch_path(spark, "ftm")
    se = Fixtures(spark, base).sanctions_entities
    props = F.create_map(
        F.lit("name"), F.array("name"), F.lit("mmsi"), F.array("mmsi"),
        F.lit("imoNumber"), F.array(F.concat(F.lit("IMO"), F.col("imo"))), F.lit("country"), F.array("flag"),
    )
    se.select(F.to_json(F.struct(
        F.col("entity_id").alias("id"), F.col("type").alias("schema"), F.col("name").alias("caption"),
        F.split("list_source", ";").alias("datasets"), props.alias("properties"),
    )).alias("value")).write.text(path)
    return readers.read_ftm_entities(spark, path)


@register("registry_csv", with_views("equasis_vessel_ref") + """SELECT imo,
  CAST(CASE WHEN vessel_type = 0 THEN NULL ELSE vessel_type END AS DOUBLE) AS vessel_type, CAST(build_year AS DOUBLE) AS build_year,
  COALESCE(scrapped, false) AS scrapped
FROM equasis_vessel_ref
WHERE imo IS NOT NULL AND imo <> '' AND (vessel_type <> 0 OR build_year IS NOT NULL OR scrapped)""")
def q_registry_csv(spark, base):
    """The reference table written as a registry CSV (type 0 left blank, scrapped as yes/no), then read."""
    path = scratch_path(spark, "registry-csv")
    ref = Fixtures(spark, base).equasis_vessel_ref
    ref.select(
        "imo", F.when(F.col("vessel_type") != 0, F.col("vessel_type").cast("string")).alias("vessel_type"),
        F.col("build_year").cast("string").alias("build_year"),
        F.when(F.col("scrapped"), F.lit("Yes")).otherwise(F.lit("no")).alias("scrapped"),
    ).write.option("header", True).csv(path)
    out = readers.read_registry_csv(spark, path)
    return finish(out.withColumn("vessel_type", F.col("vessel_type").cast("double"))
                  .withColumn("build_year", F.col("build_year").cast("double")))
