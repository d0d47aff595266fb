"""Reading the landed parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """``{base}/{name}.parquet`` (a file or a directory of part files)."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")
