"""Registry of named queries (Spark) and their DuckDB oracle SQL.

Each query takes ``(spark, base_dir)`` and returns a DataFrame over the whole
landed tables. Numeric outputs are normalised for comparison: counts BIGINT,
ratios/measures DOUBLE rounded to 6 places (``finish``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles/floats, widen integers to BIGINT (comparison-friendly output)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)
