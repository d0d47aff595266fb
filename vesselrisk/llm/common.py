"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, cut_lineage
from ..sources.tables import read_table

# White space of the word definitions: space and the code points 9 to 13.
WS_CLASS = "[ \\t-\\r]+"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared checkpoint directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table under the shared checkpoint directory: worked out once, and later plans begin at its files."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pack(df: DataFrame, name: str = "row") -> DataFrame:
    """All columns as one struct, so that operator columns never clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))


def unpack(df: DataFrame, columns: list[str], name: str = "row") -> DataFrame:
    return df.select(*[F.col(f"{name}.`{c}`").alias(c) for c in columns])


def replaced(df: DataFrame, outputs: list[str]) -> list[Column]:
    """The input's columns but those whose names an output takes (names compare without case)."""
    taken = {c.lower() for c in outputs}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]


def word_array(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WS_CLASS), "")


__all__ = ["WS_CLASS", "checkpoint_dir", "cut_lineage", "pack", "read_table", "replaced", "shared_path", "unpack", "word_array", "written"]
