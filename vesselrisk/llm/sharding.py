"""Sharding by a two-pass external shuffle, in DataFrame operations only.

Pass 1 scatters the records uniformly over memory-sized buckets by a seeded hash
of the record's key; Spark's exchange holds the buckets on disk. Pass 2 takes one
bucket at a time, shuffles it by Fisher-Yates (``shuffle`` of Spark SQL) and writes it.
The shuffled buckets one after another are a random order of all records; shard
``s`` takes the positions ``[ceil(s*N/S), ceil((s+1)*N/S))`` of it, so shard sizes
differ by one row at most and a bucket's task writes into one shard, or two.

A key with more rows than a mean bucket is hot: its rows are spread over all
buckets by a second hash of the row's place. There are fewer hot keys than
buckets, which bounds the table of them. The rows of hot keys are written with their
places first and read from there, as a later scan may number them otherwise; the bucket
of any other row depends on its key alone.

Defined results: an empty table gives an empty one; null keys form one key; null
texts count as empty; repeated rows are records of their own; an input column called
like a result column (``shard``, ``slot``) is replaced; other extra columns stay.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, replaced, shared_path

BUCKET_BYTES = 32 << 20


def write_shards(
    rows: DataFrame,
    n_shards: int,
    key: str = "doc_id",
    text: str = "text",
    seed: int = 17,
    bucket_bytes: int = BUCKET_BYTES,
    path: str | None = None,
) -> DataFrame:
    """Writes ``rows`` as Parquet under ``path`` (one folder a shard) and returns the table read back.

    Adds ``shard`` (int) and ``slot`` (long, gapless from 0 within the shard, the order in the files).
    """
    spark = rows.sparkSession
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 1
    keyed = rows.select(F.xxhash64(F.lit(seed), F.col(key)).alias("h"), size.alias("b"))
    total = keyed.agg(F.count("*").alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("b")).first()
    n, n_buckets = total["n"], max(1, math.ceil(total["b"] / bucket_bytes))

    hot = cut_lineage(keyed.groupBy("h").count().where(F.col("count") * n_buckets > n).where("count > 1").select("h"))
    payload = F.struct(*replaced(rows, ["shard", "slot"]))
    numbered = rows.select(F.xxhash64(F.lit(seed), F.col(key)).alias("h"), F.monotonically_increasing_id().alias("at"), payload.alias("row"))
    spread = numbered.withColumn("spread", F.col("h"))
    if not hot.isEmpty():
        hot_path = shared_path(spark, "hot")
        numbered.join(F.broadcast(hot), "h", "left_semi").write.parquet(hot_path)
        dealt = spark.read.schema(numbered.schema).parquet(hot_path).withColumn("spread", F.xxhash64(F.lit(seed + 1), "h", "at"))
        spread = spread.join(F.broadcast(hot), "h", "left_anti").unionByName(dealt)
    placed = spread.withColumn("bucket", F.pmod("spread", F.lit(n_buckets)).cast("int"))
    # One row a bucket: where the bucket begins in the order of all records.
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut_lineage(
        placed.groupBy("bucket").count().select("bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    )

    in_order = F.array_sort(
        F.collect_list(F.struct("spread", "at", "row")),
        lambda a, b: F.when(a["spread"] != b["spread"], F.when(a["spread"] < b["spread"], -1).otherwise(1)).otherwise(
            F.when(a["at"] < b["at"], -1).when(a["at"] > b["at"], 1).otherwise(0)
        ),
    )
    shuffled = (
        placed.repartitionById(n_buckets, F.col("bucket"))  # a task holds one bucket, and its number seeds the shuffle
        .groupBy("bucket")
        .agg(in_order.alias("records"))
        .join(F.broadcast(starts), "bucket")  # one (int, long) a bucket
        .select("start", F.posexplode(F.shuffle("records", seed)).alias("at", "record"))
    )
    place = F.col("start") + F.col("at")
    out = shuffled.select(place.alias("place"), "record.row")
    shard = F.expr(f"(place * {n_shards}L) div {max(n, 1)}L")
    first = F.expr(f"(shard * {n}L + {n_shards - 1}L) div {n_shards}L")
    out = out.withColumn("shard", shard).withColumn("slot", F.col("place") - first)
    path = path or shared_path(spark, "shards")
    out.select("row.*", F.col("shard").cast("int").alias("shard"), "slot").write.partitionBy("shard").parquet(path)
    schema = out.select("row.*", "slot", F.col("shard").cast("int").alias("shard")).schema
    return spark.read.schema(schema).parquet(path)
