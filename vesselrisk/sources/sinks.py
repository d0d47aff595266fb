"""Table writes: insert-or-ignore (K1), upsert (K2), date-partition export (K6), rolling history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage


def _read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


MAX_LISTED_PARTITIONS = 1000


def _only_partitions_of(existing: DataFrame, batch: DataFrame, column: str) -> DataFrame:
    """Rows of the table in partitions that the batch has; a batch over more partitions reads the whole table."""
    values = [r[0] for r in batch.select(column).distinct().limit(MAX_LISTED_PARTITIONS + 1).collect()]
    if len(values) > MAX_LISTED_PARTITIONS:
        return existing
    hit = F.col(column).isin([v for v in values if v is not None])
    return existing.where(hit | F.col(column).isNull() if None in values else hit)


def insert_or_ignore(new: DataFrame, path: str, keys: list[str], partition_by: list[str] | None = None,
                     order_by: list[str] | None = None) -> int:
    """K1: append rows whose key is not stored yet (first writer wins); returns the net new row count.

    Of the batch's rows with one key the first by ``order_by`` stays (default: in
    load order). The anti-join carries the partition columns when given, and the
    table is filtered by the batch's values of the first of them.
    """
    spark = new.sparkSession
    first = F.struct(*order_by) if order_by else F.col("_at")
    row = F.struct(*[F.col(c) for c in new.columns])
    # Materialise once so the partition list, the count and the write see the same rows.
    cand = cut_lineage(
        new.withColumn("_at", F.monotonically_increasing_id()).groupBy(*keys).agg(F.min_by(row, first).alias("_row")).select("_row.*"))
    existing = _read_or_none(spark, path)
    join_keys = list(dict.fromkeys((partition_by or []) + keys))
    if existing is not None:
        stored = existing.select(*join_keys)
        if partition_by:
            stored = _only_partitions_of(stored, cand, partition_by[0])
        stored = stored.withColumnsRenamed({k: f"_o_{k}" for k in join_keys})
        same = [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in join_keys]
        cand = cut_lineage(cand.join(stored, same, "left_anti"))
    n = cand.count()
    w = cand.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return n


def _one_per_key(new: DataFrame, key: str, overwrite: tuple[str, ...]) -> DataFrame:
    """A batch's last value of each column per key, in load order; nulls only count in ``overwrite`` columns."""
    at = F.col("_at")
    last = [
        (F.max_by(F.struct(c), at)[c] if c in overwrite else F.max_by(c, F.when(F.col(c).isNotNull(), at))).alias(c)
        for c in new.columns if c != key
    ]
    keyed = new.where(F.col(key).isNotNull()).withColumn("_at", F.monotonically_increasing_id())
    return keyed.groupBy(key).agg(*last) if last else keyed.select(key).distinct()


def upsert(new: DataFrame, old: DataFrame, key: str, overwrite: tuple[str, ...] = ()) -> DataFrame:
    """K2: full outer join on ``key``; each column = COALESCE(new, old) except ``overwrite`` columns (new wins).

    The batch is reduced to one row per key first; rows without a key can not be stored and are left out.
    """
    cols = [c for c in old.columns if c != key]
    one = _one_per_key(new, key, overwrite)
    n = one.select(key, F.lit(True).alias("_in_new"), *[F.col(c).alias(f"n_{c}") for c in cols if c in new.columns])
    o = old.select(key, *[F.col(c).alias(f"o_{c}") for c in cols])
    j = n.join(o, key, "full_outer").withColumn("_in_new", F.coalesce("_in_new", F.lit(False)))
    out = [F.col(key)]
    for c in cols:
        if c not in new.columns:
            out.append(F.col(f"o_{c}").alias(c))
        elif c in overwrite:
            # Rows present in the new batch always take its value, null included.
            out.append(F.when(F.col("_in_new"), F.col(f"n_{c}")).otherwise(F.col(f"o_{c}")).alias(c))
        else:
            out.append(F.coalesce(F.col(f"n_{c}"), F.col(f"o_{c}")).alias(c))
    return j.select(*out)


def export_by_date(positions: DataFrame, path: str, today: dt.date | None = None, files_per_run: int = 16) -> DataFrame:
    """K6: write UTC date partitions that are not present yet, rows sorted by (mmsi, timestamp).

    Returns the row counts per date of this run. Rows without a timestamp belong to no day: they are not
    written, and are counted under a null date. Rows are dealt by ranges of (date, mmsi, timestamp), so a
    large day is split over tasks. When nothing is new for ``today`` an empty sentinel
    partition is written so readers see the day exists.
    """
    spark = positions.sparkSession
    dated = positions.withColumn("date", F.to_date("timestamp"))
    existing = _read_or_none(spark, path)
    if existing is not None:
        dated = dated.join(existing.select("date").distinct(), "date", "left_anti")
    counts = cut_lineage(dated.groupBy("date").agg(F.count(F.lit(1)).alias("rows")))
    order = ["date", "mmsi", "timestamp"]
    whole = dated.where(F.col("date").isNotNull())
    whole.repartitionByRange(files_per_run, *order).sortWithinPartitions(*order).write.mode("append").partitionBy("date").parquet(path)
    if today is not None and spark.read.parquet(path).where(F.col("date") == F.lit(today)).isEmpty():
        positions.limit(0).write.mode("append").parquet(f"{path.rstrip('/')}/date={today.isoformat()}")
    return counts


def score_history(history: DataFrame | None, today_scores: DataFrame, today: dt.date, keep_days: int = 30) -> DataFrame:
    """Replace today's rows, append, keep ``score_date >= today - keep_days``."""
    t = today_scores.withColumn("score_date", F.lit(today))
    if history is not None:
        t = history.where(F.col("score_date") != F.lit(today)).unionByName(t, allowMissingColumns=True)
    return t.where(F.col("score_date") >= F.lit(today - dt.timedelta(days=keep_days)))
