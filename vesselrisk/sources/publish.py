"""K3, K7, K8: publish a table behind a gate. A failed gate leaves the old version readable.

A batch is written to a folder of its own (staged), checked there in one pass, and becomes the
current version by one row in the table's log, which Spark commits as one file. Readers
follow the newest log row, so they see the old version whole or the new one whole; an executor or
driver that is lost half-way leaves an unreferenced folder and the old version.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = "version long, path string, rows long, published_at timestamp"


@dataclass
class Outcome:
    """What a publish attempt did: ``status`` is published, rejected or skipped (an optional table that failed its gate)."""

    status: str
    rows: int = 0
    version: int | None = None
    problems: list[str] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return self.status != "rejected"


def versions(spark: SparkSession, root: str) -> DataFrame:
    """The table's log, empty before the first version."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(f"{root}/log")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def newest(spark: SparkSession, root: str):
    return versions(spark, root).orderBy(F.desc("version"), F.desc("published_at"), F.desc("path")).first()


def read_published(spark: SparkSession, root: str) -> DataFrame:
    current = newest(spark, root)
    if current is None:
        raise FileNotFoundError(f"nothing is published under {root}")
    return spark.read.parquet(current.path)


def problems_of(staged: DataFrame, required: list[str], min_rows: int, checks: dict[str, Column], key: list[str] | None) -> tuple[int, list[str]]:
    """(rows, what is wrong): missing or null required columns, too few rows, rows that break a check, repeated keys."""
    missing = [c for c in required if c not in staged.columns]
    if missing:
        return 0, [f"missing column {c}" for c in missing]
    parts = [F.count("*").alias("n")]
    parts += [F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(f"null {c}") for c in required]
    parts += [F.count(F.when(~F.coalesce(ok, F.lit(False)), 1)).alias(f"breaks {name}") for name, ok in checks.items()]
    found = staged.agg(*parts).first().asDict()
    n = found.pop("n")
    wrong = [f"{what}: {count} rows" for what, count in found.items() if count]
    if n < min_rows:
        wrong.append(f"{n} rows, {min_rows} asked for")
    if key and staged.groupBy(*key).count().where("count > 1").limit(1).count():
        wrong.append(f"repeated key {', '.join(key)}")
    return n, wrong


def publish(df: DataFrame, root: str, required: list[str], min_rows: int = 1, checks: dict[str, Column] | None = None,
            key: list[str] | None = None, optional: bool = False) -> Outcome:
    """Validate, stage, swap. ``optional`` tables that fail are skipped and reported as fine."""
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/data/{uuid.uuid4().hex}"
    df.write.parquet(path)
    n, wrong = problems_of(spark.read.parquet(path), required, min_rows, checks or {}, key)
    if wrong:
        return Outcome("skipped" if optional else "rejected", n, None, wrong)
    last = newest(spark, root)
    version = 1 if last is None else last.version + 1
    row = spark.range(1).select(F.lit(version).cast("long").alias("version"), F.lit(path).alias("path"), F.lit(n).cast("long").alias("rows"), F.current_timestamp().alias("published_at"))
    row.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/log")
    return Outcome("published", n, version)


def publish_features(matrix: DataFrame, root: str, columns: list[str], min_rows: int = 1) -> Outcome:
    """K3: the whole feature matrix, each of its ``columns``, with the time it was worked out, in place of the last one."""
    out = matrix.select("mmsi", *columns).withColumn("last_computed", F.current_timestamp())
    return publish(out, root, ["mmsi", *columns], min_rows, key=["mmsi"])


def publish_vessel_meta(meta: DataFrame, root: str, min_rows: int = 1) -> Outcome:
    """K7: the registry snapshot: digits-only ids of nine digits, one row a vessel."""
    checks = {"mmsi of nine digits": F.col("mmsi").rlike("^[0-9]{9}$"), "imo of digits": F.col("imo").isNull() | F.col("imo").rlike("^[0-9]*$")}
    return publish(meta, root, ["mmsi"], min_rows, checks, ["mmsi"])
