"""Session helpers: UTC time zone, AQE, and a shared checkpoint directory."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. ``ensure_conf`` only fills them in where the
# cluster has not set them, so a production session keeps its own values.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A batch of long texts is held by Spark and by the Python worker at once.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "vesselrisk") -> SparkSession:
    """Local session for tests and the bench (UI off, small shuffle width)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("VR_DRIVER_MEMORY", "16g"))
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32m")
    )
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Apply DEFAULT_CONF where unset and make sure a checkpoint dir exists."""
    for k, v in DEFAULT_CONF.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
    # Session time zone must be UTC for every timestamp operator here.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors once per context, so that tasks can import it from any working folder."""
    sc = spark.sparkContext
    if getattr(sc, "_vesselrisk_shipped", False):
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="vr-package-")) / "vesselrisk_package.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
    sc._vesselrisk_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared ``spark.checkpoint.dir``; a scratch folder only when unset on a local master (tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="vr-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint dir (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
