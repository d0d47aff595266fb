"""Continuous position ingest and gap alerts on Structured Streaming.

* ``ingest_positions`` (ST1-ST3): bbox filter, then an insert-or-ignore
  ``foreachBatch`` into a date-partitioned Parquet table. There is no watermark
  and no dedup state: rows may come at any time later and are stored once.
  Duplicates are found within the micro-batch and by an anti-join that reads
  only the table's partitions of the dates that the batch holds.
* ``gap_alerts`` (ST4): the state of a vessel is its spans without a gap over the
  threshold, kept with ``applyInPandasWithState``. A fix may come at any time: one
  inside a gap that was alerted takes that alert back and sends the gaps that are
  left, so ``current_alerts`` is the same for every order of arrival. Fixes are
  folded to one span a vessel and threshold-long slot before the shuffle, so a
  group holds a few rows of a vessel however often it reports.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import config as C
from ..functions.geo import in_bbox
from ..session import checkpoint_dir
from ..sources.fixtures import positions_from_events
from ..sources.sinks import insert_or_ignore

EVENT_SCHEMA = "event_id long, user_id long, event_type string, ts timestamp_ntz, value double, props string"


def event_stream(spark: SparkSession, base: str, max_files_per_trigger: int = 64) -> DataFrame:
    """Landed ``events`` files as a stream (a directory of parts, or one file in ``base``)."""
    path = f"{base.rstrip('/')}/events.parquet"
    reader = spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
    # The file system that the path belongs to decides, not the driver's disk.
    landed = spark._jvm.org.apache.hadoop.fs.Path(path)
    if landed.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(landed).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", "events.parquet").parquet(base)


def position_stream(spark: SparkSession, base: str) -> DataFrame:
    return positions_from_events(event_stream(spark, base))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir (never machine-local on a cluster)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def ingest_positions(positions: DataFrame, table_path: str, checkpoint: str, bbox=None,
                     available_now: bool = True, interval: str = "60 seconds"):
    """ST1-ST3: start the ingest query; returns the StreamingQuery. Late rows are always accepted."""
    s = positions.where(F.col("mmsi").isNotNull() & F.col("timestamp").isNotNull()
                        & F.col("lat").isNotNull() & F.col("lon").isNotNull())
    if bbox is not None:
        s = s.where(in_bbox(F.col("lat"), F.col("lon"), bbox))

    def write(batch: DataFrame, _batch_id: int) -> None:
        insert_or_ignore(batch.withColumn("date", F.to_date("timestamp")), table_path, ["mmsi", "timestamp"], ["date"])

    w = s.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


ALERT_SCHEMA = "mmsi string, gap_start timestamp, gap_end timestamp, gap_minutes long, change int"
SPAN_SCHEMA = "mmsi string, first_us long, last_us long"
STATE_SCHEMA = "first_us array<long>, last_us array<long>"
MINUTE_US = 60_000_000


def _fold(threshold_min: float):
    """(mmsi, us) to the first and last fix of each vessel and slot; no gap within a slot is over the threshold."""
    slot = max(int(threshold_min), 1) * MINUTE_US

    def fn(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in pdfs:
            spans = p.groupby(["mmsi", p["us"] // slot], sort=False)["us"].agg(["min", "max"])
            yield pd.DataFrame({"mmsi": spans.index.get_level_values(0), "first_us": spans["min"].to_numpy(), "last_us": spans["max"].to_numpy()})

    return fn


def merge_spans(first: np.ndarray, last: np.ndarray, threshold_min: float) -> tuple[np.ndarray, np.ndarray]:
    """Spans joined wherever at most ``threshold_min`` truncated minutes lie between them."""
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(last[order])
    apart = (first[1:] - reach[:-1]) // MINUTE_US > threshold_min
    return first[np.concatenate([[True], apart])], reach[np.concatenate([apart, [True]])]


def _gap_state(threshold_min: float):
    def fn(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        old = [np.asarray(x, np.int64) for x in state.get] if state.exists else [np.empty(0, np.int64)] * 2
        new = [p[["first_us", "last_us"]].to_numpy(np.int64) for p in pdfs]
        joined = [np.concatenate([o, *(n[:, i] for n in new)]) for i, o in enumerate(old)]
        if not len(joined[0]):
            return
        first, last = merge_spans(*joined, threshold_min)
        before = set(zip(old[1][:-1].tolist(), old[0][1:].tolist()))
        after = set(zip(last[:-1].tolist(), first[1:].tolist()))
        rows = [(a, b, -1) for a, b in sorted(before - after)] + [(a, b, 1) for a, b in sorted(after - before)]
        state.update((first.tolist(), last.tolist()))
        start, end, change = (np.array([r[i] for r in rows], np.int64) for i in range(3))
        yield pd.DataFrame({
            "mmsi": [key[0]] * len(rows),
            "gap_start": pd.to_datetime(start, unit="us"),
            "gap_end": pd.to_datetime(end, unit="us"),
            "gap_minutes": (end - start) // MINUTE_US,
            "change": change.astype("int32"),
        })

    return fn


def gap_alerts(positions: DataFrame, gap_threshold_h: float = C.GAP_THRESHOLD_H) -> DataFrame:
    """ST4: changes of a vessel's gaps longer than the threshold (truncated minutes), in whatever order its fixes come.

    ``change`` is 1 for a new alert and -1 for one that a later arrival takes back. Fixes without a vessel or a time have no part.
    """
    fixes = positions.where(F.col("mmsi").isNotNull() & F.col("timestamp").isNotNull())
    fixes = fixes.select(F.col("mmsi").cast("string").alias("mmsi"), F.unix_micros(F.col("timestamp").cast("timestamp")).alias("us"))
    minutes = gap_threshold_h * 60
    return fixes.mapInPandas(_fold(minutes), SPAN_SCHEMA).groupBy("mmsi").applyInPandasWithState(
        _gap_state(minutes), ALERT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout,
    )


def current_alerts(changes: DataFrame) -> DataFrame:
    """The alerts that hold after all changes; a gap that was taken back cannot come again."""
    gap = ["mmsi", "gap_start", "gap_end", "gap_minutes"]
    return changes.groupBy(*gap).agg(F.sum("change").alias("holds")).where("holds > 0").select(*gap)


def run_gap_alerts(positions: DataFrame, out_path: str, checkpoint: str, gap_threshold_h: float = C.GAP_THRESHOLD_H,
                   available_now: bool = True, interval: str = "60 seconds"):
    w = gap_alerts(positions, gap_threshold_h).writeStream.format("parquet").option("path", out_path).option(
        "checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()
