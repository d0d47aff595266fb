"""Streaming queries (ST1-ST5) run with an availableNow trigger over the landed events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..oracle import with_views
from ..streaming import positions as S
from .registry import finish, register


@register("stream_dedup", with_views("ais_positions") + """SELECT DISTINCT mmsi, timestamp FROM ais_positions
WHERE mmsi IS NOT NULL AND timestamp IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL""")
def q_stream_dedup(spark, base):
    """ST1-ST3: ingest the event stream into a date-partitioned table, insert-or-ignore on (mmsi, timestamp)."""
    table = S.scratch_path(spark, "positions")
    q = S.ingest_positions(S.position_stream(spark, base), table, S.scratch_path(spark, "ckpt-ingest"))
    q.awaitTermination()
    return spark.read.parquet(table).select("mmsi", "timestamp")


@register("stream_gap_alerts", with_views("ais_positions", extra=[
    ("lg", "SELECT mmsi, timestamp, lag(timestamp) OVER (PARTITION BY mmsi ORDER BY timestamp) AS prev FROM ais_positions"),
]) + """SELECT mmsi, prev AS gap_start, timestamp AS gap_end, (epoch_us(timestamp) - epoch_us(prev)) // 60000000 AS gap_minutes
FROM lg WHERE prev IS NOT NULL AND (epoch_us(timestamp) - epoch_us(prev)) // 60000000 > 600""")
def q_stream_gap_alerts(spark, base):
    """ST4: per-vessel spans as state; the alerts of gaps longer than 10 h that hold after all files."""
    out = S.scratch_path(spark, "gap-alerts")
    q = S.run_gap_alerts(S.position_stream(spark, base), out, S.scratch_path(spark, "ckpt-gaps"))
    q.awaitTermination()
    return finish(S.current_alerts(spark.read.parquet(out)))
