"""Request rates and alerts over a live request log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from simsearch.operators.requests import alerts, count_windows
from simsearch.sources.tables import REQUEST_LOG, conform


def rate_stream(log: DataFrame, window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Counts per window, endpoint and status. Repeats of a request id are dropped, and rows later
    than ``delay`` are too; a window is emitted once, when the watermark has passed its end.

    The watermark bounds both the remembered ids and the open windows.
    """
    timed = conform(log, REQUEST_LOG, optional=("method", "latency")).withWatermark("ts", delay)
    return count_windows(timed.dropDuplicatesWithinWatermark(["request_id"]), window)


def start_rates(
    log: DataFrame,
    output: str,
    checkpoint: str,
    window: str = "1 hour",
    delay: str = "10 minutes",
    threshold: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write closed windows to ``output``; with a threshold, only those above it."""
    windows = rate_stream(log, window, delay)
    if threshold is not None:
        windows = alerts(windows, threshold)
    writer = windows.writeStream.format("parquet").outputMode("append").option("path", output)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
