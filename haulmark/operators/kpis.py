"""Delivery updates counted per minute and status, for streams and tables alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# One-minute windows, two minutes of tolerance for late rows.
WINDOW = "1 minute"
LATE_BY = "2 minutes"

COUNT_KEY = ("window_start", "window_end", "status")


def status_counts(
    updates: DataFrame, *, time: str = "timestamp", window: str = WINDOW, late_by: str = LATE_BY
) -> DataFrame:
    """``window_start, window_end, status, delivery_count, kpi_calculated_at``.

    Windows start on the epoch grid and exclude their end; rows without an event
    time are in none. On a stream a window is dropped from state once the
    watermark passes its end; on a table the watermark has no effect. Counts are
    combined before the shuffle, so a hot status or minute costs one row per task.
    """
    return (
        updates.withWatermark(time, late_by)
        .groupBy(F.window(time, window), "status")
        .agg(F.count(F.lit(1)).alias("delivery_count"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "status",
            "delivery_count",
            F.current_timestamp().alias("kpi_calculated_at"),
        )
    )
