"""Incremental abundance over an event stream: tumbling windows with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, window: str = "1 hour", late: str = "30 minutes", feature: str = "event_type", time: str = "ts", value: str = "value") -> DataFrame:
    """reads and their value per window and feature; runs on batch and streaming tables alike."""
    marked = events.withWatermark(time, late) if events.isStreaming else events
    return marked.groupBy(F.window(time, window), feature).agg(F.count("*").alias("reads"), F.sum(value).alias("total")).select(F.col("window.start").alias("start"), F.col(feature).alias("feature"), "reads", "total")
