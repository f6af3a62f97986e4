"""Tumbling-window counts, on tables and on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def tumbling_counts(rows: DataFrame, ts: str, key: str, length: str = "1 hour") -> DataFrame:
    return (
        rows.groupBy(F.window(ts, length).alias("w"), key)
        .agg(F.count("*").alias("event_count"))
        .select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key,
            "event_count",
        )
    )
