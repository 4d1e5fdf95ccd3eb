"""Streaming forms of key dedup and rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_keys(changes: DataFrame, ts: str = "ts", within: str = "10 minutes") -> DataFrame:
    """Each (db_id, key) once in the time given: the state of older keys is dropped by the watermark."""
    return changes.withWatermark(ts, within).dropDuplicatesWithinWatermark(["db_id", "key"])


def windowed_counts(entries: DataFrame, ts: str = "ts", window: str = "5 minutes", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Entries by command in tumbling (or sliding) windows; rows later than ``late`` behind are dropped."""
    w = F.window(ts, window, slide) if slide else F.window(ts, window)
    return entries.withWatermark(ts, late).groupBy(w.alias("w"), "cmd_name").agg(F.count("*").alias("n")).select("w.start", "w.end", "cmd_name", "n")
