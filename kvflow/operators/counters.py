"""Counts of entries: totals, by command, rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def total(entries: DataFrame) -> DataFrame:
    return entries.agg(F.count("*").alias("total_entries"))


def by_command(entries: DataFrame) -> DataFrame:
    return entries.groupBy("group", "cmd_name").agg(F.count("*").alias("n"))


def hourly_rate(events: DataFrame, ts: str = "ts") -> DataFrame:
    """hour, n, per_second, change: entries of each hour and the difference from the hour before."""
    hours = events.groupBy(F.date_trunc("hour", F.col(ts)).alias("hour")).agg(F.count("*").alias("n"))
    before = F.lag("n").over(Window.orderBy("hour"))  # one row an hour
    return hours.select("hour", "n", (F.col("n") / 3600.0).alias("per_second"), (F.col("n") - before).alias("change"))


def consistency(shards: DataFrame) -> DataFrame:
    """source_id, received, sent -> one row: consistent when every shard has sent what it received; and the bytes open."""
    return shards.agg(F.bool_and(F.col("received") == F.col("sent")).alias("consistent"), F.sum(F.col("received") - F.col("sent")).alias("unanswered_bytes"))
