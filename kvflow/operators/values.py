"""Materialised values and scanned keys: value to commands, key dedup, time to live, large values, pending lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _b(x: str) -> Column:
    return F.lit(x.encode())


def list_commands(df: DataFrame, key: str = "key", value: str = "list_val") -> DataFrame:
    """One ``rpush key element`` for each element, in order."""
    return df.select(*[c for c in df.columns if c != value], F.posexplode(value).alias("ordinal", "x")).withColumn("argv", F.array(_b("rpush"), F.col(key), F.col("x"))).drop("x")


def set_commands(df: DataFrame, key: str = "key", value: str = "set_val") -> DataFrame:
    return df.select(*[c for c in df.columns if c != value], F.posexplode(value).alias("ordinal", "x")).withColumn("argv", F.array(_b("sadd"), F.col(key), F.col("x"))).drop("x")


def hash_commands(df: DataFrame, key: str = "key", value: str = "hash_val") -> DataFrame:
    return df.select(*[c for c in df.columns if c != value], F.posexplode(value).alias("ordinal", "f", "v")).withColumn("argv", F.array(_b("hset"), F.col(key), F.col("f"), F.col("v"))).drop("f", "v")


def zset_commands(df: DataFrame, key: str = "key", value: str = "zset_val") -> DataFrame:
    """Scores are printed so that they read back as the same double."""
    out = df.select(*[c for c in df.columns if c != value], F.posexplode(value).alias("ordinal", "m", "score"))
    whole = (F.col("score") == F.floor("score")) & (F.abs("score") < 1e15)
    text = F.when(whole, F.col("score").cast("long").cast("string")).otherwise(F.col("score").cast("string")).cast("binary")
    return out.withColumn("argv", F.array(_b("zadd"), F.col(key), text, F.col("m"))).drop("m", "score")


def expiry_command(df: DataFrame, now_ms: int, key: str = "key", at: str = "expire_at_ms") -> DataFrame:
    """``pexpire key ms`` for keys with an expiry; one that has passed leaves 1 ms.  now_ms is given, so runs repeat."""
    left = F.greatest(F.col(at) - F.lit(now_ms), F.lit(1)).cast("string").cast("binary")
    return df.where(F.col(at).isNotNull()).withColumn("argv", F.array(_b("pexpire"), F.col(key), left))


def distinct_keys(keys: DataFrame) -> DataFrame:
    """Each (db_id, key) once."""
    return keys.select("db_id", "key").dropDuplicates(["db_id", "key"])


def normalise_ttl(dumps: DataFrame) -> DataFrame:
    """Dumped keys that still exist (dump present, pttl not -2); pttl -1 (no expiry) becomes 0."""
    return dumps.where(F.col("dump").isNotNull() & (F.col("pttl") != -2)).withColumn("pttl", F.when(F.col("pttl") == -1, 0).otherwise(F.col("pttl")))


def restore_commands(dumps: DataFrame, most: int, replace: bool = False) -> tuple[DataFrame, DataFrame]:
    """(``RESTORE key pttl dump [replace]`` rows, rows over most bytes that must be decoded into commands); most 0: all of them."""
    tail = [_b("replace")] if replace else []
    ttl = F.col("pttl").cast("string").cast("binary")
    large = F.octet_length("dump") > most
    small = dumps.where(~large).withColumn("argv", F.array(_b("RESTORE"), F.col("key"), ttl, F.col("dump"), *tail))
    return small, dumps.where(large)


def pending_commands(consumer: DataFrame, group: DataFrame) -> DataFrame:
    """Consumers' pending ids with delivery time and count from the group's list; 0 where the group lacks the id."""
    on = ["key", "grp", "id"]
    return consumer.join(group, on, "left").withColumns({"delivery_ms": F.coalesce("delivery_ms", F.lit(0)), "deliveries": F.coalesce("deliveries", F.lit(0))})
