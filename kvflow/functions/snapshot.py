"""The snapshot format written with native expressions: values, entries and whole small files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Type bytes of the plain encodings, and opcodes.
TYPES = {"string": 0, "list": 1, "set": 2, "zset": 3, "hash": 4}
EXPIRE_MS, SELECT, END = 0xFC, 0xFE, 0xFF
MAGIC = b"REDIS0009"


def _be(n: Column, width: int) -> Column:
    """A number as width bytes, high byte first."""
    return F.unhex(F.lpad(F.hex(n.cast("long")), 2 * width, "0"))


def length(n: Column) -> Column:
    """6, 14 or 32 bits."""
    return (
        F.when(n < 64, _be(n, 1))
        .when(n < 16384, _be(n.cast("long") + 0x4000, 2))
        .otherwise(F.concat(F.lit(b"\x80"), _be(n, 4)))
    )


def string(s: Column) -> Column:
    return F.concat(length(F.octet_length(s)), s)


def _joined(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(b""), lambda acc, x: F.concat(acc, x))


def _counted(array: Column, item) -> Column:
    return F.concat(length(F.size(array)), _joined(F.transform(array, item)))


def _score(pair: Column) -> Column:
    text = F.when(pair["value"] == float("inf"), F.lit("inf")).when(pair["value"] == float("-inf"), F.lit("-inf")).otherwise(pair["value"].cast("string")).cast("binary")
    return F.concat(string(pair["key"]), _be(F.octet_length(text), 1), text)


def value() -> Column:
    """The body of a keyspace row's value."""
    kind = F.col("type")
    pair = lambda p: F.concat(string(p["key"]), string(p["value"]))
    return (
        F.when(kind == "string", string(F.col("string_val")))
        .when(kind == "list", _counted(F.col("list_val"), string))
        .when(kind == "set", _counted(F.col("set_val"), string))
        .when(kind == "hash", _counted(F.map_entries("hash_val"), pair))
        .when(kind == "zset", _counted(F.map_entries("zset_val"), _score))
    )


def entry() -> Column:
    """Expiry, type, key and value of a keyspace row."""
    at = _be(F.col("expire_at_ms"), 8)
    little = F.concat(*[F.substring(at, i, 1) for i in range(8, 0, -1)])
    expiry = F.when(F.col("expire_at_ms").isNull(), F.lit(b"")).otherwise(F.concat(F.lit(bytes([EXPIRE_MS])), little))
    kind = reduce(lambda c, t: c.when(F.col("type") == t, F.lit(bytes([TYPES[t]]))), list(TYPES)[1:], F.when(F.col("type") == "string", F.lit(b"\x00")))
    return F.concat(expiry, kind, string(F.col("key")), value())


def files(space: DataFrame, keys_a_file: int = 1000) -> DataFrame:
    """path, content: a keyspace as snapshots of about keys_a_file keys of one database each, without a checksum.

    The result has the columns of Spark's binaryFile source, so sources.rdb.decode_files reads it back.
    """
    sizes = space.groupBy("db_id").agg(F.count("*").alias("n"))
    spread = space.join(sizes, "db_id").withColumn("file", F.pmod(F.xxhash64("key"), F.ceil(F.col("n") / keys_a_file)))
    grouped = spread.select("db_id", "file", F.struct("key", entry().alias("body")).alias("e")).groupBy("db_id", "file").agg(F.array_sort(F.collect_list("e")).alias("entries"))
    head = F.concat(F.lit(MAGIC + bytes([SELECT])), length(F.col("db_id")))
    content = F.concat(head, _joined(F.transform("entries", lambda e: e["body"])), F.lit(bytes([END]) + bytes(8)))
    return grouped.select(F.concat_ws("-", F.lit("db"), "db_id", "file").alias("path"), content.alias("content"))
