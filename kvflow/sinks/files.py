"""File sinks: commands as log text, keyspaces as Parquet."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kvflow.functions.resp import encoded
from kvflow.operators.replay import keyspace


def _order(entries: DataFrame) -> list[str]:
    return [c for c in ("source_id", "seq", "ordinal") if c in entries.columns]


def write_log(entries: DataFrame, path: str, mode: str = "error") -> None:
    """Commands in wire format, one row each, in the order of their source; a SELECT goes before each change of database.

    A file holds whole sources: order inside a source is kept, and a source is read back as it was.
    """
    order = _order(entries)
    dealt = entries.repartition("source_id").sortWithinPartitions(*order)
    from pyspark.sql import Window

    before = F.lag("db_id").over(Window.partitionBy("source_id").orderBy(*order[1:]))
    chosen = F.array(F.lit(b"SELECT"), F.col("db_id").cast("string").cast("binary"))
    change = before.isNull() | (before != F.col("db_id"))
    wire = F.when(change, F.concat(encoded(chosen), encoded(F.col("argv")))).otherwise(encoded(F.col("argv")))
    rows = dealt.select(*order, wire.alias("wire")).sortWithinPartitions(*order)
    rows.write.mode(mode).parquet(path)


def read_log_bytes(df: DataFrame) -> bytes:
    """The text of a small log written by write_log, for tests and hand inspection."""
    order = [c for c in ("source_id", "seq", "ordinal") if c in df.columns]
    return b"".join(bytes(r.wire) for r in df.orderBy(*order).select("wire").toLocalIterator())


class KeyspaceTable:
    """A keyspace kept as versions under one folder; each batch of commands gives a new version.

    The current version is named by a small pointer table written last, so a failed batch leaves the old one, and a
    batch that is run again (same batch id) changes nothing.
    """

    def __init__(self, spark, path: str) -> None:
        self.spark, self.path = spark, path

    def _pointer(self) -> tuple[str | None, int]:
        from pyspark.errors import AnalysisException

        try:
            row = self.spark.read.schema("version string, batch long").json(f"{self.path}/current").first()
        except AnalysisException:
            return None, -1
        return (row.version, row.batch) if row else (None, -1)

    def read(self) -> DataFrame | None:
        version, _ = self._pointer()
        return self.spark.read.parquet(f"{self.path}/{version}") if version else None

    def upsert(self, entries: DataFrame, batch: int, now_ms: int | None = None) -> None:
        """For foreachBatch: replay entries over what is there.

        What is there takes part as commands before all others, so overwrites, removals and member writes combine as in
        one replay.
        """
        version, done = self._pointer()
        if batch <= done:
            return
        rows = entries.withColumn("ordinal", F.lit(0)) if "ordinal" not in entries.columns else entries
        rows = rows.select("seq", "ordinal", "db_id", "argv", "cmd_name", "group")
        if version:
            rows = as_entries(self.spark.read.parquet(f"{self.path}/{version}")).unionByName(rows)
        new = f"v{batch}-{uuid.uuid4().hex[:8]}"
        keyspace(rows, now_ms).write.parquet(f"{self.path}/{new}")
        pointer = self.spark.createDataFrame([(new, batch)], "version string, batch long")
        pointer.coalesce(1).write.mode("overwrite").json(f"{self.path}/current")


def as_entries(space: DataFrame) -> DataFrame:
    """The commands that make a keyspace, with seq -1: before any other."""
    from kvflow.operators import values

    def rows(df: DataFrame) -> DataFrame:
        return df.select(F.lit(-1).cast("long").alias("seq"), F.col("ordinal").cast("int").alias("ordinal"), "db_id", "argv")

    base = space.select("db_id", "key", "string_val", "list_val", "set_val", "hash_val", "zset_val", "expire_at_ms")
    zero = F.lit(0).alias("ordinal")
    strings = base.where("string_val is not null").select("db_id", zero, F.array(F.lit(b"SET"), "key", "string_val").alias("argv"))
    at = F.col("expire_at_ms").cast("string").cast("binary")
    expiry = base.where("expire_at_ms is not null").select("db_id", F.lit(1 << 30).alias("ordinal"), F.array(F.lit(b"PEXPIREAT"), "key", at).alias("argv"))
    out = rows(strings).unionByName(rows(expiry))
    for make, col in ((values.list_commands, "list_val"), (values.set_commands, "set_val"), (values.hash_commands, "hash_val"), (values.zset_commands, "zset_val")):
        out = out.unionByName(rows(make(base.where(F.col(col).isNotNull()).select("db_id", "key", col))))
    name = F.upper(F.get("argv", 0).cast("string"))
    return out.withColumn("cmd_name", name).withColumn("group", F.lit("unknown"))
