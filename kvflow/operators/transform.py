"""Row transformations: a Python table function, and native recipes for what such functions mostly do."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kvflow.operators.parse import parse

LOG = logging.getLogger("kvflow.function")


@dataclass(frozen=True)
class Call:
    """What a table function sees of one entry."""

    db: int
    group: str
    cmd: str
    keys: list[bytes]
    key_indexes: list[int]
    slots: list[int]
    argv: list[bytes]

    def log(self, message: object) -> None:
        """A line in the log of the executor that runs the function."""
        LOG.info("function: %s", message)


TableFunction = Callable[[Call], Iterable[tuple[int, list[bytes | str | int]]]]


def apply_function(entries: DataFrame, function: TableFunction | None) -> DataFrame:
    """Every entry replaced by the (db, argv) commands that function yields for it, parsed again and not filtered again.

    ordinal numbers the commands of one entry, so (source_id, seq, ordinal) keeps the order.  None changes nothing.
    The function runs in Arrow batches and must not keep state between calls; its errors fail the query.
    """
    if function is None:
        return entries.withColumn("ordinal", F.lit(0)) if "ordinal" not in entries.columns else entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, seq, ordinal, db, argv = [], [], [], [], []
            for r in batch.to_pylist():
                call = Call(r["db_id"], r["group"], r["cmd_name"], r["keys"], r["key_indexes"], r["slots"] or [], r["argv"])
                for i, (to, args) in enumerate(function(call)):
                    source.append(r["source_id"])
                    seq.append(r["seq"])
                    ordinal.append(i)
                    db.append(to)
                    argv.append([a if isinstance(a, bytes) else str(a).encode() for a in args])
            yield pa.RecordBatch.from_arrays(
                [pa.array(source, pa.string()), pa.array(seq, pa.int64()), pa.array(ordinal, pa.int32()), pa.array(db, pa.int32()), pa.array(argv, pa.list_(pa.binary()))],
                ["source_id", "seq", "ordinal", "db_id", "argv"],
            )

    needed = entries.select("source_id", "seq", "db_id", "group", "cmd_name", "keys", "key_indexes", "slots", "argv")
    return parse(needed.mapInArrow(run, "source_id string, seq long, ordinal int, db_id int, argv array<binary>"))


def keep_prefix(entries: DataFrame, prefix: bytes) -> DataFrame:
    """Entries whose first key starts with prefix."""
    return entries.where(F.coalesce(F.startswith(F.get("keys", 0), F.lit(prefix)), F.lit(False)))


def drop_db(entries: DataFrame, db: int) -> DataFrame:
    return entries.where(F.col("db_id") != db)


def keep_db(entries: DataFrame, db: int) -> DataFrame:
    return entries.where(F.col("db_id") == db)


def keep_group(entries: DataFrame, group: str) -> DataFrame:
    return entries.where(F.col("group") == group)


def drop_scripts(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("group") != "SCRIPTING")


def swap_db(entries: DataFrame, a: int, b: int) -> DataFrame:
    """Entries of database a go to b and the other way round."""
    return entries.withColumn("db_id", F.when(F.col("db_id") == a, b).when(F.col("db_id") == b, a).otherwise(F.col("db_id")))


def rename_prefix(entries: DataFrame, old: bytes, new: bytes, reparse: bool = True) -> DataFrame:
    """Keys that start with old start with new instead, in argv and so in keys."""

    def renamed(x: Column, i: Column) -> Column:
        hit = F.array_contains("key_indexes", i + 1) & F.startswith(x, F.lit(old))
        return F.when(hit, F.concat(F.lit(new), F.substring(x, len(old) + 1, 2147483647))).otherwise(x)

    out = entries.withColumn("argv", F.transform("argv", renamed))
    return parse(out) if reparse else out


def split_mset(entries: DataFrame) -> DataFrame:
    """Each MSET as one SET for each pair; other entries stay.  ordinal numbers the commands of one entry."""
    is_mset = (F.col("cmd_name") == "MSET") & (F.size("argv") >= 3)
    pairs = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("argv") - 2, F.lit(1)), F.lit(2)),
        lambda i: F.array(F.lit(b"SET"), F.get("argv", i), F.get("argv", i + 1)),
    )
    parts = F.when(is_mset, pairs).otherwise(F.array("argv"))
    base = entries.select("source_id", "seq", "db_id", F.posexplode(parts).alias("ordinal", "argv"))
    return parse(base)


def mset_function(call: Call) -> Iterator[tuple[int, list[bytes]]]:
    """split_mset as a table function."""
    if call.cmd == "MSET":
        for i in range(1, len(call.argv) - 1, 2):
            yield call.db, [b"SET", call.argv[i], call.argv[i + 1]]
    else:
        yield call.db, call.argv
