"""Entry parsing: command name, group, keys, their places and slots, wire size.  Built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kvflow.catalog import CONTAINERS, catalog_frame
from kvflow.functions.hashing import slot
from kvflow.functions.resp import encoded_size


def command_name(argv: Column) -> Column:
    """Upper-case first argument; for containers the second is joined by a hyphen.  Null for an empty command."""
    first = F.upper(F.get(argv, 0).cast("string"))
    second = F.upper(F.get(argv, 1).cast("string"))
    return F.when(first.isin(list(CONTAINERS)) & (F.size(argv) > 1), F.concat_ws("-", first, second)).otherwise(first)


#: Places (from 0) in argv of the keys that one specification s names.  A missing keyword or argument names none.
_BEGIN = """
CASE WHEN s.keyword IS NULL THEN s.begin
     WHEN s.begin >= 0 THEN coalesce(array_min(filter(sequence(0, size(argv) - 1), i -> i >= s.begin AND upper(cast(argv[i] AS string)) = cast(s.keyword AS string))) + 1, size(argv))
     ELSE coalesce(array_max(filter(sequence(0, size(argv) - 1), i -> i BETWEEN 1 AND size(argv) + s.begin AND upper(cast(argv[i] AS string)) = cast(s.keyword AS string))) + 1, size(argv))
END"""
_END = """
CASE WHEN x.s.count >= 0 THEN x.b + x.s.first + (cast(greatest(0L, least(cast(size(argv) AS bigint), coalesce(try_cast(cast(get(argv, x.b + x.s.count) AS string) AS bigint), 0L))) AS int) - 1) * x.s.step
     WHEN x.s.last >= 0 THEN x.b + x.s.last
     WHEN x.s.limit > 1 THEN x.b + (size(argv) - x.b) div x.s.limit - 1
     ELSE size(argv) + x.s.last
END"""
_PLACES = f"""
CASE WHEN size(argv) = 0 OR specs IS NULL OR size(specs) = 0 THEN cast(array() AS array<int>)
ELSE flatten(transform(transform(transform(specs, s -> struct(s AS s, {_BEGIN} AS b)),
  x -> struct(x.s AS s, x.b AS b, cast(least({_END}, size(argv) - 1) AS int) AS e)),
  x -> CASE WHEN x.b < size(argv) AND x.e >= x.b + x.s.first
       THEN sequence(x.b + x.s.first, x.e, x.s.step) ELSE cast(array() AS array<int>) END))
END"""


def parse(df: DataFrame, with_slots: bool = True) -> DataFrame:
    """Add cmd_name, group, keys, key_indexes (from 1), slots, serialized_size to rows with argv (array<binary>).

    Unknown commands have the group ``unknown`` and no keys.  Slots cost most; leave them out where nothing routes.
    """
    named = df.drop("cmd_name", "group", "keys", "key_indexes", "slots", "serialized_size").withColumn("cmd_name", command_name(F.col("argv")))
    known = named.join(F.broadcast(catalog_frame(df.sparkSession)), "cmd_name", "left")
    placed = known.withColumn("places", F.expr(_PLACES))
    out = placed.withColumns(
        {
            "group": F.coalesce("group", F.lit("unknown")),
            "keys": F.transform("places", lambda i: F.get("argv", i)),
            "key_indexes": F.transform("places", lambda i: i + 1),
            "serialized_size": encoded_size(F.col("argv")),
        }
    )
    out = out.withColumn("slots", F.transform("keys", slot)) if with_slots else out.withColumn("slots", F.lit(None).cast("array<int>"))
    return out.select(*df.drop("cmd_name", "group", "keys", "key_indexes", "slots", "serialized_size").columns, "cmd_name", "group", "keys", "key_indexes", "slots", "serialized_size")
