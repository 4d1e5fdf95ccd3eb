"""Schemas of the engine: entries (one row per command) and keyspace (one row per live key)."""

from __future__ import annotations

from pyspark.sql import types as T

#: What every source yields.
RAW = T.StructType(
    [
        T.StructField("source_id", T.StringType(), False),
        T.StructField("seq", T.LongType(), False),
        T.StructField("db_id", T.IntegerType(), False),
        T.StructField("argv", T.ArrayType(T.BinaryType(), False), False),
    ]
)

#: What operators.parse adds.
ENTRY = T.StructType(
    RAW.fields
    + [
        T.StructField("cmd_name", T.StringType()),
        T.StructField("group", T.StringType()),
        T.StructField("keys", T.ArrayType(T.BinaryType())),
        T.StructField("key_indexes", T.ArrayType(T.IntegerType())),
        T.StructField("slots", T.ArrayType(T.IntegerType())),
        T.StructField("serialized_size", T.LongType()),
    ]
)

#: Hash slots of a cluster.
SLOTS = 16384
