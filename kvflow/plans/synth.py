"""A deterministic command log derived from the events table, as a Spark plan and as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvflow.operators.parse import parse

#: The argv of an event; {l} {r} are the array brackets and {s} the string type of an engine.
_ARGV = """
case when event_type='view' then {l}'SET','view:'||user_id, cast(event_id as {s}){r}
 when event_type='click' then {l}'RPUSH','clicks:'||user_id, cast(event_id as {s}){r}
 when event_type='signup' then {l}'HSET','user:'||user_id,'f'||(event_id % 10), cast(event_id as {s}){r}
 when event_type='purchase' then {l}'ZADD','purchases:{{u'||user_id||'}}', cast(cast(round(value*100) as bigint) as {s}), cast(event_id as {s}){r}
 when event_id % 4 = 0 then {l}'DEL','view:'||user_id,'clicks:'||user_id{r}
 when event_id % 4 = 1 then {l}'MSET','err:'||user_id,'x','temp:'||user_id,'y'{r}
 when event_id % 4 = 2 then {l}'XGROUP','create','s:'||user_id,'g','0'{r}
 else {l}'FOOCMD','temp:'||user_id{r} end"""


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source_id, seq, db_id, argv of one log."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = F.expr(_ARGV.format(l="array(", r=")", s="string"))
    return events.select(
        F.lit("events").alias("source_id"),
        F.col("event_id").cast("long").alias("seq"),
        (F.col("user_id") % 16).cast("int").alias("db_id"),
        F.transform(text, lambda a: a.cast("binary")).alias("argv"),
    )


def entries(spark: SparkSession, sf_dir: str, with_slots: bool = False) -> DataFrame:
    return parse(raw(spark, sf_dir), with_slots)


#: The same in DuckDB: e(seq, db_id, argv) and p(..., cmd, grp, keys).
SQL = f"""
e as (select event_id as seq, cast(user_id % 16 as int) as db_id, {_ARGV.format(l="[", r="]", s="varchar")} as argv from events),
p as (select *,
  case when argv[1] = 'XGROUP' then 'XGROUP-' || upper(argv[2]) else argv[1] end as cmd,
  case argv[1] when 'SET' then 'STRING' when 'MSET' then 'STRING' when 'RPUSH' then 'LIST' when 'HSET' then 'HASH' when 'ZADD' then 'SORTED_SET'
    when 'DEL' then 'GENERIC' when 'XGROUP' then 'STREAM' else 'unknown' end as grp,
  case argv[1] when 'DEL' then argv[2:] when 'MSET' then [argv[2], argv[4]] when 'XGROUP' then [argv[3]] when 'FOOCMD' then [] else [argv[2]] end as keys
  from e)"""
