"""Registered key-value queries and their SQL oracles.  Binary results are shown as text, arrays joined by ``|``."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kvflow.functions import resp, snapshot
from kvflow.operators import counters, filters, ordering, replay, routing, transform, values
from kvflow.operators.filters import FilterConfig
from kvflow.operators.parse import parse
from kvflow.plans import packed, synth
from kvflow.sources import aof, rdb

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
NODES = ["node0:6379", "node1:6379", "node2:6379", "node3:6379"]


def _query(sql: str | None = None, name: str | None = None):
    """Register a query; sql may use the views e and p of synth.SQL."""

    def add(f):
        key = name or f.__name__
        QUERIES[key] = f
        if sql is not None:
            ORACLE_SQL[key] = f"with {synth.SQL} {sql}" if not sql.startswith("with") else sql
        return f

    return add


def _joined(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.array_join(F.transform(c, lambda x: x.cast("string")), "|")


def _shown(df: DataFrame) -> DataFrame:
    return df.select("seq", "db_id", "cmd_name", _joined("argv").alias("argv"))


_SHOW = "select seq, db_id, cmd as cmd_name, array_to_string(argv, '|') as argv from p"


@_query("select seq, cmd as cmd_name, grp as \"group\", array_to_string(keys, '|') as keys, case argv[1] when 'DEL' then '2|3' when 'MSET' then '2|4' when 'XGROUP' then '3' when 'FOOCMD' then '' else '2' end as key_indexes from p")
def entries_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synth.entries(spark, sf_dir).select("seq", "cmd_name", "group", _joined("keys").alias("keys"), _joined("key_indexes").alias("key_indexes"))


@_query("select cmd as cmd_name, count(*) as n, count(distinct argv[1]) as spellings from p group by cmd")
def cmd_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = synth.entries(spark, sf_dir)
    return e.groupBy("cmd_name").agg(F.count("*").alias("n"), F.countDistinct(F.get("argv", 0)).alias("spellings"))


@_query('select grp as "group", cmd as cmd_name, count(*) as n from p group by grp, cmd')
def group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: parse, filter nothing, count by command."""
    return counters.by_command(synth.entries(spark, sf_dir))


@_query("select count(*) as total_entries from p")
def total_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters.total(synth.entries(spark, sf_dir))


def _filter_query(name: str, cfg: FilterConfig, where: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _shown(filters.apply_filters(synth.entries(spark, sf_dir), cfg))

    run.__name__, run.__doc__ = name, f"Entries that pass {cfg}"
    _query(f"{_SHOW} where {where}")(run)


_KEYS = "len(list_filter(keys, lambda k: {0})) = len(keys)"
_filter_query("filter_allow_prefix", FilterConfig(allow_key_prefix=("view:", "err:")), _KEYS.format("starts_with(k, 'view:') or starts_with(k, 'err:')"))
_filter_query("filter_allow_suffix", FilterConfig(allow_key_suffix=("7", "3}")), _KEYS.format("ends_with(k, '7') or ends_with(k, '3}')"))
_filter_query("filter_block_prefix", FilterConfig(block_key_prefix=("temp:",)), _KEYS.format("not starts_with(k, 'temp:')"))
_filter_query("filter_block_suffix", FilterConfig(block_key_suffix=("1", "2")), _KEYS.format("not (ends_with(k, '1') or ends_with(k, '2'))"))
_filter_query("filter_allow_or_suffix", FilterConfig(allow_key_prefix=("view:",), allow_key_suffix=("9",)), _KEYS.format("starts_with(k, 'view:') or ends_with(k, '9')"))
_filter_query("filter_db_allow", FilterConfig(allow_db=(0, 3, 5)), "db_id in (0, 3, 5)")
_filter_query("filter_db_block", FilterConfig(block_db=(0, 3, 5)), "db_id not in (0, 3, 5)")
_filter_query("filter_cmd_allow", FilterConfig(allow_command=("SET", "XGROUP-CREATE")), "cmd in ('SET', 'XGROUP-CREATE')")
_filter_query("filter_cmd_block", FilterConfig(block_command=("SET", "FOOCMD")), "cmd not in ('SET', 'FOOCMD')")
_filter_query("filter_group_allow", FilterConfig(allow_command_group=("STRING", "HASH")), "grp in ('STRING', 'HASH')")
_filter_query("filter_group_block", FilterConfig(block_command_group=("STRING", "unknown")), "grp not in ('STRING', 'unknown')")
_filter_query(
    "filter_all",
    FilterConfig(allow_key_prefix=("view:", "user:", "err:", "temp:"), block_key_suffix=("3",), block_db=(1,), block_command=("DEL",), allow_command_group=("STRING", "HASH", "unknown")),
    _KEYS.format("(starts_with(k, 'view:') or starts_with(k, 'user:') or starts_with(k, 'err:') or starts_with(k, 'temp:')) and not ends_with(k, '3')")
    + " and db_id <> 1 and cmd <> 'DEL' and grp in ('STRING', 'HASH', 'unknown')",
)


@_query("select cmd as cmd_name, count(*) as mixed from p where len(list_filter(keys, lambda k: starts_with(k, 'err:'))) between 1 and len(keys) - 1 group by cmd")
def filter_mixed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = synth.entries(spark, sf_dir)
    return e.where(filters.mixed_keys(FilterConfig(allow_key_prefix=("err:",)))).groupBy("cmd_name").agg(F.count("*").alias("mixed"))


_CRC = """list_reduce(list_prepend(0, [ascii(c) for c in string_split(tag, '')]), lambda c, b:
  list_reduce(list_prepend(xor(c, b << 8), range(8)), lambda x, i: (case when (x & 32768) <> 0 then xor(x << 1, 4129) else x << 1 end) & 65535)) & 16383"""
_SLOTS = f"""
k as (select distinct k from (select unnest(keys) as k from p)),
t as (select k, case when regexp_matches(k, '\\{{[^}}]+\\}}') then regexp_extract(k, '\\{{([^}}]+)\\}}', 1) else k end as tag from k),
s as (select k, cast({_CRC} as int) as slot from t)"""


@_query(f"with {synth.SQL}, {_SLOTS} select k as key, slot from s")
def slot_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from kvflow.functions.hashing import slot

    keys = synth.entries(spark, sf_dir).select(F.explode("keys").alias("key")).distinct()
    return keys.select(F.col("key").cast("string").alias("key"), slot(F.col("key")).alias("slot"))


_ONE_SLOT = "one as (select seq, min(slot) as slot from (select seq, unnest(keys) as k from p) join s using (k) group by seq having count(distinct slot) = 1)"


@_query(f"with {synth.SQL}, {_SLOTS}, {_ONE_SLOT} select seq, slot, 'node' || (slot // 4096) || ':6379' as node from one")
def slot_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every command with keys to the node of their slot; those whose keys span slots are dropped."""
    e = synth.entries(spark, sf_dir, with_slots=True).where("size(keys) > 0")
    return routing.route(e, routing.even_routes(spark, NODES), "drop").select("seq", "slot", "node")


@_query(
    f"with {synth.SQL}, {_SLOTS}, {_ONE_SLOT}, r as (select 'node' || (slot // 4096) || ':6379' as node from one "
    "union all select 'node' || n || ':6379' from p, range(4) g(n) where len(keys) = 0) select node, count(*) as n from r group by node"
)
def node_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = synth.entries(spark, sf_dir, with_slots=True)
    return routing.route(e, routing.even_routes(spark, NODES), "drop").groupBy("node").agg(F.count("*").alias("n"))


@_query("select seq, 'node' || n || ':6379' as node from p, range(4) g(n) where cmd = 'FOOCMD'")
def broadcast_no_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = synth.entries(spark, sf_dir, with_slots=True).where("size(keys) = 0")
    return routing.route(e, routing.even_routes(spark, NODES)).select("seq", "node")


@_query(f"with {synth.SQL}, {_SLOTS}, u as (select seq, cmd, unnest(keys) as k from p where len(keys) > 1) select cmd as cmd_name, count(*) as n from (select seq, cmd from u join s using (k) group by seq, cmd having count(distinct slot) > 1) group by cmd")
def cross_slot_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.cross_slot(synth.entries(spark, sf_dir, with_slots=True)).groupBy("cmd_name").agg(F.count("*").alias("n"))


@_query(
    "with r as (select n_nationkey * 660 as low, n_nationkey * 660 + 640 + n_nationkey % 3 * 20 as high from nation), "
    "o as (select s as slot, count(low) as owners from range(16384) t(s) left join r on s between low and least(high, 16383) group by s) "
    "select cast(slot as int) as slot, owners from o where owners <> 1"
)
def slot_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots that nobody or several nodes own, of ranges that leave gaps, overlap and end early."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    low = F.col("n_nationkey") * 660
    high = F.least(low + 640 + F.col("n_nationkey") % 3 * 20, F.lit(16383))
    return routing.coverage_faults(nation.select(low.cast("int").alias("low"), high.cast("int").alias("high"), F.col("n_name").alias("node")))


@_query("select seq, cast(3 + len(cast(len(argv) as varchar)) + list_sum([5 + len(cast(strlen(a) as varchar)) + strlen(a) for a in argv]) as bigint) as size from p")
def resp_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synth.entries(spark, sf_dir).select("seq", F.col("serialized_size").alias("size"))


@_query("select seq, '*' || len(argv) || chr(13) || chr(10) || array_to_string(['$' || strlen(a) || chr(13) || chr(10) || a || chr(13) || chr(10) for a in argv], '') as wire from p")
def resp_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synth.raw(spark, sf_dir).select("seq", resp.encoded(F.col("argv")).cast("string").alias("wire"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ascii_only = F.regexp_replace(F.coalesce("text", F.lit("")), r"[^\x00-\x7F]", "?")
    return d.select("doc_id", ascii_only.alias("body"))


_DOCS = "with d as (select doc_id, regexp_replace(coalesce(text, ''), '[^\\x00-\\x7F]', '?', 'g') as body from documents)"


@_query(f"{_DOCS} select doc_id, 'SET doc:' || doc_id || ' ' || case when length(body) > 100 then substr(body, 1, 100) || '...' else body end as line from d")
def display_trunc(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _documents(spark, sf_dir)
    argv = F.array(*[c.cast("binary") for c in (F.lit("SET"), F.concat(F.lit("doc:"), F.col("doc_id").cast("string")), F.col("body"))])
    return d.select("doc_id", resp.display(argv).alias("line"))


@_query(f"{_DOCS} select doc_id, length(body) as size, case when length(body) > 3000 then 'commands' else 'restore' end as form from d")
def large_value_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _documents(spark, sf_dir).select("doc_id", F.col("doc_id").cast("string").cast("binary").alias("key"), F.lit(0).alias("pttl"), F.col("body").cast("binary").alias("dump"))
    small, large = values.restore_commands(d, 3000)
    size = F.octet_length("dump").cast("long").alias("size")
    return small.select("doc_id", size, F.lit("restore").alias("form")).union(large.select("doc_id", size, F.lit("commands").alias("form")))


@_query(_SHOW)
def fn_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(transform.apply_function(synth.entries(spark, sf_dir), None))


@_query(f"{_SHOW} where starts_with(keys[1], 'user:')")
def fn_filter_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(transform.keep_prefix(synth.entries(spark, sf_dir), b"user:"))


@_query(f"{_SHOW} where db_id <> 0")
def fn_filter_db(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(transform.drop_db(synth.entries(spark, sf_dir), 0))


@_query(f"{_SHOW} where grp = 'HASH'")
def fn_filter_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(transform.keep_group(synth.entries(spark, sf_dir), "HASH"))


@_query(f"{_SHOW} where grp <> 'SCRIPTING'")
def fn_filter_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(transform.drop_scripts(synth.entries(spark, sf_dir)))


@_query(
    "select seq, db_id, cmd as cmd_name, array_to_string([case when list_contains(keys, a) and starts_with(a, 'view:') then 'seen/' || substr(a, 6) else a end for a in argv], '|') as argv, "
    "array_to_string([case when starts_with(k, 'view:') then 'seen/' || substr(k, 6) else k end for k in keys], '|') as keys from p"
)
def fn_rename_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = transform.rename_prefix(synth.entries(spark, sf_dir), b"view:", b"seen/")
    return e.select("seq", "db_id", "cmd_name", _joined("argv").alias("argv"), _joined("keys").alias("keys"))


@_query("select seq, case db_id when 1 then 2 when 2 then 1 else db_id end as db_id, cmd as cmd_name, array_to_string(argv, '|') as argv from p")
def fn_swap_db(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(transform.swap_db(synth.entries(spark, sf_dir), 1, 2))


_SPLIT = (
    "select seq, cast(i as int) as ordinal, 'SET' as cmd_name, 'SET|' || argv[2 + 2 * i] || '|' || argv[3 + 2 * i] as argv from p, range(2) g(i) where cmd = 'MSET' "
    "union all select seq, 0, cmd, array_to_string(argv, '|') from p where cmd <> 'MSET'"
)


@_query(_SPLIT)
def fn_split_mset(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = transform.split_mset(synth.entries(spark, sf_dir))
    return e.select("seq", "ordinal", "cmd_name", _joined("argv").alias("argv"))


@_query(_SPLIT)
def fn_table_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = transform.apply_function(synth.entries(spark, sf_dir), transform.mset_function)
    return e.select("seq", "ordinal", "cmd_name", _joined("argv").alias("argv"))


@_query("select distinct db_id, k as key from (select db_id, unnest(keys) as k from p)")
def dedup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = synth.entries(spark, sf_dir).select("db_id", F.explode("keys").alias("key"))
    return values.distinct_keys(keys).select("db_id", F.col("key").cast("string").alias("key"))


def _with_selects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four logs; every purchase reads as a SELECT of its user's database."""
    raw = synth.raw(spark, sf_dir)
    is_select = F.get("argv", 0).cast("string") == "ZADD"
    db = F.col("db_id").cast("string").cast("binary")
    argv = F.when(is_select, F.array(F.lit(b"select"), db)).otherwise(F.col("argv"))
    return raw.select(F.concat(F.lit("s"), F.col("seq") % 4).alias("source_id"), "seq", "db_id", argv.alias("argv"))


@_query(
    "select 's' || (seq % 4) as source_id, seq, cast(coalesce(last_value(case when cmd = 'ZADD' then db_id end ignore nulls) over (partition by seq % 4 order by seq rows between unbounded preceding and current row), 0) as int) as db_id, cmd from p qualify cmd <> 'ZADD'"
)
def db_forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ordering.absorb_select(_with_selects(spark, sf_dir))
    return parse(out, with_slots=False).select("source_id", "seq", "db_id", F.col("cmd_name").alias("cmd"))


@_query(
    "select source_id, seq from (select 's' || (event_id % 4) as source_id, event_id as seq, max(epoch(ts) + (event_id * 7919 % 3600)) over (partition by event_id % 4 order by event_id rows between unbounded preceding and current row) as m, "
    "avg(epoch(ts)) over () as mid from events) where m <= floor(mid)",
)
def aof_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    stamp = F.col("ts").cast("timestamp").cast("double") + (F.col("event_id") * 7919 % 3600)
    mid = events.agg(F.floor(F.avg(F.col("ts").cast("timestamp").cast("double")))).first()[0]
    rows = events.select(F.concat(F.lit("s"), F.col("event_id") % 4).alias("source_id"), F.col("event_id").alias("seq"), stamp.alias("ts"))
    return ordering.cut_after(rows, mid).select("source_id", "seq")


@_query("select event_id, case when event_id % 5 = 1 then 0 else event_id % 5 * 100 end as pttl from events where event_id % 5 <> 2 and event_id % 7 <> 0", name="ttl_normalise")
def ttl_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    pttl = F.when(F.col("event_id") % 5 == 1, -1).when(F.col("event_id") % 5 == 2, -2).otherwise(F.col("event_id") % 5 * 100)
    d = events.select("event_id", pttl.alias("pttl"), F.when(F.col("event_id") % 7 != 0, F.lit(b"x")).alias("dump"))
    return values.normalise_ttl(d).select("event_id", F.col("pttl").cast("long").alias("pttl"))


def _rewrite(name: str, cmd: str, sql: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        e = synth.entries(spark, sf_dir).where(F.col("cmd_name") == cmd)
        space = replay.keyspace(e)
        made = {"RPUSH": values.list_commands, "HSET": values.hash_commands, "ZADD": values.zset_commands, "SADD": values.set_commands}[cmd](space)
        return made.select("db_id", _joined("argv").alias("argv"))

    run.__name__ = name
    _query(sql)(run)


_rewrite("scan_rewrite_list", "RPUSH", "select db_id, 'rpush|' || argv[2] || '|' || argv[3] as argv from p where cmd = 'RPUSH'")
_rewrite("scan_rewrite_hash", "HSET", "select db_id, 'hset|' || argv[2] || '|' || argv[3] || '|' || arg_max(argv[4], seq) as argv from p where cmd = 'HSET' group by db_id, argv[2], argv[3]")
_rewrite("scan_rewrite_zset", "ZADD", "select db_id, 'zadd|' || argv[2] || '|' || arg_max(argv[3], seq) || '|' || argv[4] as argv from p where cmd = 'ZADD' group by db_id, argv[2], argv[4]")


@_query("select distinct db_id, 'sadd|fields|' || argv[3] as argv from p where cmd = 'HSET'")
def scan_rewrite_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = synth.entries(spark, sf_dir).where("cmd_name = 'HSET'")
    sadd = e.select("source_id", "seq", "db_id", F.array(F.lit(b"SADD"), F.lit(b"fields"), F.get("argv", 2)).alias("argv"))
    return values.set_commands(replay.keyspace(parse(sadd, False))).select("db_id", _joined("argv").alias("argv"))


@_query(
    "with c as (select o_orderkey as id, o_custkey as key from orders), g as (select l_orderkey as id, max(epoch_ms(l_shipdate)) as delivery_ms, count(*) as deliveries from lineitem where l_returnflag = 'R' group by l_orderkey) "
    "select id, key, coalesce(delivery_ms, 0) as delivery_ms, coalesce(deliveries, 0) as deliveries from c left join g using (id)"
)
def pel_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a consumer's pending ids, their returned items as the group's list, which lacks some of them."""
    orders, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "lineitem"))
    consumer = orders.select(F.col("o_custkey").alias("key"), F.lit("g").alias("grp"), F.col("o_orderkey").alias("id"))
    group = items.where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("id")).agg(F.unix_millis(F.max("l_shipdate").cast("timestamp")).alias("delivery_ms"), F.count("*").alias("deliveries"))
    group = group.join(consumer.select("key", "grp", "id"), "id")
    return values.pending_commands(consumer, group).select("id", "key", "delivery_ms", "deliveries")


@_query(
    "select s_nationkey as shard, arg_max('10.0.0.' || s_suppkey || ':6379', s_suppkey * 7919 % 10007) as replica from supplier where s_suppkey % 3 <> 0 group by s_nationkey"
)
def replica_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The online replica with the greatest offset of each shard, from its replication report."""
    n = F.col("s_suppkey").cast("string")
    offset = (F.col("s_suppkey") * 7919 % 10007).cast("string")
    state = F.when(F.col("s_suppkey") % 3 == 0, "wait_bgsave").otherwise("online")
    line = F.concat(F.lit(":ip=10.0.0."), n, F.lit(",port=6379,state="), state, F.lit(",offset="), offset, F.lit(",lag=1"))
    lines = F.transform(F.array_sort(F.collect_list(line)), lambda x, i: F.concat(F.lit("slave"), i.cast("string"), x))
    report = F.concat(F.lit("role:master\r\n"), F.array_join(lines, "\r\n"), F.lit("\r\n"))
    shards = spark.read.parquet(f"{sf_dir}/supplier.parquet").groupBy(F.col("s_nationkey").alias("shard")).agg(report.alias("report"))

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([routing.best_replica(x) for x in b.column(1).to_pylist()], pa.string())], ["shard", "replica"])

    return shards.mapInArrow(run, "shard int, replica string").where("replica is not null")


_NODES = "select n_nationkey as i, n_nationkey % 4 = 3 as spare, 655 * n_nationkey as low, case when n_nationkey = 24 then 16383 else 655 * n_nationkey + 654 end as high from nation"


@_query(
    f"with n as ({_NODES}) select 'id' || i as node_id, case when i % 2 = 0 then '10.0.0.' || i || ':6379' else '[::' || i || ']:6379' end as address, not spare as is_master, "
    "case when spare then 'id' || (i - 1) else '-' end as master_id, i % 5 <> 4 as healthy, case when spare then '' when i % 3 = 0 then low || '-' || high else low || '-' || low || ',' || (low + 1) || '-' || high end as slots "
    "from n where i % 7 <> 6"
)
def nodes_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cluster's own listing: host names and bus ports, addresses of both families, slots on the move, nodes in handshake."""
    lines = []
    for i in sorted(r.n_nationkey for r in spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey").collect()):
        spare, low = i % 4 == 3, 655 * i
        high = 16383 if i == 24 else low + 654
        host = f"10.0.0.{i}" if i % 2 == 0 else f"::{i}"
        flags = ("slave" if spare else "master") + (",fail?" if i % 5 == 4 else "") + (",handshake" if i % 7 == 6 else "")
        ranges = "" if spare else f"{low}-{high}" if i % 3 == 0 else f"{low} {low + 1}-{high} [93-<-id0]"
        lines.append(f"id{i} {host}:6379@16379,host{i} {flags} {f'id{i - 1}' if spare else '-'} 0 0 {i} connected {ranges}".rstrip())
    found = routing.parse_nodes("\n".join(lines))
    rows = [(n.node_id, n.address, n.is_master, n.master_id, n.healthy, ",".join(f"{a}-{b}" for a, b in n.slots)) for n in found]
    return spark.createDataFrame(rows, "node_id string, address string, is_master boolean, master_id string, healthy boolean, slots string")


@_query("with h as (select date_trunc('hour', ts) as hour, count(*) as n from events group by 1) select strftime(hour, '%Y-%m-%d %H:%M') as hour, n, n / 3600.0 as per_second, n - lag(n) over (order by hour) as change from h")
def op_rate_per_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    rate = counters.hourly_rate(spark.read.parquet(f"{sf_dir}/events.parquet"))
    return rate.withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH:mm"))


@_query("select cmd as cmd_name, count(*) as n from p group by cmd")
def union_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = synth.entries(spark, sf_dir)
    shards = [e.where(F.col("seq") % 4 == i) for i in range(4)]
    out = shards[0]
    for s in shards[1:]:
        out = out.unionByName(s)
    return out.groupBy("cmd_name").agg(F.count("*").alias("n"))


@_query("select bool_and(r = s) as consistent, cast(sum(r - s) as bigint) as unanswered_bytes from (select event_id % 4, max(event_id) as r, max(case when event_type <> 'error' then event_id end) as s from events group by 1)", name="shard_consistency")
def shard_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    shards = events.groupBy((F.col("event_id") % 4).alias("source_id")).agg(F.max("event_id").alias("received"), F.max(F.when(F.col("event_type") != "error", F.col("event_id"))).alias("sent"))
    return counters.consistency(shards)


#: One row for each effect on a key: kind string or remove sets the boundary.
_REPLAY = f"""with {synth.SQL},
x as (
  select seq, db_id, argv[2] as k, 'string' as kind, argv[3] as v, null as f from p where cmd = 'SET'
  union all select seq, db_id, argv[2 + 2 * i], 'string', argv[3 + 2 * i], null from p, range(2) g(i) where cmd = 'MSET'
  union all select seq, db_id, unnest(argv[2:]), 'remove', null, null from p where cmd = 'DEL'
  union all select seq, db_id, argv[2], 'hash', argv[4], argv[3] from p where cmd = 'HSET'
  union all select seq, db_id, argv[2], 'zset', argv[3], argv[4] from p where cmd = 'ZADD'
  union all select seq, db_id, argv[2], 'list', argv[3], null from p where cmd = 'RPUSH'
),
b as (select db_id, k, max(seq) as bound from x where kind in ('string', 'remove') group by db_id, k),
l as (select x.* from x left join b using (db_id, k) where bound is null or seq > bound or (seq = bound and kind = 'string'))"""


def _space(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.keyspace(synth.entries(spark, sf_dir))


@_query(f"{_REPLAY} select db_id, k as key, v as value from l where kind = 'string'")
def replay_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _space(spark, sf_dir).where("type = 'string'")
    return s.select("db_id", F.col("key").cast("string").alias("key"), F.col("string_val").cast("string").alias("value"))


@_query(f"{_REPLAY}, h as (select db_id, k, f, arg_max(v, seq) as v from l where kind = 'hash' group by all) select db_id, k as key, string_agg(f || '=' || v, '|' order by f) as fields from h group by db_id, k")
def replay_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _space(spark, sf_dir).where("type = 'hash'")
    pairs = F.transform(F.map_entries("hash_val"), lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"].cast("string")))
    return s.select("db_id", F.col("key").cast("string").alias("key"), F.array_join(F.array_sort(pairs), "|").alias("fields"))


@_query(f"{_REPLAY}, z as (select db_id, k, f, cast(arg_max(v, seq) as double) as v from l where kind = 'zset' group by all) select db_id, k as key, count(*) as members, sum(v) as total, max(v) as greatest from z group by db_id, k")
def replay_zset(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _space(spark, sf_dir).where("type = 'zset'")
    score = F.map_values("zset_val")
    total = F.aggregate(score, F.lit(0.0), lambda a, x: a + x)
    return s.select("db_id", F.col("key").cast("string").alias("key"), F.size(score).cast("long").alias("members"), total.alias("total"), F.array_max(score).alias("greatest"))


@_query(f"{_REPLAY} select db_id, k as key, string_agg(v, '|' order by seq) as elements from l where kind = 'list' group by db_id, k")
def replay_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _space(spark, sf_dir).where("type = 'list'")
    return s.select("db_id", F.col("key").cast("string").alias("key"), _joined("list_val").alias("elements"))


@_query(f"{_REPLAY} select db_id, count(distinct k) as keys from l where kind <> 'remove' group by db_id")
def replay_dbsize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.dbsize(_space(spark, sf_dir))


@_query("select cmd as cmd_name, count(*) as n from p where cmd in ('XGROUP-CREATE', 'FOOCMD') group by cmd")
def replay_unsupported(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.unsupported(synth.entries(spark, sf_dir))


def _written(spark: SparkSession, sf_dir: str, argv: str) -> DataFrame:
    """A log made of events by a SQL array of strings."""
    raw = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.lit("events").alias("source_id"),
        F.col("event_id").cast("long").alias("seq"),
        (F.col("user_id") % 4).cast("int").alias("db_id"),
        F.transform(F.expr(argv), lambda a: a.cast("binary")).alias("argv"),
    )
    return parse(raw, with_slots=False)


_K = "'k:' || cast(user_id % 97 as string)"
_EXPIRING = f"""case event_id % 7 when 0 then array('SETEX', {_K}, '10', cast(event_id as string)) when 1 then array('set', {_K}, cast(event_id as string), 'ex', '20')
 when 2 then array('SET', {_K}, cast(event_id as string), 'PXAT', '77000') when 3 then array('SET', {_K}, cast(event_id as string)) when 4 then array('EXPIRE', {_K}, '5')
 when 5 then array('SET', {_K}, cast(event_id as string), 'KEEPTTL') else array('PERSIST', {_K}) end"""


@_query(
    "with x as (select user_id % 4 as db_id, 'k:' || (user_id % 97) as k, event_id as seq, event_id % 7 as op from events), "
    "f as (select db_id, k, list(struct_pack(op := op, v := seq) order by seq) as ops from x group by db_id, k), "
    "s as (select db_id, k, list_reduce(list_prepend(struct_pack(op := -1, v := -1), ops), lambda a, b: struct_pack("
    "op := case when b.op = 4 then case when a.v >= 0 then 4 else a.op end when b.op = 6 then case when a.v >= 0 then 6 else a.op end when b.op = 5 then case when a.v >= 0 then a.op else 3 end else b.op end, "
    "v := case when b.op in (4, 6) then a.v else b.v end)) as st from f) "
    "select cast(db_id as int) as db_id, k as key, cast(st.v as varchar) as value, cast(case st.op when 0 then 1010000 when 1 then 1020000 when 2 then 77000 when 4 then 1005000 else -1 end as bigint) as expire_at_ms from s where st.v >= 0",
)
def replay_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings and their times to live, by SETEX, options of SET, EXPIRE and PERSIST; the oracle folds each key's commands in order."""
    s = replay.keyspace(_written(spark, sf_dir, _EXPIRING), now_ms=1_000_000)
    return s.select("db_id", F.col("key").cast("string").alias("key"), F.col("string_val").cast("string").alias("value"), F.coalesce("expire_at_ms", F.lit(-1).cast("long")).alias("expire_at_ms"))


_IF = f"""case event_id % 6 when 0 then array('SET', {_K}, cast(event_id as string), 'NX') when 1 then array('SET', {_K}, cast(event_id as string), 'xx', 'EX', '9')
 when 2 then array('SETNX', {_K}, cast(event_id as string)) when 3 then array('DEL', {_K}) when 4 then array('SET', {_K}, cast(event_id as string), 'PX', '50', 'NX') else array('GET', {_K}) end"""


@_query(
    "with x as (select user_id % 4 as db_id, 'k:' || (user_id % 97) as k, event_id as seq, event_id % 6 as op from events), "
    "f as (select db_id, k, list(struct_pack(op := op, v := seq) order by seq) as ops from x group by db_id, k), "
    "s as (select db_id, k, list_reduce(list_prepend(struct_pack(op := -1, v := -1), ops), lambda a, b: case when b.op = 3 then struct_pack(op := 3, v := -1) "
    "when (b.op in (0, 2, 4) and a.v < 0) or (b.op = 1 and a.v >= 0) then b else a end) as st from f) "
    "select cast(db_id as int) as db_id, k as key, cast(st.v as varchar) as value, cast(case st.op when 1 then 1009000 when 4 then 1000050 else -1 end as bigint) as expire_at_ms from s where st.v >= 0",
)
def replay_conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET with NX and XX among removals; the oracle folds each key's commands in order."""
    s = replay.keyspace(_written(spark, sf_dir, _IF), now_ms=1_000_000, stretch=100)
    return s.select("db_id", F.col("key").cast("string").alias("key"), F.col("string_val").cast("string").alias("value"), F.coalesce("expire_at_ms", F.lit(-1).cast("long")).alias("expire_at_ms"))


_FLAGS = f"""case event_id % 7 when 0 then array('ZADD', 'z', 'NX', cast(event_id as string), {_K}) when 1 then array('ZADD', 'z', 'xx', 'CH', cast(event_id as string), {_K}, '7', 'NX')
 when 2 then array('ZREM', 'z', {_K}) when 3 then array('ZADD', 'z', 'CH', cast(event_id as string), {_K}) when 4 then array('ZADD', 'z', 'GT', cast(event_id as string), {_K})
 when 5 then array('ZADD', 'z', 'NX', 'INCR', '1', {_K}) else array('ZADD', 'z', 'NX', '1', 'x', '2', {_K}) end"""


@_query(
    "with x as (select user_id % 4 as db_id, 'k:' || (user_id % 97) as m, event_id as seq, event_id % 7 as op, event_id as score from events where event_id % 7 in (0, 1, 2, 3) "
    "union all select user_id % 4, 'k:' || (user_id % 97), event_id, 0, 2 from events where event_id % 7 = 6 union all select user_id % 4, 'x', event_id, 0, 1 from events where event_id % 7 = 6), "
    "f as (select db_id, m, list(struct_pack(op := op, v := score) order by seq) as ops from x group by db_id, m), "
    "s as (select db_id, m, list_reduce(list_prepend(struct_pack(op := -1, v := -1), ops), lambda a, b: case when b.op = 2 then struct_pack(op := 2, v := -1) "
    "when b.op = 3 or (b.op = 0 and a.v < 0) or (b.op = 1 and a.v >= 0) then b else a end).v as v from f) "
    "select cast(db_id as int) as db_id, m as member, cast(v as double) as score from s where v >= 0",
)
def replay_zadd_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ZADD with NX, XX and CH; those with GT and INCR are left out and reported."""
    s = replay.keyspace(_written(spark, sf_dir, _FLAGS), stretch=100).where("type = 'zset'")
    return s.select("db_id", F.explode("zset_val").alias("member", "score")).select("db_id", F.col("member").cast("string").alias("member"), "score")


@_query("select 'ZADD' as cmd_name, count(*) as n from events where event_id % 7 in (4, 5)")
def replay_left_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.unsupported(_written(spark, sf_dir, _FLAGS))


def _two_spaces(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """What the SETs of even and of odd users' first halves leave: the last value by key, of small and large values."""
    e = synth.entries(spark, sf_dir).where("cmd_name = 'SET'")
    space = lambda rows: replay.keyspace(rows).select("db_id", "key", "string_val")
    return space(e.where("seq % 3 <> 0")), space(e.where("seq % 3 <> 1"))


_TWO = """t as (select db_id, argv[2] as k, arg_max(argv[3], seq) as v from p where cmd = 'SET' and seq % 3 <> 0 group by all),
i as (select db_id, argv[2] as k, arg_max(argv[3], seq) as v from p where cmd = 'SET' and seq % 3 <> 1 group by all)"""


@_query(f"with {synth.SQL}, {_TWO} select coalesce(t.db_id, i.db_id) as db_id, coalesce(t.k, i.k) as key, coalesce(t.v, i.v) as value from t full join i on t.db_id = i.db_id and t.k = i.k")
def conflict_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = replay.restore_into(*_two_spaces(spark, sf_dir), "skip")
    return out.select("db_id", F.col("key").cast("string").alias("key"), F.col("string_val").cast("string").alias("value"))


@_query(f"with {synth.SQL}, {_TWO} select coalesce(t.db_id, i.db_id) as db_id, coalesce(t.k, i.k) as key, coalesce(i.v, t.v) as value from t full join i on t.db_id = i.db_id and t.k = i.k")
def conflict_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = replay.restore_into(*_two_spaces(spark, sf_dir), "rewrite")
    return out.select("db_id", F.col("key").cast("string").alias("key"), F.col("string_val").cast("string").alias("value"))


@_query(
    "select cmd as cmd_name, count(*) as n from (select 'HSET' as cmd from lineitem where l_returnflag <> 'R' "
    "union all select cmd from p where len(keys) = 1 and not starts_with(keys[1], 'temp:')) group by cmd"
)
def parse_filter_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole native path over events and lineitem: parse, filter, route by slot, count what goes out."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").where("l_returnflag <> 'R'")
    key = F.concat(F.lit("li:"), F.col("l_orderkey").cast("string"), F.lit(":"), F.col("l_linenumber").cast("string"))
    hset = F.array(*[c.cast("binary") for c in (F.lit("hset"), key, F.lit("qty"), F.col("l_quantity").cast("string"))])
    rows = items.select(F.lit("lineitem").alias("source_id"), F.col("l_orderkey").cast("long").alias("seq"), (F.col("l_suppkey") % 16).cast("int").alias("db_id"), hset.alias("argv"))
    entries = parse(synth.raw(spark, sf_dir).unionByName(rows)).where("size(keys) = 1")
    kept = filters.apply_filters(entries, FilterConfig(block_key_prefix=("temp:",)))
    routed = routing.route(kept, routing.even_routes(spark, NODES)).where("node is not null")
    return routed.groupBy("cmd_name").agg(F.count("*").alias("n"))


_LEFT = f"""{_REPLAY},
s as (select db_id, 'set|' || k || '|' || v as line from l where kind = 'string'),
li as (select db_id, 'rpush|' || k || '|' || v as line from l where kind = 'list'),
h as (select db_id, 'hset|' || k || '|' || f || '|' || arg_max(v, seq) as line from l where kind = 'hash' group by db_id, k, f),
z as (select db_id, 'zadd|' || k || '|' || arg_max(v, seq) || '|' || f as line from l where kind = 'zset' group by db_id, k, f)"""


@_query(f"{_LEFT} select * from s union all select * from li union all select * from h union all select * from z")
def rdb_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyspace as snapshot files, decoded again into commands."""
    space = _space(spark, sf_dir)
    rows = rdb.decode_files(snapshot.files(space, 50), rdb.Options(now_ms=0))
    return rows.select("db_id", _joined("argv").alias("line"))


@_query("select cast(seq // 500 as bigint) as file, db_id, array_to_string(argv, '|') as line from p")
def aof_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as wire text with a SELECT before each command, decoded again with SELECT absorbed."""
    raw = synth.raw(spark, sf_dir)
    select = F.array(F.lit(b"SELECT"), F.col("db_id").cast("string").cast("binary"))
    wire = F.concat(resp.encoded(select), resp.encoded(F.col("argv")))
    parts = raw.select((F.col("seq") / 500).cast("long").alias("file"), F.struct("seq", wire.alias("w")).alias("x")).groupBy("file")
    text = F.aggregate("ws", F.lit(b""), lambda acc, x: F.concat(acc, x["w"]))
    files = parts.agg(F.array_sort(F.collect_list("x")).alias("ws")).select(F.col("file").cast("string").alias("path"), text.alias("content"))
    rows = aof.decode_files(files)
    return rows.select(F.col("source_id").cast("long").alias("file"), "db_id", _joined("argv").alias("line"))


@_query("select seq, db_id, array_to_string(argv, '|') as line from p where cmd <> 'FOOCMD'")
def binary_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replication noise among the commands: FOOCMD reads as REPLCONF and goes."""
    raw = synth.raw(spark, sf_dir)
    noisy = F.when(F.get("argv", 0).cast("string") == "FOOCMD", F.array(F.lit(b"replconf"), F.lit(b"ack"))).otherwise(F.col("argv"))
    return filters.drop_noise(raw.withColumn("argv", noisy)).select("seq", "db_id", _joined("argv").alias("line"))


@_query(
    "select event_id as seq from events where event_id % 10 not in (0, 1, 2, 3, 4, 5) and not (event_id % 10 = 6 and event_id % 3 = 0)",
)
def noise_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What serves replication itself goes: six commands in any case, and greetings of watchers among other messages."""
    argv = """case event_id % 10 when 0 then array('ping') when 1 then array('SELECT', '3') when 2 then array('replconf', 'GETACK', '*') when 3 then array('Opinfo', 'x') when 4 then array('MULTI')
     when 5 then array('exec') when 6 then array('publish', if(event_id % 3 = 0, '__sentinel__:hello', 'news'), 'm') when 7 then array('SET', 'ping', 'x') else array('PINGS') end"""
    return filters.drop_noise(_written(spark, sf_dir, argv).select("source_id", "seq", "db_id", "argv")).select("seq")


@_query(
    "with x as (select event_id as seq, event_id % 6 as op, 'a' || (user_id % 9) as a, 'b' || (user_id % 5) as b, 1 + event_id % 3 as n from events), "
    "k as (select seq, case op when 0 then ['dst', a, b, 'c'][1 : n + 1] when 1 then [a, b, 'c'][1 : n] when 2 then [a, b] when 3 then [a] when 4 then ['dst', a] else [a, b, 'c'][1 : n] end as keys from x) "
    "select seq, array_to_string(keys, '|') as keys from k"
)
def keys_keynum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commands that tell the number of their keys: of a store and a script, of moves, and of several specifications."""
    a, b, n = "'a' || (user_id % 9)", "'b' || (user_id % 5)", "cast(1 + event_id % 3 as string)"
    some = f"slice(array({a}, {b}, 'c'), 1, cast(1 + event_id % 3 as int))"
    argv = f"""case event_id % 6 when 0 then concat(array('ZUNIONSTORE', 'dst', {n}), {some}, array('WEIGHTS', '1')) when 1 then concat(array('EVAL', 'return 1', {n}), {some}, array('arg'))
     when 2 then array('ZINTER', '2', {a}, {b}, 'WITHSCORES') when 3 then array('LMPOP', '1', {a}, 'LEFT') when 4 then array('ZDIFFSTORE', 'dst', '1', {a}) else concat(array('FCALL', 'f', {n}), {some}) end"""
    return _written(spark, sf_dir, argv).select("seq", _joined("keys").alias("keys"))


@_query(
    "with x as (select event_id as seq, event_id % 4 as op, 'a' || (user_id % 9) as a, 'b' || (user_id % 5) as b from events) "
    "select seq, case op when 0 then a || '|' || b when 1 then a || '|' || b when 2 then a || '|' || b else a end as keys from x"
)
def keys_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commands whose keys follow a word, or whose last keys do."""
    a, b = "'a' || (user_id % 9)", "'b' || (user_id % 5)"
    argv = f"""case event_id % 4 when 0 then array('XREAD', 'COUNT', '2', 'streams', {a}, {b}, '0', '0') when 1 then array('GEORADIUSBYMEMBER', {a}, 'm', '3', 'km', 'StoreDist', {b})
     when 2 then array('GEORADIUS', {a}, '1', '2', '3', 'km', 'STORE', {b}) else array('XREADGROUP', 'GROUP', 'g', 'c', 'STREAMS', {a}, '>') end"""
    return _written(spark, sf_dir, argv).select("seq", _joined("keys").alias("keys"))


@_query(
    "select file_seq, cast(user_id % 8 as varchar) as source_id, event_id as ordinal from (select *, event_id * 7 % 1000 as file_seq, lag(event_id * 7 % 1000) over (partition by user_id % 8 order by event_id) as before from events) where file_seq <= before"
)
def order_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    files = events.select((F.col("user_id") % 8).cast("string").alias("source_id"), F.col("event_id").alias("ordinal"), (F.col("event_id") * 7 % 1000).alias("file_seq"))
    return ordering.order_faults(files)


#: Events whose ids share a multiple of this are written to one piece of each part.
PIECE_IDS = 4096
_PARTS = "file base.aof seq 1 type b\nfile \"incr one.aof\" seq 1 type i\n# a note\n\nfile incr2.aof seq 2 type i\n"


@_query(
    "with x as (select event_id as seq, event_id % 3 as part, 1000 + event_id // 10 as ts, event_id % 5 as db from events), "
    "c as (select min(part * 1000000000 + seq) as cut from x, (select 1000 + max(event_id) // 30 as until from events) where part > 0 and ts > until) "
    "select seq, cast(db as int) as db_id, 'SET|k' || seq || '|v' as line from x, c where part = 0 or part * 1000000000 + seq < cut"
)
def manifest_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log in three parts with time stamps, named by a manifest and cut at a time: the base stays whole.

    The parts are written and decoded in pieces of at most PIECE_IDS commands, so no row or task holds a part.
    """
    parts = aof.parse_manifest(_PARTS)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    until = events.agg(1000 + F.floor(F.max("event_id") / 30)).first()[0]
    seq, text = F.col("event_id").cast("string"), lambda c: c.cast("binary")
    stamp = F.concat(F.lit("#TS:"), (1000 + F.floor(F.col("event_id") / 10)).cast("string"), F.lit("\r\n")).cast("binary")
    select = F.array(F.lit(b"SELECT"), text((F.col("event_id") % 5).cast("string")))
    wire = F.concat(stamp, resp.encoded(select), resp.encoded(F.array(F.lit(b"SET"), text(F.concat(F.lit("k"), seq)), F.lit(b"v"))))
    name = F.get(F.array(*[F.lit(p.file) for p in parts]), (F.col("event_id") % 3).cast("int"))
    piece = F.floor(F.col("event_id") / PIECE_IDS).alias("piece")
    written = events.groupBy(name.alias("path"), piece).agg(F.array_sort(F.collect_list(F.struct("event_id", wire.alias("w")))).alias("ws"))
    files = written.select("path", "piece", F.unhex(F.array_join(F.transform("ws", lambda x: F.hex(x["w"])), "")).alias("content"))
    rows = aof.decode_parts(files, parts, "log", until)
    key = F.get("argv", 1).cast("string")
    return rows.select(F.expr("substring(cast(argv[1] as string), 2)").cast("long").alias("seq"), "db_id", F.concat(F.lit("SET|"), key, F.lit("|v")).alias("line"))


def _decoder(name: str, make: Callable, sql: str, columns: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """A query that decodes the dumped values of packed.make into commands: key, ordinal, line."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = rdb.decode_large(packed.dumps(spark, sf_dir, make))
        if columns:
            return columns(rows)
        return rows.select(F.get("argv", 1).cast("string").alias("key"), "ordinal", _joined("argv").alias("line"))

    run.__name__, run.__doc__ = name, make.__doc__ or f"Values of {make.__name__[3:]}, decoded"
    _query(f"with o as (select *, 'u:' || user_id as key, row_number() over (partition by user_id order by event_id) as r, count(*) over (partition by user_id) as n, min(event_id) over (partition by user_id) as base, max(event_id) over (partition by user_id) as last from events) {sql}")(run)


_decoder(
    "decode_listpack",
    packed.of_listpack,
    "select key, cast((r - 1) * 4 + j as int) as ordinal, 'rpush|' || key || '|' || [event_type, cast(event_id as varchar), cast(-event_id as varchar), cast(event_id * 1000003 as varchar)][j + 1] as line from o, range(4) t(j) "
    "union all select distinct key, cast(4 * n as int), 'rpush|' || key || '|end' from o",
)
_decoder(
    "decode_ziplist",
    packed.of_ziplist,
    "select key, cast(r - 1 as int) as ordinal, 'hset|' || key || '|f' || event_id || '|' || case when event_id % 5 = 0 then repeat(event_type, 20) else cast((event_id % 20 - 5) * cast(10 ** (event_id % 12) as bigint) as varchar) end as line from o",
)
_decoder(
    "decode_intset",
    packed.of_intset,
    "select key, cast(r - 1 as int) as ordinal, 'sadd|' || key || '|' || (event_id * case when base % 3 <> 0 then 1 when base % 2 <> 0 then 100000 else 1000000000000 end) as line from o",
)
_decoder(
    "decode_lzf",
    packed.of_lzf,
    "select key, 0 as ordinal, 'set|' || key || '|' || repeat(event_type, cast(4 + n % 20 as int)) as line from o where r = 1",
)
_decoder(
    "decode_zset",
    packed.of_zset,
    "select key, cast(r - 1 as int) as ordinal, 'zadd|' || key || '|' || case when event_id % 4 = 0 then cast(event_id // 4 as varchar) else cast(event_id / 4 as varchar) end || '|m' || event_id as line from o",
)
_decoder(
    "decode_stream",
    packed.of_stream,
    "select key, cast(row_number() over (partition by user_id order by event_id) - 1 as int) as ordinal, 'xadd|' || key || '|' || event_id || '-0|' || case when event_id % 2 = 1 then 'type|' else 'other|' end || event_type as line from o where event_id % 5 <> 0 "
    "union all select key, cast(count(*) filter (event_id % 5 <> 0) as int), 'xsetid|' || key || '|' || max(event_id) || '-0' from o group by key "
    "union all select key, cast(1 + count(*) filter (event_id % 5 <> 0) as int), 'XGROUP|CREATE|' || key || '|g|' || max(event_id) || '-0' from o group by key "
    "union all select key, cast(2 + count(*) filter (event_id % 5 <> 0) as int), 'xclaim|' || key || '|g|c|0|' || max(event_id) || '-0|TIME|5000|RETRYCOUNT|3|JUSTID|FORCE' from o group by key",
    lambda rows: rows.select(F.when(F.get("argv", 0).cast("string") == "XGROUP", F.get("argv", 2)).otherwise(F.get("argv", 1)).cast("string").alias("key"), "ordinal", _joined("argv").alias("line")),
)
_decoder(
    "decode_bloom",
    packed.of_bloom,
    "select distinct key, 0 as ordinal, '1' as at, 73 as size from o union all select distinct key, 1, cast(n + 1 as varchar), cast(n as int) from o",
    lambda rows: rows.select(F.get("argv", 1).cast("string").alias("key"), "ordinal", F.get("argv", 2).cast("string").alias("at"), F.octet_length(F.get("argv", 3)).alias("size")),
)
_decoder(
    "decode_module_string",
    packed.of_module_string,
    "select key, 0 as ordinal, 'EXSET|' || key || '|' || event_type || '|ABS|' || event_id || '|FLAGS|' || (event_id % 7) as line from o where r = n",
)
