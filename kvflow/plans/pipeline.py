"""A configured run: reader, parse, filter, function, writer; the same transformation for batches and streams."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from kvflow.config import AofReader, Config, RdbReader, ScanReader, SyncReader, psync_command
from kvflow.operators.filters import apply_filters, drop_noise
from kvflow.operators.parse import parse
from kvflow.operators.transform import TableFunction, apply_function
from kvflow.sinks import server
from kvflow.sources import aof, rdb, replication, scan
from kvflow.sources.client import Address, shard_addresses
from kvflow.streaming.status import Status

SOURCES = (rdb.RdbDataSource, aof.AofDataSource, scan.ScanDataSource, scan.NotifyDataSource, replication.ReplicaDataSource)


def register(spark: SparkSession) -> None:
    """Make format("rdb"), "aof", "kvscan", "kvnotify" and "kvreplica" known."""
    for source in SOURCES:
        spark.dataSource.register(source)


def compile_function(source: str) -> TableFunction | None:
    """The ``function`` that a piece of Python defines; errors in it are raised here, before any row is read."""
    if not source.strip():
        return None
    names: dict = {}
    exec(compile(source, "<function>", "exec"), names)  # noqa: S102 - the user's own configuration
    if not callable(names.get("function")):
        raise ValueError("the source must define function(call)")
    return names["function"]


def transform_entries(raw: DataFrame, cfg: Config, function: TableFunction | None = None) -> DataFrame:
    """Parse, filter, apply the function, parse again.  What the function emits isn't filtered."""
    function = function or compile_function(cfg.function)
    needs_slots = function is not None or bool(cfg.writer and cfg.writer.cluster)
    entries = apply_filters(parse(raw, needs_slots), cfg.filter)
    return apply_function(entries, function)


def _address(section) -> Address:
    return Address(section.address, section.username, section.password, section.tls)


def _options(section, **more: object) -> dict[str, str]:
    base = {"address": section.address, "username": section.username, "password": section.password, "tls": section.tls}
    return {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in {**base, **more}.items()}


def read_batch(spark: SparkSession, cfg: Config) -> DataFrame:
    """The bounded part of the configured reader: source_id, seq, db_id, argv."""
    r = cfg.reader
    bloom = cfg.module.target_mbbloom_version
    if isinstance(r, RdbReader):
        return rdb.read_rdb(spark, r.filepath, rdb.Options(cfg.filter.allow_db, bloom_version=bloom)).drop("expire_at_ms")
    if isinstance(r, AofReader):
        if r.filepath.endswith(".manifest"):
            folder, _, name = r.filepath.rpartition("/")
            return aof.read_multipart(spark, folder or ".", name, r.timestamp).drop("ts")
        return aof.read_aof(spark, r.filepath, r.timestamp).drop("ts")
    if isinstance(r, ScanReader):
        if not r.scan:
            return spark.createDataFrame([], "source_id string, seq long, db_id int, argv array<binary>")
        scanned = _scanned(spark, r)
        # Keys that a scan meets twice count once.
        return scan.as_commands(scanned.dropDuplicates(["source_id", "db_id", "key"]), cfg.advanced.target_proto_max_bulk_len, cfg.advanced.rdb_restore_command_behavior == server.REWRITE, bloom)
    if not r.sync_rdb:
        return spark.createDataFrame([], "source_id string, seq long, db_id int, argv array<binary>")
    raise ValueError("a replication reader is run by run_sync")


def _scanned(spark: SparkSession, r: ScanReader) -> DataFrame:
    o = _options(r, cluster=r.cluster, prefer_replica=r.prefer_replica, count=r.count, dbs=",".join(map(str, r.dbs)))
    return spark.read.format("kvscan").options(**o).load()


def target(cfg: Config) -> server.Target:
    w, a = cfg.writer, cfg.advanced
    if w is None:
        raise ValueError("a writer section is needed")
    mode = "cluster" if w.cluster else "sentinel" if w.sentinel else "standalone"
    return server.Target(_address(w), mode, w.master, a.rdb_restore_command_behavior, a.pipeline_count_limit, a.target_client_max_querybuf_len, w.off_reply, a.empty_db_before_sync)


def run(spark: SparkSession, cfg: Config, status: Status | None = None) -> list[tuple[str, str, int, int]]:
    """Move the bounded part of the reader to the writer; returns server.write's counts."""
    register(spark)
    entries = transform_entries(read_batch(spark, cfg), cfg)
    sent = server.write(entries, target(cfg))
    if status is not None:
        status.add({}, {"*": sum(s[2] for s in sent)})
    return sent


Sink = Callable[[DataFrame, int], None]


def stream(raw: DataFrame, cfg: Config, checkpoint: str, sink: Sink | None = None, status: Status | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Start moving a stream of source_id, seq, db_id, argv.  sink(entries, batch) takes each batch; the configured writer if None."""
    function = compile_function(cfg.function)
    to = None if sink else replace(target(cfg), empty_first=False)

    def each(batch: DataFrame, number: int) -> None:
        rows = drop_noise(batch)
        entries = transform_entries(rows, cfg, function)
        if status is not None:
            rows = rows.persist()
            status.count(parse(rows, False), entries)
        if sink:
            sink(entries, number)
        else:
            server.write(entries, to)
        if status is not None:
            rows.unpersist()

    writer = raw.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def _take_snapshots(spark: SparkSession, cfg: Config, folder: str, addresses: list[str]) -> dict[str, replication.Handover]:
    """Each shard's snapshot, received by a task of its own into the shared folder, and where its log goes on."""
    r: SyncReader = cfg.reader
    base, advanced = _address(r), cfg.advanced

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for address in (a for b in batches for a in b.column(0).to_pylist()):
            path = replication.snapshot_path(folder, address)
            at = replication.take_snapshot(replace(base, address=address), path, r.try_diskless, psync_command(advanced.aws_psync, address))
            with open(path, "rb") as f:
                db = rdb.stream_db(f)
            yield pa.RecordBatch.from_pydict({"address": [address], "run_id": [at.run_id], "offset": [at.offset], "db": pa.array([db], pa.int32())})

    listed = spark.createDataFrame([(a,) for a in addresses], "address string").repartition(len(addresses), "address")
    taken = listed.mapInArrow(receive, "address string, run_id string, offset long, db int").collect()
    return {t.address: replication.Handover(t.run_id, t.offset, t.db) for t in taken}


def run_sync(spark: SparkSession, cfg: Config, folder: str, sink: Sink | None = None, status: Status | None = None, trigger: dict | None = None) -> list[StreamingQuery]:
    """Replication: take each shard's snapshot into folder, move it, then stream its log from where the snapshot ends.

    folder: a path that the driver and all executors mount.
    """
    register(spark)
    r: SyncReader = cfg.reader
    to = None if sink else target(cfg)
    queries = []
    addresses = shard_addresses(_address(r), r.cluster, r.prefer_replica)
    taken = _take_snapshots(spark, cfg, folder, addresses)
    for i, address in enumerate(addresses):
        at, path = taken[address], replication.snapshot_path(folder, address)
        if r.sync_rdb:
            rows = spark.read.format("rdb").option("path", path).option("bloom_version", cfg.module.target_mbbloom_version).load().drop("expire_at_ms")
            entries = transform_entries(rows, cfg)
            sink(entries, -1) if sink else server.write(entries, to if i == 0 else replace(to, empty_first=False))
        os.remove(path)
        if r.sync_aof:
            # A state folder for each handover: offsets of another run mean nothing here.
            state = os.path.join(folder, f"state-{i}-{at.run_id}-{at.offset}")
            o = _options(replace(r, address=address), run_id=at.run_id, offset=at.offset, db=at.db, state=state, psync_command=psync_command(cfg.advanced.aws_psync, address))
            log = spark.readStream.format("kvreplica").options(**o).load()
            queries.append(stream(log, cfg, os.path.join(folder, f"checkpoint-{i}-{at.run_id}-{at.offset}"), sink, status, trigger))
    return queries


def run_notify(spark: SparkSession, cfg: Config, checkpoint: str, sink: Sink | None = None, status: Status | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Keyspace notifications as a stream of RESTORE and DEL commands; values always replace."""
    register(spark)
    r: ScanReader = cfg.reader
    state = f"{checkpoint.rstrip('/')}-events"
    raw = spark.readStream.format("kvnotify").options(**_options(r, dbs=",".join(map(str, r.dbs)), state=state)).load()
    commands = scan.as_commands(raw, cfg.advanced.target_proto_max_bulk_len, True, cfg.module.target_mbbloom_version)
    return stream(commands.drop("ordinal"), cfg, checkpoint, sink, status, trigger)
