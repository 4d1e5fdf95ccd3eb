"""Files, live servers, sinks and configured runs, against hand-made bytes and a fake server."""

import json
import struct
import time
import urllib.request

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from kvflow import config
from kvflow.functions import snapshot
from kvflow.functions.resp import encode
from kvflow.operators import replay
from kvflow.operators.parse import parse
from kvflow.operators.transform import Call
from kvflow.plans import pipeline
from kvflow.sinks import files, server
from kvflow.sources import aof, rdb, replication, scan
from kvflow.sources.client import Address, Connection, scanned, shard_addresses
from kvflow.streaming.status import Status, human_bytes, serve
from tests import encode as e
from tests.fakeserver import FakeServer


@pytest.fixture
def servers():
    made = []

    def new(**options):
        made.append(FakeServer(**options))
        return made[-1]

    yield new
    for s in made:
        s.close()


def texts(df, *order):
    return [[bytes(a).decode() for a in r.argv] for r in df.orderBy(*(order or ("source_id", "seq"))).collect()]


SNAPSHOT = e.snapshot(b"\xfe" + e.length(1), e.entry(0, b"a", e.string(b"1")), b"\xfc" + struct.pack("<Q", 1 << 45) + e.entry(0, b"b", e.string(b"2")))


def test_snapshot_sources(spark, tmp_path):
    for name in ("x.rdb", "y.rdb"):
        (tmp_path / name).write_bytes(SNAPSHOT)
    pipeline.register(spark)
    df = rdb.read_rdb(spark, f"{tmp_path}/*.rdb", rdb.Options(now_ms=(1 << 45) - 9))
    assert texts(df) == 2 * [["set", "a", "1"], ["set", "b", "2"], ["pexpire", "b", "9"]]
    assert {r.db_id for r in df.collect()} == {1}
    pruned = spark.read.format("rdb").option("path", f"{tmp_path}/x.rdb,{tmp_path}/y.rdb").option("key_prefixes", "a").load()
    assert texts(pruned) == 2 * [["set", "a", "1"]]


def log(*commands):
    return b"".join(c if isinstance(c, bytes) else encode(c.split()) for c in commands)


def test_log_files(spark, tmp_path):
    body = log("set a 1", b"#TS:1233\r\n", "select 2", encode(["set", "b", b"x\r\ny\n"]), b"#TS:1235\r\n", "set c 1")
    (tmp_path / "one.aof").write_bytes(body)
    df = aof.read_aof(spark, str(tmp_path / "one.aof"))
    assert [(r.seq, r.db_id, r.ts) for r in df.orderBy("seq").collect()] == [(0, 0, None), (2, 2, 1233), (3, 2, 1235)]
    assert bytes(df.where("seq = 2").first().argv[2]) == b"x\r\ny\n"
    assert texts(aof.read_aof(spark, str(tmp_path / "one.aof"), until=1234)) == [["set", "a", "1"], ["set", "b", "x\r\ny\n"]]
    pipeline.register(spark)
    assert spark.read.format("aof").option("path", str(tmp_path / "one.aof")).option("timestamp", 1234).load().count() == 3
    with pytest.raises(PySparkException):
        (tmp_path / "bad.aof").write_bytes(body[:-3])
        aof.read_aof(spark, str(tmp_path / "bad.aof")).collect()


def test_parts(spark, tmp_path):
    (tmp_path / "f.1.base.rdb").write_bytes(SNAPSHOT + log("set base 1"))
    (tmp_path / "f.1.incr.aof").write_bytes(log(b"#TS:1233\r\n", "set k2 2"))
    (tmp_path / "f.2.incr.aof").write_bytes(log(b"#TS:1235\r\n", "set k3 3"))
    parts = [aof.Part("f.1.base.rdb", 1, "b"), aof.Part("f.1.incr.aof", 1, "i"), aof.Part("f.2.incr.aof", 2, "i")]
    (tmp_path / "f.manifest").write_text("# parts\n" + aof.format_manifest(parts))
    keys = lambda until: [a[1] for a in texts(aof.read_multipart(spark, str(tmp_path), "f.manifest", until))]
    assert keys(0) == ["a", "b", "b", "base", "k2", "k3"]
    assert keys(1234) == ["a", "b", "b", "base", "k2"]
    assert {r.db_id for r in aof.read_multipart(spark, str(tmp_path), "f.manifest").where("seq < 3").collect()} == {1}


def test_parts_in_pieces(spark):
    """Databases and cuts pass from piece to piece and from part to part, also where a late stamp ends a piece; the base stays whole."""
    parts = [aof.Part("b", 1, "b"), aof.Part("i", 1, "i"), aof.Part("j", 2, "i")]
    late = b"#TS:99\r\n"
    cut = [
        ("j", 0, log("set g 1")),
        ("i", 7, log("set f 1")),
        ("i", 3, log(b"#TS:12\r\n", "set e 1", late)),
        ("i", 0, log("set c 1", "select 2", b"#TS:11\r\n", encode(["set", "d", late]))),
        ("b", 1, log("set b 1", late)),
        ("b", 0, log(late, "select 5", "set a 1")),
    ]
    files = spark.createDataFrame([(n, p, bytearray(c)) for n, p, c in cut], "path string, piece long, content binary").repartition(3)
    shown = lambda df: [(bytes(r.argv[1]).decode(), r.db_id) for r in df.orderBy("seq").collect()]
    whole = [("a", 5), ("b", 5), ("c", 5), ("d", 2), ("e", 2)]
    assert shown(aof.decode_parts(files, parts, "s")) == whole + [("f", 2), ("g", 2)]
    assert shown(aof.decode_parts(files, parts, "s", 50)) == whole
    assert shown(aof.decode_parts(files, parts, "s", 11)) == whole[:4]
    unsplit = spark.createDataFrame([("b", bytearray(b"")), ("i", bytearray(log("set e 1", late))), ("j", bytearray(log("set g 1")))], "path string, content binary")
    assert shown(aof.decode_parts(unsplit, parts, "s", 50)) == [("e", 0)]
    with pytest.raises(PySparkException, match="the numbers end"):
        aof.decode_parts(files.withColumn("piece", F.lit(1 << 20)), parts, "s").collect()
    with pytest.raises(ValueError, match="more than"):
        list(aof._bounded(iter([(4, 0, [], None), (5, 0, [], None)]), 5))


def test_manifests():
    assert aof.split_args(r'''a "b c\x41\n\"" 'd\'e' ''') == ["a", 'b cA\n"', "d'e"]
    odd = [aof.Part('a "b"\x01.aof', 3, "h")]
    assert aof.parse_manifest(aof.format_manifest(odd)) == odd
    for bad in ("", "file a seq 1", "file a seq 1 type b\nfile b seq 2 type b", "file a/b seq 1 type i", "file a seq 2 type i\nfile b seq 2 type i", "file a seq 0 type i", "file a seq 1 type q", 'file "a seq 1 type i', '"a"b c d e f g'):
        with pytest.raises(ValueError):
            aof.parse_manifest(bad)


def test_client(servers):
    s = servers(data={0: {b"a": b"1"}, 3: {b"b": b"2"}}, password="pw", replication_info="slave0:ip=9.9.9.9,port=1,state=online,offset=5,lag=0\r\n")
    at = Address(s.address, password="pw")
    with Connection(at) as c:
        assert c.databases() == [0, 3] and list(c.keys(1)) == [b"a", b"a"]
    with pytest.raises(Exception, match="WRONGPASS"):
        Connection(Address(s.address, password="no"))
    assert shard_addresses(at, False) == [s.address] and shard_addresses(at, False, True) == ["9.9.9.9:1"]
    listing = f"a {s.address}@1 master - 0 0 1 connected 0-16383\nb 7.7.7.7:7@1 slave a 0 0 1 connected"
    cluster = servers(listing=lambda: listing)
    assert shard_addresses(Address(cluster.address), True) == [s.address]
    assert shard_addresses(Address(cluster.address), True, True) == ["7.7.7.7:7"]


def test_scan_to_server(spark, servers):
    source = servers(data={0: {b"a": b"1", b"big": b"x" * 200}, 2: {b"b": b"2"}}, ttl={(2, b"b"): 5000})
    to = servers(data={0: {b"a": b"old"}})
    cfg = lambda how: config.parse(f'[scan_reader]\naddress = "{source.address}"\ncount = 2\n[writer]\naddress = "{to.address}"\n[advanced]\ntarget_proto_max_bulk_len = 100\nrdb_restore_command_behavior = "{how}"')
    pipeline.run(spark, cfg("skip"))
    assert to.data == {0: {b"a": b"old", b"big": b"x" * 200}, 2: {b"b": b"2"}}
    assert [c[:3] for db, c in to.log if db == 2] == [[b"RESTORE", b"b", b"5000"]]
    with pytest.raises(PySparkException, match="BUSYKEY"):
        pipeline.run(spark, cfg("panic"))
    pipeline.run(spark, cfg("rewrite"))
    assert to.data[0][b"a"] == b"1"
    assert spark.read.format("kvscan").options(address=source.address, dbs="2").load().count() == 1


def test_cluster_and_sentinel_sinks(spark, servers):
    one, two = servers(), servers()
    listing = lambda: f"a {one.address}@1 master - 0 0 1 connected 0-8191\nb {two.address}@1 master - 0 0 1 connected 8192-16383"
    one.listing = listing
    rows = [("s", i, 0, [b"SET", b"k%d" % i, b"v"]) for i in range(20)] + [("s", 20, 0, [b"FLUSHSOMETHING"])]
    entries = parse(spark.createDataFrame(rows, "source_id string, seq long, db_id int, argv array<binary>"))
    sent = server.write(entries, server.Target(Address(one.address), "cluster", on_exists="skip"))
    assert sum(n for *_, n, _ in sent) == 22
    assert len(one.data[0]) + len(two.data[0]) == 20 and one.data[0] and two.data[0]
    assert [c for _, c in one.log if c[0] == b"FLUSHSOMETHING"] and [c for _, c in two.log if c[0] == b"FLUSHSOMETHING"]
    order = [int(c[1][1:]) for _, c in one.log if c[0] == b"SET"]
    assert order == sorted(order)
    plain, watch = servers(data={0: {b"old": b"x"}}), servers()
    watch.listing = lambda: plain.address
    server.write(entries.where("seq < 2"), server.Target(Address(watch.address), "sentinel", "m", on_exists="skip", empty_first=True, off_reply=True))
    assert set(plain.data[0]) == {b"k0", b"k1"}
    with pytest.raises(ValueError):
        server.Target(Address("x:1"), off_reply=True)
    boom = parse(spark.createDataFrame([("s", 0, 0, [b"BOOM"])], "source_id string, seq long, db_id int, argv array<binary>"))
    with pytest.raises(PySparkException, match="boom"):
        server.write(boom, server.Target(Address(plain.address)))


@pytest.mark.parametrize("diskless", [False, True])
def test_replication(spark, servers, tmp_path, diskless):
    stream = log("ping", "select 4", "set x 1", "multi", "set y 2", "exec", encode(["PUBLISH", "__sentinel__:hello", "z"]), "select 0", "set temp:z 3", "set w 4")
    source = servers(snapshot=SNAPSHOT, stream=stream, diskless=diskless)
    cfg = config.parse(f'[sync_reader]\naddress = "{source.address}"\ntry_diskless = {str(diskless).lower()}\n[filter]\nblock_key_prefix = ["temp:"]')
    table, status = files.KeyspaceTable(spark, str(tmp_path / "space")), Status()
    queries = pipeline.run_sync(spark, cfg, str(tmp_path / "work"), lambda df, n: table.upsert(df, n + 1), status, {"processingTime": "100 milliseconds"})
    try:
        queries[0].processAllAvailable()
        got = {(r.db_id, bytes(r.key)): bytes(r.string_val) for r in table.read().collect()}
    finally:
        queries[0].stop()
    assert got == {(1, b"a"): b"1", (1, b"b"): b"2", (4, b"x"): b"1", (4, b"y"): b"2", (0, b"w"): b"4"}
    assert status.document()["per_cmd_entries_count"]["SET"] == {"read_count": 4, "write_count": 3}
    http = serve(status)
    try:
        got = json.load(urllib.request.urlopen(f"http://127.0.0.1:{http.server_address[1]}/", timeout=5))
    finally:
        http.shutdown()
    assert got["total_entries_count"]["write_count"] == 3 and set(got) == {"start_time", "consistent", "total_entries_count", "per_cmd_entries_count", "reader", "writer"}


def test_snapshot_mark_in_pieces(servers, tmp_path):
    source = servers(snapshot=SNAPSHOT * 30, diskless=True)
    at = replication.take_snapshot(Address(source.address), str(tmp_path / "d.rdb"), True)
    assert (tmp_path / "d.rdb").read_bytes() == SNAPSHOT * 30 and (at.run_id, at.offset) == ("run1", 100)


@pytest.mark.parametrize("state", [True, False])
def test_notifications(servers, tmp_path, state):
    source = servers(data={0: {b"a": b"1"}, 11: {b"b": b"2"}})
    options = {"address": source.address, "wait_seconds": "1", "task_rows": "2"} | ({"state": str(tmp_path / "events")} if state else {})
    reader = scan.NotifyDataSource(options).streamReader(None)
    start = reader.initialOffset()
    assert reader.latestOffset() == start
    source.notify(0, "set", "a")
    source.notify(11, "set", "b")
    source.notify(0, "expired", "gone")
    source.notify(0, "set", "a")
    end = reader.latestOffset()
    parts = reader.partitions(start, end)
    assert len(parts) == 2
    rows = [r for p in parts for r in reader.read(p)]
    assert [(r[1], r[2], r[3], r[4] is None) for r in rows] == [(0, 11, b"b", False), (1, 0, b"gone", True), (2, 0, b"a", False)]
    fresh = scan.NotifyDataSource(options).streamReader(None)
    if state:  # another process finds the planned batch, and goes on after it
        assert [r for p in fresh.partitions(start, end) for r in fresh.read(p)] == rows
        assert fresh.initialOffset() == start and fresh._last() == end["seq"]
    else:
        with pytest.raises(ValueError):
            fresh.partitions(start, end)
    reader.commit(end)
    source.notify(0, "set", "a")
    after = reader.latestOffset()
    assert after["seq"] == end["seq"] + 1 and len(reader.partitions(end, after)) == 1
    reader.commit(after)
    assert len(reader._names()) == 1
    reader.stop()


class Killed(Exception):
    pass


def _interrupted(spark, raw, cfg, tmp_path, happen=None):
    """Rows that a sink gets when the query dies inside its first batch and is started again from its checkpoint."""
    got = []

    def dies(df, n):
        if df.count():
            raise Killed

    def takes(df, n):
        got.extend((n, r.db_id, [bytes(a) for a in r.argv]) for r in df.collect())

    for sink in (dies, takes):
        query = pipeline.stream(raw(), cfg, str(tmp_path / "checkpoint"), sink, None, {"processingTime": "100 milliseconds"})
        try:
            if happen:
                happen()
                happen = None
            query.processAllAvailable()
        except Exception:
            assert sink is dies
        finally:
            query.stop()
    return got


def test_replication_goes_on_after_a_restart(spark, servers, tmp_path):
    source = servers(stream=log("select 4", "set x 1", "set y 2", "select 7", "set z 3", "ping", "set w 4"))
    pipeline.register(spark)
    options = {"address": source.address, "run_id": "run1", "offset": "100", "db": "2", "state": str(tmp_path / "state"), "max_bytes": "40"}
    cfg = config.parse(f'[sync_reader]\naddress = "{source.address}"')
    got = _interrupted(spark, lambda: spark.readStream.format("kvreplica").options(**options).load(), cfg, tmp_path)
    assert sorted((db, argv[1]) for _, db, argv in got) == [(4, b"x"), (4, b"y"), (7, b"w"), (7, b"z")]
    assert len({n for n, *_ in got}) > 1 and source.acks
    with pytest.raises(ValueError):
        replication.ReplicaDataSource({"address": source.address}).streamReader(None)
    lost = replication.ReplicaDataSource(options | {"state": str(tmp_path / "other")}).streamReader(None)
    with pytest.raises(ValueError):
        list(lost.read(replication.Stretch(140, 180)))


def test_notifications_go_on_after_a_restart(spark, servers, tmp_path):
    source = servers(data={0: {b"a": b"1", b"b": b"2"}})
    pipeline.register(spark)
    cfg = config.parse(f'[scan_reader]\naddress = "{source.address}"\nksn = true')
    options = {"address": source.address, "state": str(tmp_path / "events")}

    def happen():
        until = time.monotonic() + 30
        while not source.listeners and time.monotonic() < until:
            time.sleep(0.05)
        source.notify(0, "set", "a")
        source.notify(0, "del", "c")

    raw = lambda: scan.as_commands(spark.readStream.format("kvnotify").options(**options).load(), 1000, True).drop("ordinal")
    got = _interrupted(spark, raw, cfg, tmp_path, happen)
    assert sorted(argv[:2] for _, _, argv in got) == [[b"DEL", b"c"], [b"RESTORE", b"a"]]


def test_scan_progress_and_function_log(servers, caplog):
    assert scanned(0) == 100 and scanned(1 << 63) < 1e-9 and round(scanned(1)) == 50 and round(scanned(3)) == 75
    source = servers(data={0: {b"a": b"1", b"b": b"2", b"c": b"3"}})
    told = []
    with Connection(Address(source.address)) as c:
        assert set(c.keys(2, told.append)) == {b"a", b"b", b"c"}
    assert len(told) == 2 and told[-1] == 100
    with caplog.at_level("INFO", "kvflow.function"):
        Call(0, "STRING", "GET", [b"k"], [1], [], [b"GET", b"k"]).log("seen")
    assert "function: seen" in caplog.text


def test_database_of_a_following_log():
    aux = lambda k, v: bytes([250]) + e.string(k) + e.string(v)
    import io

    assert rdb.stream_db(io.BytesIO(e.snapshot(aux(b"redis-ver", b"7"), aux(b"repl-stream-db", b"3"), aux(b"x", b"y")))) == 3
    assert rdb.stream_db(io.BytesIO(e.snapshot(aux(b"redis-ver", b"7"), e.entry(0, b"k", e.string(b"v"))))) == 0


def test_scanned_as_commands(spark):
    rows = [("s", 0, 0, b"a", rdb.dump_value(0, e.string(b"1")), -1), ("s", 1, 0, b"gone", None, -2), ("s", 2, 0, b"big", rdb.dump_value(0, e.string(b"x" * 99)), 4)]
    got = texts(scan.as_commands(spark.createDataFrame(rows, scan.SCHEMA), 50, True).withColumn("argv", F.expr("slice(argv, 1, 2)")), "seq", "ordinal")
    assert got == [["RESTORE", "a"], ["DEL", "gone"], ["set", "big"], ["pexpire", "big"]]


def test_log_sink(spark, tmp_path):
    rows = [("s", i, i // 2, [b"SET", b"k%d" % i, b"v"]) for i in range(5)]
    files.write_log(spark.createDataFrame(rows, "source_id string, seq long, db_id int, argv array<binary>"), str(tmp_path / "log"))
    (tmp_path / "back.aof").write_bytes(files.read_log_bytes(spark.read.parquet(str(tmp_path / "log"))))
    back = aof.read_aof(spark, str(tmp_path / "back.aof")).orderBy("seq").collect()
    assert [(r.db_id, [bytes(a) for a in r.argv]) for r in back] == [(r[2], r[3]) for r in rows]


def test_config(tmp_path):
    text = '[scan_reader]\naddress = "${HOST}:1"\ndbs = [1]\n[rdb_reader]\nfilepath = "x"\n[filter]\nallow_db = [1]\nfunction = "def function(call):\\n  yield call.db, call.argv"\n[redis_writer]\naddress = "b:2"\ncluster = true\n[advanced]\ntarget_redis_proto_max_bulk_len = 7'
    (tmp_path / "c.toml").write_text(text)
    c = config.parse(text, {"HOST": "h"})
    assert (c.reader.address, c.reader.dbs, c.filter.allow_db, c.writer.cluster, c.advanced.target_proto_max_bulk_len) == ("h:1", (1,), (1,), True, 7)
    assert config.load(str(tmp_path / "c.toml")).writer == c.writer
    assert pipeline.compile_function(c.function) is not None and pipeline.compile_function("") is None
    for bad in ("[filter]\nallow_db = [1]", "[rdb_reader]\nnope = 1", '[rdb_reader]\n[advanced]\nrdb_restore_command_behavior = "x"'):
        with pytest.raises(ValueError):
            config.parse(bad, {})
    with pytest.raises(SyntaxError):
        pipeline.compile_function("def function(:")
    assert config.psync_command("a:1@xpsync,b:2@y", "a:1") == "xpsync" and config.psync_command("a:12@x", "a:1") == "psync"


def test_function_run(spark, tmp_path):
    (tmp_path / "x.rdb").write_bytes(SNAPSHOT)
    source = "def function(call):\n    if call.cmd == 'SET':\n        yield call.db + 1, ['SET', b'new:' + call.keys[0], call.argv[2]]"
    cfg = config.parse(f'[rdb_reader]\nfilepath = "{tmp_path}/x.rdb"\n[filter]\nblock_key_prefix = ["new:"]\nfunction = """{source}"""')
    out = pipeline.transform_entries(pipeline.read_batch(spark, cfg), cfg)
    assert texts(out) == [["SET", "new:a", "1"], ["SET", "new:b", "2"]] and {r.db_id for r in out.collect()} == {2}


def test_written_snapshots(spark):
    commands = ["SET s " + "v" * 70, "SET big " + "w" * 20000, "RPUSH l a b a", "SADD m x y", "HSET h f 1 g 2", "ZADD z 1.5 a inf b -3 c", "PEXPIREAT s 4398046511104"]
    rows = [("s", i, 5 if c.startswith("SET big") else 3, [w.encode() for w in c.split()]) for i, c in enumerate(commands)]
    space = replay.keyspace(parse(spark.createDataFrame(rows, "source_id string, seq long, db_id int, argv array<binary>"), False))
    back = rdb.decode_files(snapshot.files(space, 2), rdb.Options(now_ms=0))
    again = replay.keyspace(parse(back.where("argv[0] <> cast('pexpire' as binary)").select("source_id", "seq", "db_id", "argv"), False))
    columns = ["db_id", "key", "type", "string_val", "list_val", "set_val", "hash_val", "zset_val"]
    order = lambda df: sorted((tuple(r) for r in df.select(columns).collect()), key=lambda r: r[:2])
    assert order(again) == order(space)
    assert {r.expire_at_ms for r in back.where("argv[1] = cast('s' as binary)").collect()} == {4398046511104}


def test_sizes_and_lines(spark, tmp_path):
    (tmp_path / "p.aof").write_bytes(b"x" * 1536)
    assert aof.total_size(spark, str(tmp_path), [aof.Part("p.aof", 1, "i")]) == 1536
    assert human_bytes(1536) == "1.5 KiB" and human_bytes(1500, 1000) == "1.5 kB" and human_bytes(3) == "3 B"
    status = Status()
    status.add({"SET": 3, "DEL": 1}, {"SET": 2})
    status.tick()
    assert status.line().startswith("read 4") and "written 2" in status.line()
