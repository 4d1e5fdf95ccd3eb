"""Parsing, filters, transforms, routing, replay and ordering on small tables."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from kvflow import catalog
from kvflow.functions import hashing, resp
from kvflow.operators import filters, ordering, replay, routing, transform, values
from kvflow.operators.filters import FilterConfig
from kvflow.operators.parse import parse
from kvflow.sinks import files

RAW = "source_id string, seq long, db_id int, argv array<binary>"


def raw(spark, *commands, source="s"):
    rows = []
    for i, c in enumerate(commands):
        db, words = c if isinstance(c, tuple) else (0, c)
        words = words.split() if isinstance(words, str) else words
        rows.append((source, i, db, [w if isinstance(w, bytes) else w.encode() for w in words]))
    return spark.createDataFrame(rows, RAW)


def test_catalogue():
    assert len(catalog.commands()) == 398
    assert catalog.commands()["BF.ADD"][0] == "BLOOM FILTER"


KEYS = {
    "SET key value": ("SET", "STRING", "key"),
    "mset key1 value1 key2 value2": ("MSET", "STRING", "key1 key2"),
    "XADD key * field1 value1 field2 value2": ("XADD", "STREAM", "key"),
    "ZUNIONSTORE key 2 key1 key2": ("ZUNIONSTORE", "SORTED_SET", "key key1 key2"),
    "COMMAND": ("COMMAND", "SERVER", ""),
    "xgroup create s g 0": ("XGROUP-CREATE", "STREAM", "s"),
    "GEORADIUS g 0 0 1 m": ("GEORADIUS", "GEO", "g"),
    "GEORADIUS g 0 0 1 m STORE d": ("GEORADIUS", "GEO", "g d"),
    "GEORADIUS g 0 0 1 m storedist d": ("GEORADIUS", "GEO", "g d"),
    "XREAD COUNT 2 STREAMS a b 0 0": ("XREAD", "STREAM", "a b"),
    "XREADGROUP GROUP g c STREAMS a 0": ("XREADGROUP", "STREAM", "a"),
    "EVAL x 2 a b c": ("EVAL", "SCRIPTING", "a b"),
    "EVAL x 0": ("EVAL", "SCRIPTING", ""),
    "EVAL x 9 a": ("EVAL", "SCRIPTING", "a"),
    "EVAL x nine a": ("EVAL", "SCRIPTING", ""),
    "EVAL x": ("EVAL", "SCRIPTING", ""),
    "BLPOP a b 0": ("BLPOP", "LIST", "a b"),
    "BITOP AND d a b": ("BITOP", "BITMAP", "d a b"),
    "LCS a b": ("LCS", "STRING", "a b"),
    "OBJECT freq k": ("OBJECT-FREQ", "GENERIC", "k"),
    "nosuch k": ("NOSUCH", "unknown", ""),
    "GET": ("GET", "STRING", ""),
}


def test_keys(spark):
    got = parse(raw(spark, *KEYS)).orderBy("seq").collect()
    for (text, (name, group, keys)), r in zip(KEYS.items(), got, strict=True):
        assert (r.cmd_name, r.group, b" ".join(map(bytes, r["keys"])).decode()) == (name, group, keys), text
        argv = text.encode().split()
        assert [argv[i - 1] for i in r.key_indexes] == [bytes(k) for k in r["keys"]]
        assert r.serialized_size == len(resp.encode(argv))
        assert r.slots == [hashing.slot_of(bytes(k)) for k in r["keys"]]
        specs = catalog.commands().get(name, ("", ()))[1]
        assert [i for s in specs for i in s.positions(argv)] == [i - 1 for i in r.key_indexes]


SLOTS = [
    (b"abcde", 16097), (b"abcde{", 14689), (b"abcde}", 6567), (b"{abcde}", 16097), (b"same", 13447), (b"abcdefghi{same}abcdefghi", 13447),
    (b"123456789{same}123456789", 13447), ("1234我是你89{same}12我就456789".encode(), 13447), ("你你你{你你你}你你你".encode(), 15023), (bytes(range(256)), 16155),
    (b"", 0), (b"a{}b", None), (b"{}", None), (b"a{b", None), (b"}a{b}", None), (b"{{x}}", None),
]


def test_slots(spark):
    assert hashing.crc16(b"123456789") == 0x31C3
    df = spark.createDataFrame([(k,) for k, _ in SLOTS], "k binary")
    for r in df.select("k", hashing.slot(F.col("k")).alias("s")).collect():
        assert r.s == hashing.slot_of(bytes(r.k))
    for k, want in SLOTS:
        assert want is None or hashing.slot_of(k) == want


def test_wire(spark):
    argv = [b"SET", b"k\r\n\xff", b""]
    df = raw(spark, argv, ["A" * 120])
    rows = df.select(resp.encoded(F.col("argv")).alias("w"), resp.encoded_size(F.col("argv")).alias("n"), resp.display(F.col("argv")).alias("d")).collect()
    assert bytes(rows[0].w) == resp.encode(argv) and rows[0].n == len(rows[0].w)
    assert rows[1].d == "A" * 100 + "..."
    reader = resp.Reader(_feed(b"*2\r\n$1\r\na\r\n:5\r\n%1\r\n+k\r\n,1.5\r\n_\r\n#t\r\n|1\r\n+a\r\n+b\r\n=5\r\ntxt:z\r\n(123\r\n-ERR no\r\n"))
    assert [reader.reply() for _ in range(6)] == [[b"a", 5], {"k": 1.5}, None, True, b"z", 123]
    with pytest.raises(resp.ReplyError):
        reader.reply()
    with pytest.raises(resp.Incomplete):
        reader.reply()


def _feed(data):
    parts = iter([data[i : i + 3] for i in range(0, len(data), 3)])
    return lambda n: next(parts, b"")


def keep(key, c):
    p = any(key.startswith(x.encode()) for x in c.allow_key_prefix) or any(key.endswith(x.encode()) for x in c.allow_key_suffix)
    b = any(key.startswith(x.encode()) for x in c.block_key_prefix) or any(key.endswith(x.encode()) for x in c.block_key_suffix)
    return (p or not (c.allow_key_prefix or c.allow_key_suffix)) and not b


def test_filters_against_plain_python(spark):
    rng = random.Random(1)
    commands = [(rng.randrange(4), f"{rng.choice(['SET', 'DEL', 'PING', 'ODD', 'HSET'])} " + " ".join(rng.choice("ab") + rng.choice("xy") for _ in range(rng.randrange(1, 4)))) for _ in range(200)]
    entries = parse(raw(spark, *commands), False).cache()
    rows = entries.collect()
    for _ in range(12):
        pick = lambda pool: tuple(x for x in pool if rng.random() < 0.3)
        c = FilterConfig(pick("ab"), pick("xy"), pick(["ax"]), pick(["by"]), pick([0, 1, 2]), pick([1]), pick(["SET", "DEL", "ODD"]), pick(["DEL"]), pick(["STRING", "GENERIC", "unknown"]), pick(["HASH"]))
        want = [
            r.seq
            for r in rows
            if all(keep(bytes(k), c) for k in r["keys"])
            and (not c.allow_db or r.db_id in c.allow_db) and r.db_id not in c.block_db
            and (not c.allow_command or r.cmd_name in c.allow_command) and r.cmd_name not in c.block_command
            and (not c.allow_command_group or r.group in c.allow_command_group) and r.group not in c.block_command_group
        ]
        assert sorted(r.seq for r in filters.apply_filters(entries, c).collect()) == want
    entries.unpersist()


def test_noise(spark):
    df = raw(spark, "select 1", "ping", "replconf ack 1", "multi", "exec", ["PUBLISH", "__sentinel__:hello", "x"], "publish other x", "set a b")
    assert [r.seq for r in filters.drop_noise(df).orderBy("seq").collect()] == [6, 7]


def test_transforms(spark):
    df = parse(raw(spark, "MSET a 1 b 2", (1, "SET a:x v"), (2, "SET b v")))
    native, function = transform.split_mset(df), transform.apply_function(df, transform.mset_function)
    cols = ["seq", "ordinal", "db_id", "cmd_name", "argv", "keys", "slots"]
    assert native.select(cols).orderBy("seq", "ordinal").collect() == function.select(cols).orderBy("seq", "ordinal").collect()
    assert native.count() == 4
    renamed = transform.rename_prefix(df, b"a:", b"zz:").where("seq = 1").first()
    assert [bytes(a) for a in renamed.argv] == [b"SET", b"zz:x", b"v"] and bytes(renamed["keys"][0]) == b"zz:x"
    assert sorted(r.db_id for r in transform.swap_db(df, 1, 2).collect()) == [0, 1, 2]
    assert transform.apply_function(df, lambda call: []).count() == 0

    def broken(call):
        raise RuntimeError("no")

    with pytest.raises(PySparkException):
        transform.apply_function(df, broken).collect()


LISTING = """a1 10.0.0.1:7000@17000,host myself,master - 0 0 1 connected 0-5460 5462 [5461->-b2]
b2 ::1:7001@17001 master - 0 0 2 connected 5461 5463-16383
c3 10.0.0.3:7002@17002 slave a1 0 0 1 connected
d4 10.0.0.4:7003@17003 slave,fail b2 0 0 1 disconnected
e5 :0@0 master,noaddr - 0 0 1 disconnected"""


def test_routing(spark):
    nodes = routing.parse_nodes(LISTING)
    assert [n.address for n in nodes] == ["10.0.0.1:7000", "[::1]:7001", "10.0.0.3:7002", "10.0.0.4:7003"]
    assert nodes[0].slots == ((0, 5460), (5462, 5462)) and not nodes[3].healthy
    routes = routing.node_routes(spark, nodes)
    assert routing.coverage_faults(routes).count() == 0
    assert routing.coverage_faults(routes.where("high > low")).count() == 2
    with pytest.raises(ValueError):
        routing.check_coverage(nodes[:1])
    entries = parse(raw(spark, "SET abcde v", "PING", "DEL {t}a {t}b"))
    got = {(r.seq, r.node) for r in routing.route(entries, routes).collect()}
    assert got == {(0, "[::1]:7001"), (1, "10.0.0.1:7000"), (1, "[::1]:7001"), (2, next(n for s, n in got if s == 2))}
    crossing = parse(raw(spark, "DEL a b"))
    assert routing.cross_slot(crossing).count() == 1
    assert routing.route(crossing, routes, "drop").count() == 0
    with pytest.raises(PySparkException):
        routing.route(crossing, routes).collect()
    info = "role:master\r\nslave0:ip=1.1.1.1,port=1,state=online,offset=9,lag=0\r\nslave1:ip=1.1.1.2,port=2,state=online,offset=10,lag=0\r\nslave2:ip=1.1.1.3,port=3,state=wait_bgsave,offset=99,lag=0\r\n"
    assert routing.best_replica(info) == "1.1.1.2:2" and routing.best_replica("role:slave") is None


def model(commands):
    """The keyspace by plain replay."""
    space = {}
    for db, c in commands:
        w = c.split()
        name, key = w[0], (db, w[1]) if len(w) > 1 else None
        kind = {"H": "hash", "Z": "zset", "S": "set", "R": "list", "L": "list"}.get(name[0])
        if name == "SET":
            space[key] = ("string", w[2])
        elif name == "MSET":
            for k, v in zip(w[1::2], w[2::2], strict=True):
                space[db, k] = ("string", v)
        elif name == "DEL":
            for k in w[1:]:
                space.pop((db, k), None)
        elif name == "FLUSHDB":
            space = {k: v for k, v in space.items() if k[0] != db}
        elif space.get(key, (kind,))[0] == kind and name in ("HSET", "HDEL", "ZADD", "ZREM", "SADD", "SREM", "RPUSH", "LPUSH"):
            new = {"hash": {}, "zset": {}, "set": set(), "list": []}[kind]
            v = space[key][1] if key in space else new
            if name == "HSET":
                v |= dict(zip(w[2::2], w[3::2], strict=True))
            elif name == "ZADD":
                v |= {m: float(s) for s, m in zip(w[2::2], w[3::2], strict=True)}
            elif name in ("HDEL", "ZREM"):
                for f in w[2:]:
                    v.pop(f, None)
            elif name == "SADD":
                v |= set(w[2:])
            elif name == "SREM":
                v -= set(w[2:])
            elif name == "RPUSH":
                v += w[2:]
            else:
                v[:0] = w[2:][::-1]
            if v:
                space[key] = (kind, v)
            else:
                space.pop(key, None)
    return space


def shown(rows):
    s = lambda b: bytes(b).decode()
    out = {}
    for r in rows:
        v = {
            "string": lambda r: s(r.string_val), "list": lambda r: [s(x) for x in r.list_val], "set": lambda r: {s(x) for x in r.set_val},
            "hash": lambda r: {s(k): s(v) for k, v in r.hash_val.items()}, "zset": lambda r: {s(k): v for k, v in r.zset_val.items()},
        }[r.type](r)
        out[r.db_id, s(r.key)] = (r.type, v)
    return out


def commands_of(rng, n):
    out = []
    for _ in range(n):
        db, k = rng.randrange(2), rng.choice("abc")
        f = lambda: rng.choice("xyz")
        kind = {"a": "hash", "b": "list", "c": "string"}[k] if rng.random() < 0.9 else "zset"
        c = {
            "hash": lambda: f"HSET h{k} {f()} {rng.randrange(9)}", "zset": lambda: f"ZADD z{k} {rng.randrange(9)} {f()}",
            "list": lambda: f"{rng.choice(['RPUSH', 'LPUSH'])} l{k} {f()} {rng.randrange(9)}", "string": lambda: rng.choice([f"SET s{k} {f()}", f"MSET s{k} 1 t{k} 2", f"SADD m{k} {f()} {f()}"]),
        }[kind]()
        if rng.random() < 0.15:
            c = rng.choice([f"DEL h{k} l{k} s{k}", f"DEL m{k}"] + (["FLUSHDB"] if rng.random() < 0.2 else []))
        out.append((db, c))
    return out


def test_replay_against_plain_replay(spark, tmp_path):
    rng = random.Random(5)
    for n in (30, 120):
        commands = commands_of(rng, n)
        entries = parse(raw(spark, *commands), False)
        assert shown(replay.keyspace(entries).collect()) == model(commands)
    table = files.KeyspaceTable(spark, str(tmp_path / "space"))
    for i in range(0, 120, 40):
        table.upsert(entries.where((F.col("seq") >= i) & (F.col("seq") < i + 40)), i)
        table.upsert(entries.limit(0), i)
    assert shown(table.read().collect()) == model(commands)


def test_replay_details(spark):
    df = parse(raw(spark, "HSET h a 1 b 2", "HDEL h a b", "SADD s 1", "SREM s 1", "ZADD z 1 a", "ZREM z a", "SET k v", "PEXPIRE k 500", "SET j v", "EXPIREAT j 9", "PERSIST j", "SET i v", "PEXPIREAT i 77", "SET i w", "INCR n"), False)
    got = {bytes(r.key): r.expire_at_ms for r in replay.keyspace(df, now_ms=1000).collect()}
    assert got == {b"k": 1500, b"j": None, b"i": None}
    assert [tuple(r) for r in replay.unsupported(df).collect()] == [("INCR", 1)]
    space = replay.keyspace(df).select("db_id", "key", "string_val")
    with pytest.raises(PySparkException):
        replay.restore_into(space, space, "panic").collect()
    assert replay.restore_into(space, space, "skip").count() == 3
    with pytest.raises(ValueError):
        replay.restore_into(space, space, "maybe")


def test_values(spark):
    df = spark.createDataFrame([(0, b"k", b"x" * 5, -1), (0, b"l", b"x" * 50, 7), (0, b"m", None, 5), (0, b"n", b"x", -2)], "db_id int, key binary, dump binary, pttl long")
    live = values.normalise_ttl(df)
    assert sorted(r.pttl for r in live.collect()) == [0, 7]
    small, large = values.restore_commands(live, 10, replace=True)
    assert [bytes(a) for a in small.first().argv] == [b"RESTORE", b"k", b"0", b"xxxxx", b"replace"] and large.count() == 1
    assert values.restore_commands(live, 0)[1].count() == 2
    scores = spark.createDataFrame([(b"z", {b"m": 1e-10, b"n": 3.0})], "key binary, zset_val map<binary,double>")
    assert {bytes(r.argv[2]) for r in values.zset_commands(scores).collect()} == {b"1.0E-10", b"3"}
    at = spark.createDataFrame([(b"k", 5000), (b"l", 10), (b"m", None)], "key binary, expire_at_ms long")
    assert sorted(bytes(r.argv[2]) for r in values.expiry_command(at, 1000).collect()) == [b"1", b"4000"]


def test_order(spark):
    df = raw(spark, "set a 1", "select 3", "set b 1", "SELECT 0", "set c 1")
    for stretch in (1, 2, 3, 100):
        assert [(r.seq, r.db_id) for r in ordering.absorb_select(df, 7, stretch).orderBy("seq").collect()] == [(0, 7), (2, 3), (4, 0)]
    odd = raw(spark, "select x", "set a 1", "select 4", *["set b 1"] * 5, "select 2 3", "set c 1")
    assert [r.db_id for r in ordering.absorb_select(odd, 1, 2).orderBy("seq").collect()] == [1, 4, 4, 4, 4, 4, 4, 4]
    rows = spark.createDataFrame([("s", 0, None), ("s", 1, 10), ("s", 2, None), ("s", 3, 12), ("s", 4, 9), ("t", 0, 5)], "source_id string, seq long, ts long")
    assert sorted((r.source_id, r.seq) for r in ordering.cut_after(rows, 11).collect()) == [("s", 0), ("s", 1), ("s", 2), ("t", 0)]
    assert ordering.cut_after(rows, 0).count() == 6
    parts = spark.createDataFrame([("s", 0, 1), ("s", 1, 3), ("s", 2, 3)], "source_id string, ordinal int, file_seq int")
    assert ordering.order_faults(parts).count() == 1


def test_empty(spark):
    empty = raw(spark, "set a b").limit(0)
    assert parse(empty).count() == 0 and replay.keyspace(parse(empty)).count() == 0
    assert ordering.absorb_select(empty).count() == 0
