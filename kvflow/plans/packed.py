"""Dumped values of every packed encoding, made of the events table: inputs of the registered decoder queries."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvflow.sources import rdb, rdbvalues

#: (event id, event type) of a user, in order.
Events = list[tuple[int, str]]


def length(n: int) -> bytes:
    if n < 64:
        return bytes([n])
    return bytes([0x40 | n >> 8, n & 255]) if n < 1 << 14 else b"\x80" + struct.pack(">I", n)


def string(s: bytes) -> bytes:
    return length(len(s)) + s


def listpack(items: list[int | bytes]) -> bytes:
    """Integers in the narrowest form that holds them, texts by their length."""
    body = b""
    for x in items:
        if isinstance(x, bytes):
            part = bytes([0x80 | len(x)]) + x if len(x) < 64 else bytes([0xE0 | len(x) >> 8, len(x) & 255]) + x
        elif 0 <= x < 128:
            part = bytes([x])
        elif -4096 <= x < 4096:
            part = bytes([0xC0 | (x & 0x1FFF) >> 8, x & 255])
        else:
            width, mark = next((w, m) for w, m in ((2, 0xF1), (3, 0xF2), (4, 0xF3), (8, 0xF4)) if -(1 << 8 * w - 1) <= x < 1 << 8 * w - 1)
            part = bytes([mark]) + x.to_bytes(width, "little", signed=True)
        body += part + bytes(1 if len(part) < 128 else 2)
    return struct.pack("<IH", len(body) + 7, min(len(items), 65535)) + body + b"\xff"


def ziplist(items: list[int | bytes]) -> bytes:
    body, before = b"", 0
    for x in items:
        if isinstance(x, bytes):
            part = bytes([len(x)]) + x if len(x) < 64 else bytes([0x40 | len(x) >> 8, len(x) & 255]) + x
        elif 0 <= x <= 12:
            part = bytes([0xF1 + x])
        else:
            width, mark = next((w, m) for w, m in ((1, 0xFE), (2, 0xC0), (3, 0xF0), (4, 0xD0), (8, 0xE0)) if -(1 << 8 * w - 1) <= x < 1 << 8 * w - 1)
            part = bytes([mark]) + x.to_bytes(width, "little", signed=True)
        whole = (bytes([before]) if before < 254 else b"\xfe" + struct.pack("<I", before)) + part
        body, before = body + whole, len(whole)
    return struct.pack("<IIH", len(body) + 11, 10, min(len(items), 65535)) + body + b"\xff"


def of_listpack(events: Events) -> tuple[int, bytes]:
    """A list of nodes of at most 10 elements; a lone last one stands plain."""
    items = [x for i, t in events for x in (t.encode(), i, -i, i * 1_000_003)]
    nodes = [items[a : a + 10] for a in range(0, len(items), 10)]
    body = b"".join(length(2) + string(listpack(n)) for n in nodes)
    return rdbvalues.LIST_QUICKLIST_2, length(len(nodes) + 1) + body + length(1) + string(b"end")


def of_ziplist(events: Events) -> tuple[int, bytes]:
    return rdbvalues.HASH_ZIPLIST, string(ziplist([x for i, t in events for x in (b"f%d" % i, t.encode() * 20 if i % 5 == 0 else (i % 20 - 5) * 10 ** (i % 12))]))


def of_intset(events: Events) -> tuple[int, bytes]:
    numbers = sorted({i if events[0][0] % 3 else i * 100_000 if events[0][0] % 2 else i * 10**12 for i, _ in events})
    width = next(w for w in (2, 4, 8) if numbers[-1] < 1 << 8 * w - 1)
    return rdbvalues.SET_INTSET, string(struct.pack("<II", width, len(numbers)) + b"".join(n.to_bytes(width, "little") for n in numbers))


def of_lzf(events: Events) -> tuple[int, bytes]:
    """The first type, compressed: its letters once, then a reference that overlaps itself."""
    word = events[0][1].encode()
    copies = 3 + len(events) % 20
    n = len(word) * copies - 2
    packed = bytes([len(word) - 1]) + word + (bytes([7 << 5, n - 7, len(word) - 1]) if n >= 7 else bytes([n << 5, len(word) - 1]))
    return rdbvalues.STRING, b"\xc3" + length(len(packed)) + length(len(word) * (copies + 1)) + packed


def of_zset(events: Events) -> tuple[int, bytes]:
    body = b"".join(string(b"m%d" % i) + struct.pack("<d", i / 4) for i, _ in events)
    return rdbvalues.ZSET_2, length(len(events)) + body


def of_stream(events: Events) -> tuple[int, bytes]:
    """One block: entries with the block's own field, every fifth deleted; a group whose one consumer waits for the last."""
    base = events[0][0]
    items: list[int | bytes] = [len([i for i, _ in events if i % 5]), len([i for i, _ in events if not i % 5]), 1, b"type", 0]
    for i, t in events:
        items += [2 | (i % 5 == 0), i - base, 0, t.encode(), 4] if i % 2 else [i % 5 == 0, i - base, 0, 1, b"other", t.encode(), 6]
    items = [int(x) if isinstance(x, bool) else x for x in items]
    last = events[-1][0]
    raw = struct.pack(">QQ", last, 0)
    body = length(1) + string(struct.pack(">QQ", base, 0)) + string(listpack(items))
    body += length(items[0]) + length(last) + length(0) + length(base) + length(0) + length(0) + length(0) + length(len(events))
    body += length(1) + string(b"g") + length(last) + length(0) + length(len(events)) + length(1) + raw + struct.pack("<Q", 5000) + length(3)
    body += length(1) + string(b"c") + struct.pack("<QQ", 1, 2) + length(1) + raw
    return rdbvalues.STREAM_3, body


def _module(name: str, version: int) -> bytes:
    n = 0
    for ch in name:
        n = n << 6 | rdbvalues.MODULE_CHARS.index(ch)
    return b"\x81" + struct.pack(">Q", n << 10 | version)


def of_bloom(events: Events) -> tuple[int, bytes]:
    """One link of as many bytes as there are events."""
    unsigned, double = (lambda n: length(2) + length(n)), (lambda x: length(4) + struct.pack("<d", x))
    n = len(events)
    link = unsigned(n) + double(0.01) + unsigned(7) + double(9.5) + unsigned(8 * n) + unsigned(3) + length(5) + string(bytes(n)) + unsigned(n)
    return rdbvalues.MODULE_2, _module(rdbvalues.MODULE_BLOOM, 4) + unsigned(n) + unsigned(1) + unsigned(0) + unsigned(2) + link + length(0)


def of_module_string(events: Events) -> tuple[int, bytes]:
    unsigned = lambda n: length(2) + length(n)
    i, t = events[-1]
    return rdbvalues.MODULE_2, _module(rdbvalues.MODULE_STRING, 0) + unsigned(i) + unsigned(i % 7) + length(5) + string(t.encode()) + length(0)


def dumps(spark: SparkSession, sf_dir: str, make: Callable[[Events], tuple[int, bytes]]) -> DataFrame:
    """source_id, seq, db_id, key, pttl, dump: one value for each user, of the user's events."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [rdb.dump_value(*make([(e["event_id"], e["event_type"]) for e in events])) for events in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.binary())], ["user_id", "dump"])

    events = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))).alias("events"))
    values = events.mapInArrow(run, "user_id long, dump binary")
    key = F.concat(F.lit("u:"), F.col("user_id").cast("string")).cast("binary")
    return values.select(F.lit("events").alias("source_id"), F.col("user_id").alias("seq"), F.lit(0).alias("db_id"), key.alias("key"), F.lit(0).cast("long").alias("pttl"), "dump")
