"""Keyspace scans and change notifications of live servers.

format("kvscan") reads every key of every database once: (node, database) is a partition.  format("kvnotify") streams
keys as they change.  Both give source_id, seq, db_id, key, dump, pttl; a null dump is a removed key.
"""

from __future__ import annotations

import logging
import re
import select
import time
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import batched, groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from kvflow.operators import values
from kvflow.sources.client import Address, Connection, shard_addresses
from kvflow.sources.notes import Notes
from kvflow.sources.rdb import decode_large

SCHEMA = "source_id string, seq long, db_id int, key binary, dump binary, pttl long"
PIPELINE = 1024
LOG = logging.getLogger("kvflow.scan")
#: Least time between two lines of a scan's progress.
LOG_SECONDS = 5.0
_EVENT = re.compile(rb"__keyevent@(\d+)__:(\w+)")
#: Events that leave no key.
REMOVALS = (b"del", b"expired", b"evicted")


def address_of(options: dict, address: str | None = None) -> Address:
    return Address(address or options["address"], options.get("username", ""), options.get("password", ""), options.get("tls", "false").lower() == "true", timeout=float(options.get("timeout", 10)))


def flag(options: dict, name: str, default: bool = False) -> bool:
    return options.get(name, str(default)).lower() == "true"


@dataclass
class Range(InputPartition):
    address: str
    db: int


def fetch(c: Connection, keys: list[bytes]) -> list[tuple[bytes, bytes | None, int]]:
    """(key, dump, pttl) in order, by one pipelined exchange."""
    for key in keys:
        c.send("dump", key)
        c.send("pttl", key)
    return [(key, c.receive(), c.receive()) for key in keys]


class _ScanReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options
        self.count = int(options.get("count", 1))

    def partitions(self) -> list[InputPartition]:
        o = self.options
        cluster = flag(o, "cluster")
        named = [int(x) for x in o.get("dbs", "").split(",") if x]
        out: list[InputPartition] = []
        for address in shard_addresses(address_of(o), cluster, flag(o, "prefer_replica")):
            if named:
                dbs = named
            elif cluster:
                dbs = [0]
            else:
                with Connection(address_of(o, address)) as c:
                    dbs = c.databases()
            out += [Range(address, db) for db in dbs]
        return out or [Range("", -1)]

    def read(self, partition: Range) -> Iterator[tuple]:
        if partition.db < 0:
            return
        with Connection(address_of(self.options, partition.address)) as c:
            if partition.db:
                c.do("select", partition.db)
            source, seq = f"{partition.address}/{partition.db}", 0
            told = time.monotonic()

            def progress(percent: float) -> None:
                nonlocal told
                if time.monotonic() - told >= LOG_SECONDS:
                    told = time.monotonic()
                    LOG.info("%s: %.2f%% scanned", source, percent)

            for some in batched(c.keys(self.count, progress), PIPELINE):
                for key, dump, pttl in fetch(c, list(dict.fromkeys(some))):
                    yield source, seq, partition.db, key, dump, pttl
                    seq += 1


class ScanDataSource(DataSource):
    """Options: address, username, password, tls, cluster, prefer_replica, dbs, count, timeout."""

    @classmethod
    def name(cls) -> str:
        return "kvscan"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _ScanReader:
        return _ScanReader(dict(self.options))


@dataclass
class Changes(InputPartition):
    """rows: (seq, db, key, removed)."""

    rows: list[tuple[int, int, bytes, bool]]


class _NotifyReader(DataSourceStreamReader):
    """The driver listens and notes which keys changed; executors fetch their values.

    Events are noted in the state folder before an offset past them is returned, so a batch that is run again has them.
    Without the folder they are held in memory, and a batch planned before a restart fails.  Events while no query runs
    are lost, as the server keeps none.  max_rows bounds a batch, wait_seconds how long it waits.
    """

    def __init__(self, options: dict) -> None:
        self.options = options
        self.dbs = {int(x) for x in options.get("dbs", "").split(",") if x}
        self.max_rows = int(options.get("max_rows", 10_000))
        self.task_rows = int(options.get("task_rows", 1000))
        self.wait = float(options.get("wait_seconds", 0.5))
        self.listening: Connection | None = None
        self.notes: Notes | None = None
        self.kept: dict[str, list] = {}
        self.seq: int | None = None

    def _names(self) -> list[str]:
        """start-end of each noted run of events, in order."""
        if self.options.get("state") and self.notes is None:
            self.notes = Notes(self.options["state"])
        return self.notes.names() if self.notes else sorted(self.kept)

    def _last(self) -> int:
        return int(names[-1].split("-")[1]) if (names := self._names()) else 0

    def initialOffset(self) -> dict:
        """Before all noted events: Spark may ask for it after the first of them are noted."""
        return {"seq": int(names[0].split("-")[0]) if (names := self._names()) else 0}

    def _events(self) -> dict[tuple[int, bytes], bool]:
        """(db, key) -> removed, the last event of each key."""
        if self.listening is None:
            self.listening = Connection(address_of(self.options))
            self.listening.do("psubscribe", "__keyevent@*__:*")
        out: dict[tuple[int, bytes], bool] = {}
        until = time.monotonic() + self.wait
        r = self.listening.reader
        while len(out) < self.max_rows:
            waiting = len(r.buffer) > r.at
            if not waiting and not select.select([self.listening.socket], [], [], max(0.0, until - time.monotonic()))[0]:
                return out
            got = self.listening.receive()
            if not isinstance(got, list) or got[0] != b"pmessage" or not (m := _EVENT.fullmatch(got[2])):
                continue
            db = int(m[1])
            if not self.dbs or db in self.dbs:
                out.pop((db, got[3]), None)
                out[db, got[3]] = m[2] in REMOVALS
        return out

    def latestOffset(self) -> dict:
        if self.seq is None:
            self.seq = self._last()
        if events := self._events():
            rows = [[self.seq + i, db, key.hex(), removed] for i, ((db, key), removed) in enumerate(events.items())]
            name = f"{self.seq:020d}-{self.seq + len(rows):020d}"
            if self.notes:
                self.notes.put(name, rows)
            else:
                self.kept[name] = rows
            self.seq += len(rows)
        return {"seq": self.seq}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        rows = []
        for name in self._names():
            low, high = map(int, name.split("-"))
            if low < end["seq"] and high > start["seq"]:
                noted = self.notes.get(name) if self.notes else self.kept[name]
                rows += [(seq, db, bytes.fromhex(key), removed) for seq, db, key, removed in noted if start["seq"] <= seq < end["seq"]]
        if len(rows) != end["seq"] - start["seq"]:
            raise ValueError(f"events {start['seq']} to {end['seq']} were planned but are no longer known; give the stream a state folder")
        return [Changes(list(some)) for some in batched(rows, self.task_rows)]

    def read(self, partition: Changes) -> Iterator[tuple]:
        with Connection(address_of(self.options)) as c:
            for db, rows in groupby(partition.rows, key=lambda r: r[1]):
                if db:
                    c.do("select", db)
                for some in batched(rows, PIPELINE):
                    got = iter(fetch(c, [r[2] for r in some if not r[3]]))
                    for seq, _, key, removed in some:
                        _, dump, pttl = (key, None, -2) if removed else next(got)
                        yield self.options["address"], seq, db, key, dump, pttl
                if db:
                    c.do("select", 0)

    def commit(self, end: dict) -> None:
        """Processed events go; the last run stays, for the number that follows it."""
        for name in self._names()[:-1]:
            if int(name.split("-")[1]) <= end["seq"]:
                if self.notes:
                    self.notes.drop(name)
                else:
                    self.kept.pop(name)

    def stop(self) -> None:
        if self.listening is not None:
            self.listening.close()
            self.listening = None


class NotifyDataSource(DataSource):
    """Options: as for kvscan, with state (a shared folder of this stream's own), max_rows, task_rows and wait_seconds."""

    @classmethod
    def name(cls) -> str:
        return "kvnotify"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> _NotifyReader:
        return _NotifyReader(dict(self.options))


def as_commands(scanned: DataFrame, most: int, replace: bool = False, bloom_version: int = 0) -> DataFrame:
    """Scanned keys as commands: RESTORE for values of at most ``most`` bytes, the commands that make them for larger ones.

    Keys that are gone are dropped, except removals of a notification stream, which become DEL.
    """
    removed = scanned.where("dump is null and pttl = -2").withColumn("argv", F.array(F.lit(b"DEL"), "key"))
    small, large = values.restore_commands(values.normalise_ttl(scanned), most, replace)
    plain = ["source_id", "seq", F.lit(0).alias("ordinal"), "db_id", "argv"]
    return small.select(*plain).unionByName(removed.select(*plain)).unionByName(decode_large(large, bloom_version))
