"""Server sinks: commands sent to a single node, to a sentinel's master, or to the nodes of a cluster."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kvflow.functions.resp import ReplyError, encode
from kvflow.operators.routing import node_routes, route
from kvflow.sources.client import Address, Connection

PANIC, REWRITE, SKIP = "panic", "rewrite", "skip"


@dataclass(frozen=True)
class Target:
    """mode: standalone, sentinel or cluster.  on_exists: what to do where a restored key exists (panic, rewrite, skip).

    pipeline: commands in flight.  buffer: bytes in flight.  off_reply: no replies are asked for, so no error is seen.
    """

    at: Address
    mode: str = "standalone"
    master: str = ""
    on_exists: str = PANIC
    pipeline: int = 1024
    buffer: int = 1_024_000_000
    off_reply: bool = False
    empty_first: bool = False
    skip_errors: tuple[str, ...] = field(default=())

    def __post_init__(self) -> None:
        if self.mode not in ("standalone", "sentinel", "cluster"):
            raise ValueError("mode is standalone, sentinel or cluster")
        if self.on_exists not in (PANIC, REWRITE, SKIP):
            raise ValueError("on_exists is panic, rewrite or skip")
        if self.off_reply and self.on_exists == PANIC:
            raise ValueError("with off_reply no clash is seen, so on_exists can't be panic")

    @property
    def replaces(self) -> bool:
        """RESTORE commands for this target carry ``replace``."""
        return self.on_exists == REWRITE


class Sender:
    """Pipelined sending on one connection."""

    def __init__(self, target: Target) -> None:
        self.target, self.db, self.open, self.bytes, self.sent, self.skipped = target, 0, [], 0, 0, 0
        self.connection = Connection(target.at)
        if target.off_reply:
            self.connection.send("client", "reply", "off")

    def send(self, db: int, argv: list[bytes]) -> None:
        if db != self.db:
            self._push([b"select", b"%d" % db], counted=False)
            self.db = db
        self._push(argv, counted=True)

    def _push(self, argv: list[bytes], counted: bool) -> None:
        data = encode(argv)
        self.connection.send_raw(data)
        self.sent += counted
        if self.target.off_reply:
            return
        self.open.append((argv, len(data)))
        self.bytes += len(data)
        while len(self.open) > self.target.pipeline or self.bytes > self.target.buffer:
            self._answer()

    def _answer(self) -> None:
        argv, size = self.open.pop(0)
        self.bytes -= size
        try:
            self.connection.receive()
        except ReplyError as e:
            if str(e).startswith("BUSYKEY") and self.target.on_exists == SKIP:
                self.skipped += 1
            elif not any(str(e).startswith(s) for s in self.target.skip_errors):
                raise ReplyError(f"{e} in answer to {argv[0]!r} {argv[1:2]!r}") from None

    def close(self) -> None:
        while self.open:
            self._answer()
        if self.target.off_reply:  # a reply after all, so nothing is still on its way
            self.connection.send("client", "reply", "on")
            self.connection.receive()
        self.connection.close()


def resolve(target: Target) -> Target:
    """A standalone target in place of a sentinel's."""
    if target.mode != "sentinel":
        return target
    with Connection(target.at) as c:
        return replace(target, at=replace(target.at, address=c.sentinel_master(target.master)), mode="standalone")


def flush(target: Target) -> None:
    """Remove every key of the target."""
    target = resolve(target)
    with Connection(target.at) as c:
        addresses = [n.address for n in c.nodes() if n.is_master] if target.mode == "cluster" else [target.at.address]
    for a in addresses:
        with Connection(replace(target.at, address=a)) as c:
            c.do("flushall")


def write(entries: DataFrame, target: Target) -> list[tuple[str, str, int, int]]:
    """Send entries, in order inside each (source, node); returns (source_id, node, sent, skipped), a row for each.

    A task that is run again sends its commands again: commands that aren't idempotent (RPUSH) need a fresh target or
    on_exists ``rewrite`` with RESTORE.
    """
    target = resolve(target)
    if target.empty_first:
        flush(target)
    if target.mode == "cluster":
        with Connection(target.at) as c:
            nodes = c.nodes()
        routed = route(entries, node_routes(entries.sparkSession, nodes))
    else:
        routed = entries.withColumn("node", F.lit(target.at.address))
    order = ["source_id", "seq", "ordinal"] if "ordinal" in routed.columns else ["source_id", "seq"]
    dealt = routed.repartition("source_id", "node").sortWithinPartitions("node", *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        senders: dict[str, Sender] = {}
        counts: dict[tuple[str, str], list[int]] = {}
        for b in batches:
            for r in b.to_pylist():
                node = r["node"]
                if node not in senders:
                    senders[node] = Sender(replace(target, at=replace(target.at, address=node)))
                s = senders[node]
                before = s.sent, s.skipped
                s.send(0 if target.mode == "cluster" else r["db_id"], r["argv"])
                c = counts.setdefault((r["source_id"], node), [0, 0])
                c[0] += s.sent - before[0]
        for node, s in senders.items():
            s.close()
            for key in [k for k in counts if k[1] == node][:1]:
                counts[key][1] += s.skipped
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()), pa.array([v[0] for v in counts.values()], pa.int64()), pa.array([v[1] for v in counts.values()], pa.int64())],
            ["source_id", "node", "sent", "skipped"],
        )

    sent = dealt.select("source_id", "node", "db_id", "argv").mapInArrow(run, "source_id string, node string, sent long, skipped long")
    return [tuple(r) for r in sent.collect()]
