"""Routing of entries to the nodes of a cluster by key slot."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kvflow.model import SLOTS


@dataclass(frozen=True)
class Node:
    node_id: str
    address: str
    is_master: bool
    master_id: str
    slots: tuple[tuple[int, int], ...]
    healthy: bool = True


def parse_nodes(text: str) -> list[Node]:
    """The nodes in a cluster's own listing: one line each, ``id address flags master ... state slots``.

    Addresses lose the bus port and host name; a part in brackets (a slot on the move) is no range.  Only nodes in
    good standing and with an address are kept.
    """
    out = []
    for line in text.strip().splitlines():
        part = line.split()
        if len(part) < 8:
            raise ValueError(f"a node line has {len(part)} fields: {line!r}")
        flags = part[2].split(",")
        address = part[1].split(",")[0].split("@")[0]
        host, _, port = address.rpartition(":")
        if not host or "handshake" in flags or "noaddr" in flags:
            continue
        if ":" in host and not host.startswith("["):
            host = f"[{host}]"
        ranges = []
        for p in part[8:]:
            if p.startswith("["):
                continue
            low, _, high = p.partition("-")
            ranges.append((int(low), int(high or low)))
        healthy = not ({"fail", "fail?"} & set(flags)) and part[7] == "connected"
        out.append(Node(part[0], f"{host}:{port}", "master" in flags, part[3], tuple(ranges), healthy))
    return out


def check_coverage(nodes: list[Node]) -> None:
    """Every slot is owned once."""
    owned = [s for n in nodes if n.is_master for low, high in n.slots for s in range(low, high + 1)]
    if sorted(owned) != list(range(SLOTS)):
        raise ValueError(f"slots are owned {len(owned)} times, {len(set(owned))} of {SLOTS} at least once")


def best_replica(info: str) -> str | None:
    """host:port of the online replica with the greatest offset in an INFO replication reply."""
    best: tuple[int, str] | None = None
    for m in re.finditer(r"^slave\d+:ip=([^,]+),port=(\d+),state=(\w+),offset=(\d+)", info, re.M):
        if m[3] == "online" and (best is None or int(m[4]) > best[0]):
            best = int(m[4]), f"{m[1]}:{m[2]}"
    return best[1] if best else None


def even_routes(spark: SparkSession, nodes: list[str]) -> DataFrame:
    """low, high, node: equal ranges of slots."""
    n = len(nodes)
    return spark.createDataFrame([(SLOTS * i // n, SLOTS * (i + 1) // n - 1, a) for i, a in enumerate(nodes)], "low int, high int, node string")


def node_routes(spark: SparkSession, nodes: list[Node]) -> DataFrame:
    check_coverage(nodes)
    return spark.createDataFrame([(low, high, n.address) for n in nodes if n.is_master for low, high in n.slots], "low int, high int, node string")


def slot_table(routes: DataFrame) -> DataFrame:
    """slot, node: SLOTS rows, so an equi-join routes and the table can be broadcast."""
    return routes.select(F.explode(F.sequence("low", "high")).alias("slot"), "node")


def coverage_faults(routes: DataFrame) -> DataFrame:
    """slot, owners of every slot that isn't owned once."""
    owned = slot_table(routes).groupBy("slot").agg(F.count("*").alias("owners"))
    every = routes.sparkSession.range(SLOTS).select(F.col("id").cast("int").alias("slot"))
    return every.join(F.broadcast(owned), "slot", "left").select("slot", F.coalesce("owners", F.lit(0)).alias("owners")).where("owners <> 1")


def cross_slot(entries: DataFrame) -> DataFrame:
    """Entries whose keys lie in more than one slot."""
    return entries.where(F.size(F.array_distinct("slots")) > 1)


def route(entries: DataFrame, routes: DataFrame, on_cross_slot: str = "error") -> DataFrame:
    """Entries with the node they go to; one without keys goes to every node.

    on_cross_slot: ``error`` fails the query, ``drop`` leaves such entries out.
    """
    if on_cross_slot not in ("error", "drop"):
        raise ValueError("on_cross_slot is error or drop")
    several = F.size(F.array_distinct("slots")) > 1
    if on_cross_slot == "drop":
        entries = entries.where(~several)
        target = F.get("slots", 0)
    else:
        message = F.concat(F.lit("keys in several slots: "), F.coalesce("cmd_name", F.lit("?")))
        target = F.when(several, F.raise_error(message).cast("int")).otherwise(F.get("slots", 0))
    nodes = [r.node for r in routes.select("node").distinct().orderBy("node").collect()]
    to = entries.withColumn("slot", target)
    met = to.join(F.broadcast(slot_table(routes)), "slot", "left")
    every = F.array(*[F.lit(n) for n in nodes])
    return met.withColumn("node", F.explode(F.when(F.size("slots") == 0, every).otherwise(F.array("node"))))
