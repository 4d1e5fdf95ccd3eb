"""A connection to a key-value server: commands out, replies in, and what the sources and sinks ask of it."""

from __future__ import annotations

import re
import socket
import ssl
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

from kvflow.functions.resp import Reader, ReplyError, encode
from kvflow.operators.routing import Node, best_replica, parse_nodes


@dataclass(frozen=True)
class Address:
    """Where and how to connect.  TLS certificates are not verified unless verify is set."""

    address: str
    username: str = ""
    password: str = ""
    tls: bool = False
    verify: bool = False
    timeout: float = 10.0


class Connection:
    def __init__(self, at: Address) -> None:
        host, _, port = at.address.rpartition(":")
        sock = socket.create_connection((host.strip("[]"), int(port)), timeout=at.timeout)
        if at.tls:
            context = ssl.create_default_context()
            if not at.verify:
                context.check_hostname, context.verify_mode = False, ssl.CERT_NONE
            sock = context.wrap_socket(sock, server_hostname=host)
        self.socket = sock
        self.reader = Reader(lambda n: self.socket.recv(max(n, 1 << 16)))
        if at.password:
            self.do("auth", *([at.username] if at.username else []), at.password)
        if self.do("ping") not in ("PONG", b"PONG"):
            raise ConnectionError("no answer to PING")

    def send(self, *argv: bytes | str | int) -> None:
        self.socket.sendall(encode(list(argv)))

    def send_raw(self, data: bytes) -> None:
        self.socket.sendall(data)

    def receive(self) -> Any:
        return self.reader.reply()

    def do(self, *argv: bytes | str | int) -> Any:
        self.send(*argv)
        return self.receive()

    def scan(self, cursor: int, count: int) -> tuple[int, list[bytes]]:
        at, keys = self.do("scan", cursor, "count", count)
        return int(at), keys

    def keys(self, count: int, progress: Callable[[float], None] | None = None) -> Iterator[bytes]:
        """Every key; progress is told the share that is scanned after each step, in percent."""
        cursor = None
        while cursor != 0:
            cursor, keys = self.scan(cursor or 0, count)
            if progress:
                progress(scanned(cursor))
            yield from keys

    def databases(self) -> list[int]:
        """Databases that hold keys."""
        info = self.do("info", "keyspace").decode()
        return [int(x) for x in re.findall(r"^db(\d+):", info, re.M)]

    def nodes(self) -> list[Node]:
        return parse_nodes(self.do("cluster", "nodes").decode())

    def replica(self) -> str | None:
        return best_replica(self.do("info", "replication").decode())

    def sentinel_master(self, name: str) -> str:
        got = self.do("sentinel", "get-master-addr-by-name", name)
        if not got:
            raise ReplyError(f"no master named {name}")
        return f"{got[0].decode()}:{got[1].decode()}"

    def close(self) -> None:
        self.socket.close()

    def __enter__(self) -> Connection:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


def scanned(cursor: int) -> float:
    """The share of a keyspace, in percent, that a scan has done at a cursor: its bits count up from the highest; 0 is the end."""
    return 100.0 * int(f"{cursor:064b}"[::-1], 2) / ((1 << 64) - 1) if cursor else 100.0


def shard_addresses(at: Address, cluster: bool, prefer_replica: bool = False) -> list[str]:
    """The addresses to read from: each shard's master, or its best healthy replica."""
    with Connection(at) as c:
        if not cluster:
            return [(c.replica() if prefer_replica else None) or at.address]
        nodes = c.nodes()
    masters = [n for n in nodes if n.is_master and n.slots]
    if not prefer_replica:
        return [n.address for n in masters]
    spare = {n.master_id: n.address for n in reversed(nodes) if not n.is_master and n.healthy}
    return [spare.get(n.node_id, n.address) for n in masters]
