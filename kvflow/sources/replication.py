"""Replication streams: a full snapshot, then the log that follows it.

format("kvreplica") is a stream of log commands.  The snapshot is taken by take_snapshot(), which leaves a file for the
rdb source and the offset at which the stream starts, so batch and stream meet without a gap.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from kvflow.functions.resp import encode
from kvflow.operators.filters import NOISE, NOISE_CHANNEL
from kvflow.sources.client import Address, Connection
from kvflow.sources.notes import Notes
from kvflow.sources.scan import address_of

SCHEMA = "source_id string, seq long, db_id int, argv array<binary>"
MARK = 40
CHUNK = 1 << 20


@dataclass(frozen=True)
class Handover:
    """Where the log goes on: the master's run id, its offset, the database selected there."""

    run_id: str
    offset: int
    db: int = 0


def handshake(c: Connection, port: int = 10007, diskless: bool = False) -> None:
    c.do("replconf", "listening-port", port)
    if diskless:
        c.do("replconf", "capa", "eof")


def psync(c: Connection, run_id: str = "?", offset: int = -1, command: str = "psync") -> tuple[bool, str, int]:
    """(full, run id, offset) of the master's answer; blank heart-beat lines before it are skipped.

    command: the name under which a hosted server offers PSYNC.
    """
    c.send(command, run_id, offset)
    while not (line := c.reader.line()):
        pass
    if line.startswith(b"-"):
        raise ConnectionError(line.decode(errors="replace"))
    part = line.lstrip(b"+").decode().split()
    if part[0].upper() == "FULLRESYNC":
        return True, part[1], int(part[2])
    return False, part[1] if len(part) > 1 else run_id, offset


def receive_snapshot(c: Connection, path: str) -> int:
    """Save the snapshot that follows a full answer; returns its bytes.  Known length, or ended by a mark of MARK bytes."""
    while not (head := c.reader.line()):
        pass
    with open(path, "wb") as out:
        if m := re.fullmatch(rb"\$(\d+)", head):
            left = int(m[1])
            while left:
                left -= out.write(c.reader.take(min(left, CHUNK)))
        else:
            mark, tail = head.removeprefix(b"$EOF:"), b""
            if len(mark) != MARK:
                raise ValueError(f"unknown snapshot head {head[:60]!r}")
            while tail != mark:  # the mark may come in pieces: its length is always held back
                have = max(1, len(c.reader.buffer) - c.reader.at)
                at = c.reader.peek(have).find(mark)
                got = tail + c.reader.take(at + MARK if at >= 0 else have)
                if (end := got.find(mark)) >= 0:
                    out.write(got[:end])
                    c.reader.at -= len(got) - end - MARK  # what follows is the log
                    tail = mark
                else:
                    out.write(got[:-MARK])
                    tail = got[-MARK:]
        return out.tell()


def take_snapshot(at: Address, path: str, diskless: bool = False, command: str = "psync") -> Handover:
    with Connection(at) as c:
        handshake(c, diskless=diskless)
        full, run_id, offset = psync(c, command=command)
        if not full:
            raise ConnectionError("a full snapshot was asked for")
        receive_snapshot(c, path)
    return Handover(run_id, offset)


def is_noise(argv: list[bytes]) -> bool:
    name = argv[0].upper().decode(errors="replace")
    return name in NOISE or (name == "PUBLISH" and len(argv) > 1 and argv[1] == NOISE_CHANNEL.encode())


@dataclass
class Stretch(InputPartition):
    start: int
    end: int


def _name(offset: int) -> str:
    return f"{offset:020d}"


class _LogReader(DataSourceStreamReader):
    """Offsets are the master's byte offsets.  A batch is the stretch of log between two of them and is read by an executor,
    which asks the master for it from its start; so does a batch that is run again, and it fails if the log is gone.

    An end may fall inside a command; the stretch then goes on to that command's end.  Where it ended and the database
    selected there are noted in the state folder under the end, for the stretch that follows.
    """

    def __init__(self, options: dict) -> None:
        self.options = options
        self.most = int(options.get("max_bytes", 64 << 20))
        if not options.get("state"):
            raise ValueError("state is needed: a folder that the driver and all executors reach")

    def _notes(self) -> Notes:
        return Notes(self.options["state"])

    def initialOffset(self) -> dict:
        return {"offset": int(self.options["offset"])}

    def latestOffset(self) -> dict:
        done = max([int(n) for n in self._notes().names()], default=int(self.options["offset"]))
        with Connection(address_of(self.options)) as c:
            m = re.search(rb"^master_repl_offset:(\d+)", c.do("info", "replication"), re.M)
        if not m:
            raise ConnectionError("the master tells no offset")
        return {"offset": min(max(done, int(m[1])), done + self.most)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [Stretch(start["offset"], end["offset"])]

    def read(self, partition: Stretch) -> Iterator[tuple]:
        notes = self._notes()
        known = notes.get(_name(partition.start))
        if known is None:
            if partition.start != int(self.options["offset"]):
                raise ValueError(f"the state folder has no note of offset {partition.start}")
            known = [partition.start, int(self.options.get("db", 0))]
        at, db = known
        if at < partition.end:
            with Connection(address_of(self.options)) as c:
                handshake(c)
                full, _, _ = psync(c, self.options["run_id"], at + 1, self.options.get("psync_command", "psync"))
                if full:
                    raise ConnectionError("the master no longer has the log from this offset; take a snapshot again")
                # What lies before is safely processed.
                c.send_raw(encode(["replconf", "ack", at]))
                base = at - c.reader.offset
                while at < partition.end:
                    argv = c.reader.command()
                    at = base + c.reader.offset
                    if argv and argv[0].upper() == b"SELECT" and len(argv) == 2:
                        db = int(argv[1])
                    elif argv and not is_noise(argv):
                        yield self.options["address"], at, db, argv
        notes.put(_name(partition.end), [at, db])

    def commit(self, end: dict) -> None:
        """Notes before the end are of no more use."""
        notes = self._notes()
        for name in notes.names():
            if int(name) < end["offset"]:
                notes.drop(name)


class ReplicaDataSource(DataSource):
    """Options: address, username, password, tls, run_id, offset, db (of a Handover), state (a shared folder of this stream's
    own), psync_command, max_bytes (of log in a batch), timeout."""

    @classmethod
    def name(cls) -> str:
        return "kvreplica"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> _LogReader:
        return _LogReader(dict(self.options))


def snapshot_path(folder: str, address: str) -> str:
    os.makedirs(folder, exist_ok=True)
    return os.path.join(folder, re.sub(r"\W+", "_", address) + ".rdb")


