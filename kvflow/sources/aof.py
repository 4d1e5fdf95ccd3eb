"""Append-only command logs: single files, and sets of parts named by a manifest."""

from __future__ import annotations

import os
from collections.abc import Generator, Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from kvflow.functions.resp import Reader
from kvflow.operators.ordering import absorb_select
from kvflow.sources import rdb

#: A log's rows before SELECT is absorbed; ts is the time of the last stamp, in seconds.
SCHEMA = "source_id string, seq long, db_id int, argv array<binary>, ts long"
BATCH_ROWS = 5000
#: Kinds of parts in a manifest.
BASE, HISTORY, INCREMENT = "b", "h", "i"


@dataclass(frozen=True)
class Part:
    file: str
    seq: int
    kind: str


_ESCAPES = {"n": "\n", "r": "\r", "t": "\t", "b": "\b", "a": "\a"}


def split_args(line: str) -> list[str]:
    """Words of a line: bare, in single quotes (\\' only) or in double quotes with escapes.  ValueError for open quotes."""
    out, i = [], 0
    while True:
        while i < len(line) and line[i].isspace():
            i += 1
        if i == len(line):
            return out
        word, quote = [], ""
        while i < len(line):
            ch = line[i]
            if not quote and ch.isspace():
                break
            if not quote and ch in "'\"" and not word:
                quote = ch
            elif quote and ch == quote:
                if i + 1 < len(line) and not line[i + 1].isspace():
                    raise ValueError(f"text follows a quote: {line!r}")
                quote, i = "", i + 1
                break
            elif quote == '"' and ch == "\\" and i + 1 < len(line):
                i += 1
                if line[i] == "x" and i + 2 < len(line) and all(c in "0123456789abcdefABCDEF" for c in line[i + 1 : i + 3]):
                    word.append(chr(int(line[i + 1 : i + 3], 16)))
                    i += 2
                else:
                    word.append(_ESCAPES.get(line[i], line[i]))
            elif quote == "'" and line[i : i + 2] == "\\'":
                word.append("'")
                i += 1
            else:
                word.append(ch)
            i += 1
        if quote:
            raise ValueError(f"a quote is open: {line!r}")
        out.append("".join(word))


def parse_manifest(text: str) -> list[Part]:
    """Parts in replay order: the base, then history and increments as listed.  Invalid manifests raise ValueError."""
    parts: list[Part] = []
    if not text.strip():
        raise ValueError("the manifest is empty")
    for line in text.splitlines():
        if not line.strip() or line.startswith("#"):
            continue
        words = split_args(line)
        if len(words) < 6 or len(words) % 2:
            raise ValueError(f"a manifest line needs at least three pairs: {line!r}")
        pairs = {words[i].lower(): words[i + 1] for i in range(0, len(words), 2)}
        if not {"file", "seq", "type"} <= set(pairs):
            raise ValueError(f"file, seq and type are needed: {line!r}")
        name, seq, kind = pairs["file"], int(pairs["seq"]), pairs["type"]
        if not name or os.path.basename(name) != name:
            raise ValueError(f"a part is a bare file name: {name!r}")
        if seq < 1 or kind not in (BASE, HISTORY, INCREMENT):
            raise ValueError(f"seq or type is wrong: {line!r}")
        if kind == BASE and any(p.kind == BASE for p in parts):
            raise ValueError("there are two base parts")
        if kind == INCREMENT and any(p.kind == INCREMENT and p.seq >= seq for p in parts):
            raise ValueError("increments must rise")
        parts.append(Part(name, seq, kind))
    return sorted(parts, key=lambda p: p.kind != BASE)


def format_manifest(parts: list[Part]) -> str:
    """The manifest's text; names with blanks or unprintable characters are quoted."""

    def shown(name: str) -> str:
        if name.isprintable() and " " not in name and '"' not in name and "'" not in name:
            return name
        body = "".join("\\" + c if c in '"\\' else c if c.isprintable() else f"\\x{ord(c):02x}" for c in name)
        return f'"{body}"'

    return "".join(f"file {shown(p.file)} seq {p.seq} type {p.kind}\n" for p in parts)


Record = tuple[int, int, list[bytes], int | None]


def read_log(file: BinaryIO, start: int = 0, until: int = 0, options: rdb.Options = rdb.Options()) -> Generator[Record, None, bool]:
    """(seq, db, argv, ts) of a part, seq from start.  until: stop before the first stamp later than that (0: never).

    A part may begin with a snapshot, as bases do; snapshots aren't cut.  A broken tail ends the log.  The generator's
    value is whether a stamp stopped it.
    """
    head = file.read(5)
    if head == rdb.MAGIC:
        snapshot = rdb.Snapshot(_Joined(head, file), options)
        for r in snapshot:
            yield start, r.db, r.argv, None
            start += 1
        db, head = snapshot.stream_db, b""
    else:
        db = 0
    joined = _Joined(head, file)
    reader = Reader(joined.read)
    ts = None
    first = True
    while not reader.at_end():
        if reader.peek(1) == b"#":
            note = reader.line()
            if note.startswith(b"#TS:"):
                ts = int(note[4:])
                if until and ts > until:
                    return True
            continue
        if first and db:
            yield start, 0, [b"SELECT", b"%d" % db], ts
            start += 1
        first = False
        yield start, 0, reader.command(), ts
        start += 1
    return False


class _Joined:
    """A file object with some bytes read before."""

    def __init__(self, head: bytes, file: BinaryIO) -> None:
        self.head, self.file = head, file

    def read(self, n: int) -> bytes:
        if self.head:
            got, self.head = self.head[:n], self.head[n:]
            return got if len(got) == n else got + self.file.read(n - len(got))
        return self.file.read(n)


def _batches(source: str, records: Iterator[Record]) -> Iterator[pa.RecordBatch]:
    held: list[Record] = []

    def batch() -> pa.RecordBatch:
        seq, db, argv, ts = zip(*held, strict=True)
        held.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([source] * len(seq), pa.string()), pa.array(seq, pa.int64()), pa.array(db, pa.int32()), pa.array(argv, pa.list_(pa.binary())), pa.array(ts, pa.int64())],
            ["source_id", "seq", "db_id", "argv", "ts"],
        )

    for r in records:
        held.append(r)
        if len(held) == BATCH_ROWS:
            yield batch()
    if held:
        yield batch()


def read_aof(spark: SparkSession, path: str, until: int = 0, absorb: bool = True) -> DataFrame:
    """Commands of the logs under path (any storage Spark reads; files under 2 GB), one task and one source for each file.

    absorb: SELECT rows go and set db_id, as in a replication stream.
    """
    return decode_files(spark.read.format("binaryFile").load(path), until, absorb)


def decode_files(files: DataFrame, until: int = 0, absorb: bool = True) -> DataFrame:
    """Commands of logs in a table of path and content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io

        for b in batches:
            for name, content in zip(b.column(0), b.column(1), strict=True):
                yield from _batches(name.as_py(), read_log(io.BytesIO(content.as_py()), 0, until))

    rows = files.select("path", "content").mapInArrow(run, SCHEMA)
    return _absorbed(rows) if absorb else rows


def _absorbed(rows: DataFrame) -> DataFrame:
    """Rows of a snapshot keep their own database."""
    from_log = absorb_select(rows.withColumn("own", F.col("db_id")))
    return from_log.withColumn("db_id", F.when(F.col("own") > 0, F.col("own")).otherwise(F.col("db_id"))).drop("own")


#: seq of the rows of part n start at n times this, those of its piece m at m times PIECE_ROWS after that.
PART_ROWS = 1 << 40
PIECE_ROWS = 1 << 20


def read_multipart(spark: SparkSession, folder: str, manifest: str, until: int = 0, absorb: bool = True) -> DataFrame:
    """Commands of the parts that folder/manifest names, as one source; a part is a task.  The base is never cut."""
    text = "\n".join(r.value for r in spark.read.text(f"{folder}/{manifest}").collect())
    parts = parse_manifest(text)
    found = spark.read.format("binaryFile").load([f"{folder}/{p.file}" for p in parts]).select("path", "content")
    return decode_parts(found, parts, manifest, until, absorb)


def decode_parts(files: DataFrame, parts: list[Part], source: str, until: int = 0, absorb: bool = True) -> DataFrame:
    """Commands of the parts in a table of path and content, as one source.  The base is never cut.

    With a column piece a part may take many rows, so that no task holds it whole: its pieces are numbered from 0 in the
    part's order, begin at a command or a stamp, and are decoded each by itself.  Rows before a piece's first stamp have
    no ts; databases and cuts pass from piece to piece.  A snapshot is one piece.  Pieces of more than PIECE_ROWS rows
    are refused, as are numbers from PART_ROWS / PIECE_ROWS on.
    """
    rank = {p.file: (i, p.kind) for i, p in enumerate(parts)}
    pieces = "piece" in files.columns
    files = files.select("path", "content", F.col("piece").cast("long") if pieces else F.lit(0).cast("long").alias("piece"))

    def place(name: str, piece: int) -> tuple[int, int]:
        """The seq at which a piece starts, and the time at which its log is cut."""
        from urllib.parse import unquote

        if not 0 <= piece < PART_ROWS // PIECE_ROWS:
            raise ValueError(f"piece {piece} of {name}: the numbers end at {PART_ROWS // PIECE_ROWS - 1}")
        i, kind = rank[unquote(os.path.basename(name))]
        return i * PART_ROWS + piece * PIECE_ROWS, 0 if kind == BASE else until

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes, int | None]]:
        for b in batches:
            for name, content, piece, *cut in zip(*b.columns, strict=True):
                yield *place(name.as_py(), piece.as_py()), content.as_py(), cut[0].as_py() if cut else None

    def stopped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The starts of the pieces with a late stamp."""
        import io

        found = [start for start, late, content, _ in each(batches) if late and _is_cut(read_log(io.BytesIO(content), start, late))]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["cut"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io

        for start, late, content, cut in each(batches):
            if not late or cut is None or start <= cut:
                rows = read_log(io.BytesIO(content), start, late)
                yield from _batches(source, _bounded(rows, start + PIECE_ROWS) if pieces else rows)

    if until:
        files = files.crossJoin(F.broadcast(files.mapInArrow(stopped, "cut long").agg(F.min("cut").alias("cut"))))
    rows = files.mapInArrow(run, SCHEMA)
    return _absorbed(rows) if absorb else rows


def _is_cut(records: Generator[Record, None, bool]) -> bool:
    while True:
        try:
            next(records)
        except StopIteration as end:
            return end.value


def _bounded(records: Iterator[Record], end: int) -> Iterator[Record]:
    for r in records:
        if r[0] >= end:
            raise ValueError(f"a piece has more than {PIECE_ROWS} rows")
        yield r


def total_size(spark: SparkSession, folder: str, parts: list[Part]) -> int:
    """Bytes of all parts."""
    found = spark.read.format("binaryFile").load([f"{folder}/{p.file}" for p in parts])
    return found.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


@dataclass
class _File(InputPartition):
    path: str


class _AofReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.paths = [p for p in options.get("path", options.get("filepath", "")).split(",") if p]
        self.until = int(options.get("timestamp", 0))
        if not self.paths:
            raise ValueError("path is needed")

    def partitions(self) -> list[InputPartition]:
        return [_File(p) for p in self.paths]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        with open(partition.path, "rb") as f:
            yield from _batches(partition.path, read_log(f, 0, self.until))


class AofDataSource(DataSource):
    """format("aof"): logs on a file system that every executor mounts, of any size.  Options: path, timestamp."""

    @classmethod
    def name(cls) -> str:
        return "aof"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _AofReader:
        return _AofReader(dict(self.options))
