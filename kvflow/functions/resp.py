"""The wire format of commands and replies: encoding as native expressions, encoding and decoding in Python."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

CRLF = b"\r\n"


def encoded(argv: Column) -> Column:
    """A command as bytes, from array<binary>."""
    end = F.lit(CRLF)

    def part(a: Column) -> Column:
        return F.concat(F.concat(F.lit("$"), F.octet_length(a).cast("string")).cast("binary"), end, a, end)

    head = F.concat(F.concat(F.lit("*"), F.size(argv).cast("string")).cast("binary"), end)
    return F.aggregate(argv, head, lambda acc, a: F.concat(acc, part(a)))


def encoded_size(argv: Column) -> Column:
    """octet_length(encoded(argv)) without building it."""

    def digits(n: Column) -> Column:
        return F.length(n.cast("string"))

    start = (F.lit(3) + digits(F.size(argv))).cast("long")
    return F.aggregate(argv, start, lambda acc, a: acc + (F.lit(5) + digits(F.octet_length(a)) + F.octet_length(a)).cast("long"))


def display(argv: Column, most: int = 100) -> Column:
    """Arguments as text, joined by blanks; each cut to most bytes, marked by dots."""
    shown = F.transform(argv, lambda a: F.when(F.octet_length(a) > most, F.concat(F.substring(a, 1, most).cast("string"), F.lit("..."))).otherwise(a.cast("string")))
    return F.array_join(shown, " ")


def encode(argv: list[bytes | str | int]) -> bytes:
    parts = [a if isinstance(a, bytes) else str(a).encode() for a in argv]
    return b"*%d\r\n" % len(parts) + b"".join(b"$%d\r\n%s\r\n" % (len(p), p) for p in parts)


class ReplyError(Exception):
    """An error reply of the server."""


class Incomplete(Exception):
    """The bytes end inside a reply."""


class Reader:
    """Decodes replies and commands, of protocol versions 2 and 3, from ``more(n)``: at least one byte, b"" at the end."""

    def __init__(self, more: Callable[[int], bytes]) -> None:
        self.more, self.buffer, self.at, self.base = more, b"", 0, 0

    @property
    def offset(self) -> int:
        """Bytes consumed so far."""
        return self.base + self.at

    def _fill(self, n: int) -> None:
        if self.at > 1 << 20:
            self.base += self.at
            self.buffer, self.at = self.buffer[self.at :], 0
        parts, have = [self.buffer], len(self.buffer) - self.at
        while have < n:
            got = self.more(max(n - have, 1 << 16))
            if not got:
                raise Incomplete
            parts.append(got)
            have += len(got)
        if len(parts) > 1:
            self.buffer = b"".join(parts)

    def at_end(self) -> bool:
        try:
            self._fill(1)
        except Incomplete:
            return True
        return False

    def peek(self, n: int) -> bytes:
        self._fill(n)
        return self.buffer[self.at : self.at + n]

    def take(self, n: int) -> bytes:
        self._fill(n)
        got = self.buffer[self.at : self.at + n]
        self.at += n
        return got

    def line(self) -> bytes:
        """Up to a line end, which goes too."""
        start = 0
        while True:
            end = self.buffer.find(b"\n", self.at + start)
            if end >= 0:
                got = self.buffer[self.at : end]
                self.at = end + 1
                return got[:-1] if got.endswith(b"\r") else got
            start = len(self.buffer) - self.at
            self._fill(start + 1)

    def reply(self) -> Any:
        """One reply; errors are raised.  Attributes are dropped; sets become lists."""
        line = self.line()
        kind, rest = line[:1], line[1:]
        if kind == b"+":
            return rest.decode(errors="replace")
        if kind == b"-":
            raise ReplyError(rest.decode(errors="replace"))
        if kind == b":" or kind == b"(":
            return int(rest)
        if kind == b"_":
            return None
        if kind == b"#":
            return rest == b"t"
        if kind == b",":
            return float(rest.replace(b"inf", b"Infinity") if b"inf" in rest else rest)
        if kind in (b"$", b"!", b"="):
            n = int(rest)
            if n < 0:
                return None
            body = self.take(n)
            self.take(2)
            if kind == b"!":
                raise ReplyError(body.decode(errors="replace"))
            return body[4:] if kind == b"=" else body
        if kind in (b"*", b"~", b">"):
            n = int(rest)
            return None if n < 0 else [self.reply() for _ in range(n)]
        if kind == b"%":
            return {self._hashable(self.reply()): self.reply() for _ in range(int(rest))}
        if kind == b"|":
            for _ in range(2 * int(rest)):
                self.reply()
            return self.reply()
        raise ValueError(f"unknown reply type {line[:20]!r}")

    @staticmethod
    def _hashable(x: Any) -> Any:
        return tuple(x) if isinstance(x, list) else x

    def command(self) -> list[bytes]:
        """One command: an array of bulk strings."""
        got = self.reply()
        if not isinstance(got, list) or not all(isinstance(a, bytes) for a in got):
            raise ValueError("not a command")
        return got
