"""Checksums: CRC-16/XMODEM and key slots as native expressions and in Python, CRC-64 in Python."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from kvflow.model import SLOTS

CRC16_POLY = 0x1021
#: Reflected form of the CRC-64 polynomial used by dump trailers.
CRC64_POLY = 0x95AC9329AC4BC9B5


@cache
def crc16_table() -> tuple[int, ...]:
    out = []
    for byte in range(256):
        c = byte << 8
        for _ in range(8):
            c = ((c << 1) ^ CRC16_POLY if c & 0x8000 else c << 1) & 0xFFFF
        out.append(c)
    return tuple(out)


@cache
def crc64_table() -> tuple[int, ...]:
    out = []
    for byte in range(256):
        c = byte
        for _ in range(8):
            c = (c >> 1) ^ CRC64_POLY if c & 1 else c >> 1
        out.append(c)
    return tuple(out)


def crc16(data: bytes) -> int:
    table, c = crc16_table(), 0
    for byte in data:
        c = ((c << 8) & 0xFFFF) ^ table[(c >> 8) ^ byte]
    return c


def crc64(data: bytes, start: int = 0) -> int:
    table, c = crc64_table(), start
    for byte in data:
        c = table[(c ^ byte) & 0xFF] ^ (c >> 8)
    return c


def hash_tag(key: bytes) -> bytes:
    """What is hashed of a key: the part between the first ``{`` and the next ``}`` unless empty, else all of it."""
    at = key.find(b"{")
    end = key.find(b"}", at + 1) if at >= 0 else -1
    return key[at + 1 : end] if end > at + 1 else key


def slot_of(key: bytes) -> int:
    return crc16(hash_tag(key)) % SLOTS


def _bytes(key: Column) -> Column:
    """Byte values of a binary column: as text of one character a byte."""
    return F.transform(F.split(F.decode(key, "ISO-8859-1"), ""), lambda c: F.ascii(c))


def slot(key: Column) -> Column:
    """slot_of for a binary column, in the JVM."""
    table = F.from_json(F.lit(str(list(crc16_table()))), "array<int>")
    every = F.when(F.octet_length(key) > 0, _bytes(key)).otherwise(F.array().cast("array<int>"))
    opened = F.array_position(every, F.lit(ord("{"))).cast("int")
    after = F.slice(every, opened + 1, F.size(every))
    closed = F.when((opened > 0) & (opened < F.size(every)), F.array_position(after, F.lit(ord("}"))).cast("int")).otherwise(0)
    hashed = F.when(closed > 1, F.slice(every, opened + 1, closed - 1)).otherwise(every)

    def step(c: Column, b: Column) -> Column:
        return F.shiftleft(c, 8).bitwiseAND(0xFFFF).bitwiseXOR(F.get(table, F.shiftright(c, 8).bitwiseXOR(b)))

    return F.aggregate(hashed, F.lit(0), step).bitwiseAND(SLOTS - 1)
