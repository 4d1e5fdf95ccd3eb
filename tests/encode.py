"""Encoders of the snapshot format for tests."""

import struct

from kvflow.functions.hashing import crc64
from kvflow.sources.rdbvalues import MODULE_CHARS


def length(n: int) -> bytes:
    if n < 64:
        return bytes([n])
    if n < 1 << 14:
        return bytes([0x40 | n >> 8, n & 255])
    return b"\x80" + struct.pack(">I", n) if n < 1 << 32 else b"\x81" + struct.pack(">Q", n)


def string(s: bytes) -> bytes:
    return length(len(s)) + s


def backlen(n: int) -> bytes:
    return bytes(1 + (n > 127) + (n > 16383) + (n > 2097151) + (n > 268435455))


def listpack(items: list) -> bytes:
    out = b""
    for x in items:
        if isinstance(x, int):
            if 0 <= x < 128:
                e = bytes([x])
            elif -4096 <= x < 4096:
                e = bytes([0xC0 | (x & 0x1FFF) >> 8, x & 255])
            elif -(1 << 15) <= x < 1 << 15:
                e = b"\xf1" + struct.pack("<h", x)
            elif -(1 << 23) <= x < 1 << 23:
                e = b"\xf2" + struct.pack("<i", x)[:3]
            elif -(1 << 31) <= x < 1 << 31:
                e = b"\xf3" + struct.pack("<i", x)
            else:
                e = b"\xf4" + struct.pack("<q", x)
        elif len(x) < 64:
            e = bytes([0x80 | len(x)]) + x
        elif len(x) < 4096:
            e = bytes([0xE0 | len(x) >> 8, len(x) & 255]) + x
        else:
            e = b"\xf0" + struct.pack("<I", len(x)) + x
        out += e + backlen(len(e))
    return struct.pack("<IH", len(out) + 7, min(len(items), 65535)) + out + b"\xff"


def ziplist(items: list) -> bytes:
    out, prev = b"", 0
    for x in items:
        head = bytes([prev]) if prev < 254 else b"\xfe" + struct.pack("<I", prev)
        if isinstance(x, int):
            if 0 <= x <= 12:
                e = bytes([0xF1 + x])
            elif -128 <= x < 128:
                e = b"\xfe" + struct.pack("<b", x)
            elif -(1 << 15) <= x < 1 << 15:
                e = b"\xc0" + struct.pack("<h", x)
            elif -(1 << 23) <= x < 1 << 23:
                e = b"\xf0" + struct.pack("<i", x)[:3]
            elif -(1 << 31) <= x < 1 << 31:
                e = b"\xd0" + struct.pack("<i", x)
            else:
                e = b"\xe0" + struct.pack("<q", x)
        elif len(x) < 64:
            e = bytes([len(x)]) + x
        elif len(x) < 1 << 14:
            e = bytes([0x40 | len(x) >> 8, len(x) & 255]) + x
        else:
            e = b"\x80" + struct.pack(">I", len(x)) + x
        out += head + e
        prev = len(head + e)
    return struct.pack("<IIH", len(out) + 11, 10, min(len(items), 65535)) + out + b"\xff"


def intset(items: list[int]) -> bytes:
    width, form = next((w, f) for w, f in ((2, "h"), (4, "i"), (8, "q")) if all(-(1 << 8 * w - 1) <= x < 1 << 8 * w - 1 for x in items))
    return struct.pack("<II", width, len(items)) + struct.pack(f"<{len(items)}{form}", *items)


def module_id(name: str, version: int) -> int:
    n = 0
    for ch in name:
        n = n << 6 | MODULE_CHARS.index(ch)
    return n << 10 | version


def unsigned(n: int) -> bytes:
    return length(2) + length(n)


def double(x: float) -> bytes:
    return length(4) + struct.pack("<d", x)


def text(s: bytes) -> bytes:
    return length(5) + string(s)


def snapshot(*parts: bytes, version: int = 9) -> bytes:
    body = b"REDIS%04d" % version + b"".join(parts) + b"\xff"
    return body + crc64(body).to_bytes(8, "little")


def entry(kind: int, key: bytes, value: bytes) -> bytes:
    return bytes([kind]) + string(key) + value
