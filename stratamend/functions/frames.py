"""Frames for exchange with other programs: length-prefixed bodies, chunks, requests and responses."""

from __future__ import annotations

import json
import struct
from collections.abc import Iterable, Iterator
from typing import BinaryIO

FULL, DELTA, VERSION = 1, 2, 1
#: Both sides agree on the first four bytes; a peer's own are a parameter.
MAGIC = b"SMND"


def _exactly(r: BinaryIO, n: int) -> bytes:
    got = r.read(n)
    if len(got) != n:
        raise EOFError(f"{len(got)} of {n} bytes")
    return got


def write_prefixed(w: BinaryIO, body: bytes) -> None:
    w.write(struct.pack(">I", len(body)) + body)


def read_prefixed(r: BinaryIO) -> bytes:
    return _exactly(r, struct.unpack(">I", _exactly(r, 4))[0])


def copy_prefixed(r: BinaryIO, w: BinaryIO, piece: int = 1 << 16) -> int:
    """A prefixed body from ``r`` to ``w`` in pieces; a short one is an error."""
    left = size = struct.unpack(">I", _exactly(r, 4))[0]
    while left:
        got = r.read(min(piece, left))
        if not got:
            raise EOFError(f"{left} of {size} bytes are missing")
        w.write(got)
        left -= len(got)
    return size


def chunks(body: bytes, size: int) -> list[bytes]:
    """``body`` as chunks of at most ``size`` bytes and the empty one that ends it."""
    return [struct.pack(">I", len(body[i : i + size])) + body[i : i + size] for i in range(0, len(body), size)] + [struct.pack(">I", 0)]


def read_chunks(r: BinaryIO) -> Iterator[bytes]:
    while part := read_prefixed(r):
        yield part


def write_chunks(w: BinaryIO, parts: Iterable[bytes]) -> None:
    for part in parts:
        if part:
            write_prefixed(w, part)
    write_prefixed(w, b"")


def write_request(w: BinaryIO, op: int, header: dict, magic: bytes = MAGIC) -> None:
    w.write(magic + bytes([VERSION, op]))
    write_prefixed(w, json.dumps(header).encode())


def read_request(r: BinaryIO, magic: bytes = MAGIC) -> tuple[int, dict]:
    if _exactly(r, 4) != magic:
        raise ValueError("bad magic")
    version, op = _exactly(r, 2)
    if version != VERSION:
        raise ValueError("unsupported version")
    if op not in (FULL, DELTA):
        raise ValueError("unknown operation")
    return op, json.loads(read_prefixed(r))


def write_response(w: BinaryIO, rows: int = 0, upserts: int = 0, deletes: int = 0, error: str | None = None, magic: bytes = MAGIC) -> None:
    body = {"rows": rows, "upserts": upserts, "deletes": deletes} | ({"error": error} if error is not None else {})
    w.write(magic + bytes([error is not None]))
    write_prefixed(w, json.dumps(body).encode())


def read_response(r: BinaryIO, magic: bytes = MAGIC) -> dict:
    if _exactly(r, 4) != magic:
        raise ValueError("bad magic")
    _exactly(r, 1)
    return json.loads(read_prefixed(r))
