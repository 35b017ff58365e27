"""The run-length code of stored records.

A signed control byte n: n >= 0 copies the next n bytes; -1 and -2 repeat a
byte by a 16- or 32-bit count; any other repeats it -n times.
"""

from __future__ import annotations

import struct

#: A record has no more bytes than this.
MOST = 256 * 1024


def decompress(data: bytes) -> bytes | None:
    """The record, or None if the code is cut short or the record too long."""
    out, size, i, n = [], 0, 0, len(data)
    while i < n:
        (control,) = struct.unpack_from("b", data, i)
        i += 1
        if control >= 0:
            piece = data[i : i + control]
            if len(piece) < control:
                return None
            i += control
        else:
            count = -control
            wide = {-1: "<H", -2: "<I"}.get(control)
            if wide:
                if i + struct.calcsize(wide) > n:
                    return None
                (count,) = struct.unpack_from(wide, data, i)
                i += struct.calcsize(wide)
            if i >= n or size + count > MOST:
                return None
            piece = data[i : i + 1] * count
            i += 1
        size += len(piece)
        if size > MOST:
            return None
        out.append(piece)
    return b"".join(out)


def compress(data: bytes) -> bytes:
    """A code for ``data``: runs of four bytes or more become repeats."""
    out, i, plain = bytearray(), 0, bytearray()

    def flush() -> None:
        for at in range(0, len(plain), 127):
            part = plain[at : at + 127]
            out.append(len(part))
            out.extend(part)
        plain.clear()

    while i < len(data):
        j = i
        while j < len(data) and data[j] == data[i]:
            j += 1
        run = j - i
        if run < 4:
            plain += data[i:j]
        else:
            flush()
            if run <= 128:
                out += struct.pack("b", -run) + data[i : i + 1]
            elif run < 1 << 16:
                out += b"\xff" + struct.pack("<H", run) + data[i : i + 1]
            else:
                out += b"\xfe" + struct.pack("<I", run) + data[i : i + 1]
        i = j
    flush()
    return bytes(out)
