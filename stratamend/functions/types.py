"""Field types: Spark types, DDL, key widths, and decoding of fixed-offset rows."""

from __future__ import annotations

import datetime as dt
import decimal
import struct
from dataclasses import dataclass

from pyspark.sql import types as T

# Fixed values of the file format: type codes of field descriptors.
TEXT, CSTRING, VARYING = 1, 2, 3
SHORT, LONG, QUAD, REAL, DOUBLE, D_FLOAT = 8, 9, 10, 11, 12, 13
DATE, TIME, TIMESTAMP = 14, 15, 16
BLOB, ARRAY, INT64, DBKEY, BOOLEAN = 17, 18, 19, 20, 21
DEC64, DEC128, INT128, TIME_TZ, TIMESTAMP_TZ = 22, 23, 24, 25, 26

#: Day 0 of the modified Julian calendar, by which dates are stored.
MJD_ZERO = dt.date(1858, 11, 17)
_INTEGERS = {SHORT: ("<h", "SMALLINT", T.ShortType(), 5), LONG: ("<i", "INTEGER", T.IntegerType(), 10), INT64: ("<q", "BIGINT", T.LongType(), 19), QUAD: ("<q", "BIGINT", T.LongType(), 19)}


@dataclass(frozen=True)
class Field:
    """A field descriptor: type code, scale, length and the offset in the row."""

    dtype: int = 0
    scale: int = 0
    length: int = 0
    sub_type: int = 0
    flags: int = 0
    offset: int = 0

    @classmethod
    def parse(cls, raw: bytes) -> Field:
        """From the 12 bytes of a stored descriptor."""
        return cls(*struct.unpack("<BbHhHI", raw[:12]))

    def pack(self) -> bytes:
        return struct.pack("<BbHhHI", self.dtype, self.scale, self.length, self.sub_type, self.flags, self.offset)


def ddl_type(f: Field) -> str:
    """The SQL type of a column."""
    if f.dtype in (TEXT, CSTRING):
        return f"VARCHAR({f.length})"
    if f.dtype == VARYING:
        return f"VARCHAR({max(0, f.length - 2)})"
    if f.dtype in _INTEGERS:
        return _INTEGERS[f.dtype][1] if f.scale == 0 else "DOUBLE PRECISION"
    names = {REAL: "REAL", DOUBLE: "DOUBLE PRECISION", D_FLOAT: "DOUBLE PRECISION", DATE: "DATE", TIME: "TIME", TIME_TZ: "TIME", TIMESTAMP: "TIMESTAMP", TIMESTAMP_TZ: "TIMESTAMP", BOOLEAN: "BOOLEAN", DBKEY: "BYTEA"}
    return names.get(f.dtype, "TEXT")


def spark_type(f: Field, decimals: str = "double") -> T.DataType:
    """The Spark type of a column; ``decimals="exact"`` keeps scaled integers as decimals."""
    if f.dtype in _INTEGERS:
        _, _, whole, digits = _INTEGERS[f.dtype]
        if f.scale == 0:
            return whole
        return T.DecimalType(max(digits, -f.scale), -f.scale) if decimals == "exact" and f.scale < 0 else T.DoubleType()
    names = {REAL: T.FloatType(), DOUBLE: T.DoubleType(), D_FLOAT: T.DoubleType(), DATE: T.DateType(), TIME: T.LongType(), TIME_TZ: T.LongType(), TIMESTAMP: T.TimestampNTZType(), TIMESTAMP_TZ: T.TimestampNTZType(), BOOLEAN: T.BooleanType(), DBKEY: T.BinaryType()}
    return names.get(f.dtype, T.StringType())


def key_width(f: Field) -> int:
    """Bytes of an encoded key value without its length prefix; 0 where it varies."""
    if f.dtype in _INTEGERS:
        return struct.calcsize(_INTEGERS[f.dtype][0]) if f.scale == 0 else 8
    return {REAL: 4, DOUBLE: 8, D_FLOAT: 8, DATE: 4, TIME: 8, TIME_TZ: 8, TIMESTAMP: 8, TIMESTAMP_TZ: 8, BOOLEAN: 1}.get(f.dtype, 0)


def key_stride(fields: list[Field | None]) -> int:
    """Bytes of an encoded key tuple, 4 of prefix each; 0 where a field is missing or varies."""
    widths = [key_width(f) if f else 0 for f in fields]
    return sum(4 + w for w in widths) if all(widths) else 0


def create_table(table: str, columns: list[tuple[str, Field]], key: list[str] | None = None, unlogged: bool = False) -> str:
    """CREATE TABLE with quoted lower-case names, each column on a line of its own."""
    lines = ["    {:<42} {}".format(f'"{name.lower()}"', ddl_type(f)) for name, f in columns]
    if key:
        lines.append("    PRIMARY KEY ({})".format(", ".join(f'"{k.lower()}"' for k in key)))
    return 'CREATE {}TABLE "{}" (\n{}\n);'.format("UNLOGGED " if unlogged else "", table.lower(), ",\n".join(lines))


def retarget(sql: str, name: str, to: str) -> str | None:
    """The statement for another table name (the first mention only); None if it doesn't name ``name``."""
    old = f'TABLE "{name}"'
    return sql.replace(old, f'TABLE "{to}"', 1) if old in sql else None


def cp1252(raw: bytes) -> str:
    """Text of bytes in code page 1252; undefined codes stay as they are, NUL goes."""
    return raw.replace(b"\0", b"").decode("latin-1").translate(CP1252)


def _cp1252_table() -> dict[int, str]:
    out = {}
    for code in range(0x80, 0xA0):
        try:
            out[code] = bytes([code]).decode("cp1252")
        except UnicodeDecodeError:
            continue
    return out


CP1252 = _cp1252_table()


def _trimmed(raw: bytes, blank: bool) -> bytes:
    """Without trailing bytes up to a blank; an all-blank value stays whole where ``blank`` is set."""
    end = len(raw)
    while end and raw[end - 1] <= 0x20:
        end -= 1
    return raw if blank and not end else raw[:end]


def is_null(row: bytes, field_id: int) -> bool:
    """By the bitmap at the row's start; a bit beyond a short row counts as set."""
    byte = row[field_id >> 3] if field_id >> 3 < len(row) else 0xFF
    return bool(byte & 1 << (field_id & 7))


def value(row: bytes, f: Field, decimals: str = "double"):
    """A field's value; None where the row ends before it, and for types without a counterpart."""
    at, raw = f.offset, row[f.offset :]
    if f.dtype in (TEXT, CSTRING):
        return cp1252(_trimmed(raw[: f.length], False)) if raw and f.length else None
    if f.dtype == VARYING:
        if len(raw) < 2:
            return None
        size = int.from_bytes(raw[:2], "little")
        return cp1252(_trimmed(raw[2 : 2 + size], True))
    if f.dtype in _INTEGERS:
        form = _INTEGERS[f.dtype][0]
        if len(raw) < struct.calcsize(form):
            return None
        (v,) = struct.unpack_from(form, row, at)
        if f.scale == 0:
            return v
        if decimals == "exact" and f.scale < 0:
            return decimal.Decimal(v).scaleb(f.scale)
        return v / 10.0**-f.scale
    sizes = {REAL: "<f", DOUBLE: "<d", D_FLOAT: "<d", DATE: "<i", TIME: "<I", TIME_TZ: "<I", TIMESTAMP: "<iI", TIMESTAMP_TZ: "<iI"}
    if f.dtype in sizes:
        if len(raw) < struct.calcsize(sizes[f.dtype]):
            return None
        got = struct.unpack_from(sizes[f.dtype], row, at)
        if f.dtype == DATE:
            return MJD_ZERO + dt.timedelta(days=got[0])
        if f.dtype in (TIME, TIME_TZ):
            return got[0] * 100
        if f.dtype in (TIMESTAMP, TIMESTAMP_TZ):
            return dt.datetime.combine(MJD_ZERO, dt.time()) + dt.timedelta(days=got[0], microseconds=got[1] * 100)
        return got[0]
    if f.dtype == BOOLEAN:
        return raw[0] != 0 if raw else None
    if f.dtype == DBKEY:
        return raw[: f.length]
    return None


def decode(row: bytes, columns: list[tuple[int, Field]], decimals: str = "double") -> list:
    """The values of (field id, descriptor) pairs."""
    return [None if is_null(row, fid) else value(row, f, decimals) for fid, f in columns]
