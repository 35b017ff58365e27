"""PostgreSQL's COPY BINARY: rows of (length, value) fields between a header and a trailer."""

from __future__ import annotations

import datetime as dt
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed values of the public format.
HEADER = b"PGCOPY\n\xff\r\n\0" + struct.pack(">ii", 0, 0)
TRAILER = struct.pack(">h", -1)
_EPOCH = dt.datetime(2000, 1, 1)
_FORMS = {T.ShortType: ">h", T.IntegerType: ">i", T.LongType: ">q", T.FloatType: ">f", T.DoubleType: ">d"}


def field(v, kind: T.DataType) -> bytes:
    if v is None:
        return struct.pack(">i", -1)
    if type(kind) in _FORMS:
        raw = struct.pack(_FORMS[type(kind)], v)
    elif isinstance(kind, T.BooleanType):
        raw = bytes([bool(v)])
    elif isinstance(kind, T.DateType):
        raw = struct.pack(">i", (v - _EPOCH.date()).days)
    elif isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        raw = struct.pack(">q", (v.replace(tzinfo=None) - _EPOCH) // dt.timedelta(microseconds=1))
    elif isinstance(kind, T.BinaryType):
        raw = bytes(v)
    elif isinstance(kind, T.StringType):
        raw = v.replace("\0", "").encode()
    else:
        raw = str(v).encode()
    return struct.pack(">i", len(raw)) + raw


def row(values, kinds: list[T.DataType]) -> bytes:
    return struct.pack(">h", len(kinds)) + b"".join(map(field, values, kinds))


def rows(df: DataFrame, key: list[str] | None = None) -> DataFrame:
    """``df`` with each row's bytes in column ``copy`` (and the ``key`` columns)."""
    kinds, keep = [f.dataType for f in df.schema], [df.columns.index(k) for k in key or []]
    schema = T.StructType([df.schema[k] for k in keep] + [T.StructField("copy", T.BinaryType())])

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body = pa.array([row(v, kinds) for v in zip(*(c.to_pylist() for c in batch.columns))], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), body], names=[x.name for x in schema])

    return df.mapInArrow(f, schema)


def parse(data: bytes) -> list[list[bytes | None]]:
    """The raw fields of a whole stream."""
    if not data.startswith(HEADER[:11]):
        raise ValueError("no COPY header")
    at, out = len(HEADER), []
    while True:
        (n,) = struct.unpack_from(">h", data, at)
        at += 2
        if n < 0:
            return out
        got = []
        for _ in range(n):
            (size,) = struct.unpack_from(">i", data, at)
            at += 4
            got.append(None if size < 0 else data[at : at + size])
            at += max(0, size)
        out.append(got)
