"""Scalar codecs as column expressions: all of them stay in generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .types import CP1252

#: Flag of a record whose transaction id has 16 more bits.
LONG_TXN = 1024


def txn(lo: Column, hi: Column, flags: Column) -> Column:
    """The 48-bit transaction id."""
    wide = F.shiftleft(hi.cast("bigint"), 32).bitwiseOR(lo.cast("bigint"))
    return F.when(flags.bitwiseAND(LONG_TXN) != 0, wide).otherwise(lo.cast("bigint"))


def cp1252(raw: Column) -> Column:
    """Text of bytes in code page 1252, without NUL."""
    src, to = "".join(map(chr, CP1252)), "".join(CP1252.values())
    return F.translate(F.decode(raw, "ISO-8859-1"), src + "\0", to)


def trim_fixed(text: Column) -> Column:
    """Fixed-length text: trailing characters up to a blank go."""
    return F.regexp_replace(text, r"[\x00-\x20]+$", "")


def trim_var(text: Column) -> Column:
    """Varying text: the same, but text of such characters alone stays whole."""
    cut = trim_fixed(text)
    return F.when(cut == "", text).otherwise(cut)


def scaled(v: Column, scale: int, decimals: str = "double") -> Column:
    """A scaled integer's value."""
    if scale == 0:
        return v
    if decimals == "exact" and scale < 0:
        return (v.cast("decimal(38,0)") / F.lit(10**-scale).cast("decimal(38,0)")).cast(f"decimal(38,{-scale})")
    return v.cast("double") / F.lit(10.0**-scale)


def mjd_date(days: Column) -> Column:
    return F.date_add(F.lit("1858-11-17").cast("date"), days.cast("int"))


def date_mjd(day: Column) -> Column:
    return F.datediff(day, F.lit("1858-11-17").cast("date"))


def ticks_micros(ticks: Column) -> Column:
    """Time of day, in microseconds, of ticks of 100 of them."""
    return ticks.cast("bigint") * 100


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 2000-01-01 of a time stamp without zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def timestamp(days: Column, ticks: Column) -> Column:
    """The time stamp of a modified Julian day and ticks."""
    return F.timestamp_add("MICROSECOND", ticks_micros(ticks), mjd_date(days).cast("timestamp_ntz"))


def boolean(byte: Column) -> Column:
    return byte != 0


def unless_null(v: Column, bitmap: Column, mask: Column | int) -> Column:
    """NULL where the bitmap's bit is set or the bitmap byte is missing."""
    byte = F.coalesce(bitmap, F.lit(0xFF))
    return F.when(byte.bitwiseAND(mask) == 0, v)


def key_hex(v: Column, size: int) -> Column:
    """An integer key field as COPY encodes it: a 4-byte length, then the value, big-endian; in hex."""
    body = F.lpad(F.hex(v.cast("bigint")), 16, "0")
    return F.concat(F.lit(f"{size:08X}"), F.substring(body, 17 - 2 * size, 2 * size))


def blob_place(record: Column, page_size: int) -> tuple[Column, Column]:
    """Page sequence and slot of a numbered record."""
    each = (page_size - 28) // 17
    return F.floor(record / each).cast("bigint"), (record % each).cast("bigint")


def speed(rows: Column, nanos: Column, size: Column) -> Column:
    """Rows and megabytes a second, for reports."""
    seconds = nanos / F.lit(1e9)
    text = F.concat(F.round(rows / seconds).cast("bigint").cast("string"), F.lit(" rows/s  "), F.format_string("%.1f", size / F.lit(1048576.0) / seconds), F.lit(" MB/s"))
    return F.when(nanos == 0, F.lit("—")).otherwise(text)
