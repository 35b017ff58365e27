import datetime as dt
import decimal
import io
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stratamend.functions import codecs, copybinary, frames, rle
from stratamend.functions import types as K


@pytest.mark.parametrize(
    "code, want",
    [
        ("", ""),
        ("00", ""),
        ("000000", ""),
        ("03071430", "071430"),
        ("FB2A", "2A" * 5),
        ("80FF", "FF" * 128),
        ("FFF401AB", "AB" * 500),
        ("03071430872A000141", "071430" + "2A" * 121 + "41"),
        ("0A010203", None),
        ("FB", None),
        ("FF01", None),
        ("FE00000500AA", None),
    ],
)
def test_run_lengths(code, want):
    got = rle.decompress(bytes.fromhex(code))
    assert got == (None if want is None else bytes.fromhex(want))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.binary(min_size=1, max_size=1), st.integers(1, 700)), max_size=12))
def test_run_lengths_round_trip(parts):
    data = b"".join(b * n for b, n in parts)
    assert rle.decompress(rle.compress(data)) == data


def test_text():
    assert K.cp1252(bytes(range(1, 256))) == "".join(chr(b) for b in range(1, 0x80)) + "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ" + "".join(chr(b) for b in range(0xA0, 0x100))
    fixed, var = K.Field(K.TEXT, 0, 5, offset=4), K.Field(K.VARYING, 0, 7, offset=4)
    assert K.value(b"\0\0\0\0ab \t ", fixed) == "ab" and K.value(b"\0\0\0\0     ", fixed) == ""
    assert K.value(b"\0\0\0\0\3\0a  ", var) == "a" and K.value(b"\0\0\0\0\3\0   ", var) == "   "
    assert K.value(b"\0\0\0\0\xff\0ab", var) == "ab" and K.value(b"\0\0\0\0", fixed) is None and K.value(b"\0\0\0\0\1", var) is None


def test_values():
    at = lambda kind, raw, scale=0, length=8: K.value(b"\0" * 4 + raw, K.Field(kind, scale, length, offset=4))
    assert at(K.SHORT, struct.pack("<h", -7)) == -7 and at(K.LONG, struct.pack("<i", 12345), -2) == 123.45 and at(K.INT64, struct.pack("<q", -5), -1) == -0.5
    assert K.value(b"\0" * 4 + struct.pack("<i", 12345), K.Field(K.LONG, -2, 4, offset=4), "exact") == decimal.Decimal("123.45")
    assert at(K.DATE, struct.pack("<i", 51544)) == dt.date(2000, 1, 1) and at(K.TIME, struct.pack("<I", 36000000)) == 3_600_000_000
    assert at(K.TIMESTAMP, struct.pack("<iI", 51545, 10)) == dt.datetime(2000, 1, 2, 0, 0, 0, 1000)
    assert at(K.BOOLEAN, b"\2") is True and at(K.DBKEY, b"abcdefgh") == b"abcdefgh" and at(K.BLOB, b"12345678") is None and at(K.DEC64, b"12345678") is None
    assert at(K.LONG, b"\1\2") is None and at(K.DOUBLE, b"\1\2") is None and at(K.BOOLEAN, b"") is None
    assert K.is_null(b"\2", 1) and not K.is_null(b"\2", 0) and K.is_null(b"\0", 9)


def test_widths_and_ddl():
    f = K.Field
    assert K.key_stride([f(K.LONG)]) == 8 and K.key_stride([f(K.INT64)]) == 12 and K.key_stride([f(K.DATE)]) == 8 and K.key_stride([f(K.LONG), f(K.INT64)]) == 20
    assert K.key_stride([f(K.VARYING, 0, 10)]) == 0 and K.key_stride([f(K.LONG), None]) == 0 and K.key_stride([f(K.SHORT, -2)]) == 12
    sql = K.create_table("Vendas", [("NROVENDA", f(K.LONG)), ("CLIENTE", f(K.VARYING, 0, 42)), ("TOTAL", f(K.INT64, -2))], ["NROVENDA"])
    assert sql.split("\n") == [
        'CREATE TABLE "vendas" (',
        '    "nrovenda"                                 INTEGER,',
        '    "cliente"                                  VARCHAR(40),',
        '    "total"                                    DOUBLE PRECISION,',
        '    PRIMARY KEY ("nrovenda")',
        ");",
    ]
    assert K.retarget(sql, "vendas", "vendas_new").startswith('CREATE TABLE "vendas_new" (') and K.retarget(sql, "other", "x") is None
    assert K.Field.parse(K.Field(9, -2, 4, 1, 2, 77).pack()) == K.Field(9, -2, 4, 1, 2, 77)


def test_frames():
    b = io.BytesIO()
    frames.write_prefixed(b, b"one")
    frames.write_prefixed(b, b"")
    b.seek(0)
    one, two = io.BytesIO(), io.BytesIO()
    assert frames.copy_prefixed(b, one) == 3 and frames.copy_prefixed(b, two) == 0 and one.getvalue() == b"one"
    with pytest.raises(EOFError):
        frames.copy_prefixed(io.BytesIO(struct.pack(">I", 10) + b"12345"), io.BytesIO())
    body = bytes(range(256)) * 5
    assert b"".join(frames.read_chunks(io.BytesIO(b"".join(frames.chunks(body, 100))))) == body
    w = io.BytesIO()
    frames.write_chunks(w, [b"a", b"", b"b"])
    assert list(frames.read_chunks(io.BytesIO(w.getvalue()))) == [b"a", b"b"]
    w = io.BytesIO()
    frames.write_request(w, frames.DELTA, {"table": "t", "n_upserts": 3})
    assert frames.read_request(io.BytesIO(w.getvalue())) == (frames.DELTA, {"table": "t", "n_upserts": 3})
    for bad in (b"XXXX" + w.getvalue()[4:], w.getvalue()[:4] + b"\2" + w.getvalue()[5:], w.getvalue()[:5] + b"\7" + w.getvalue()[6:]):
        with pytest.raises(ValueError):
            frames.read_request(io.BytesIO(bad))
    w = io.BytesIO()
    frames.write_response(w, rows=4, error="no")
    assert frames.read_response(io.BytesIO(w.getvalue())) == {"rows": 4, "upserts": 0, "deletes": 0, "error": "no"}


def test_copy_binary(spark, tmp_path):
    from stratamend.plans.load import export_copy

    df = spark.sql("SELECT 1 AS a, CAST(2 AS BIGINT) AS b, 'é' AS c, DATE'2000-01-02' AS d, TIMESTAMP_NTZ'2000-01-01 00:00:01' AS e, true AS f, CAST(NULL AS INT) AS g, CAST(1.5 AS DOUBLE) AS h, CAST(3 AS SMALLINT) AS i")
    export_copy(df, str(tmp_path))
    (row,) = copybinary.parse((tmp_path / "stream").read_bytes())
    assert row == [struct.pack(">i", 1), struct.pack(">q", 2), "é".encode(), struct.pack(">i", 1), struct.pack(">q", 10**6), b"\1", None, struct.pack(">d", 1.5), struct.pack(">h", 3)]


def test_columns(spark):
    from pyspark.sql import functions as F

    raw = spark.createDataFrame([(bytearray(range(256)),)], "raw binary").select(codecs.cp1252(F.col("raw")).alias("t")).first().t
    assert raw == K.cp1252(bytes(range(256)))
    r = spark.sql("SELECT 51545 AS d, 10 AS t, 'ab \t' AS s, '  ' AS b, CAST(7 AS BIGINT) AS lo, 2 AS hi, 1024 AS f, 500 AS rec, -2 AS k").select(
        codecs.timestamp(F.col("d"), F.col("t")).alias("ts"),
        codecs.trim_fixed(F.col("s")).alias("s"),
        codecs.trim_var(F.col("b")).alias("b"),
        codecs.txn(F.col("lo"), F.col("hi"), F.col("f")).alias("txn"),
        codecs.blob_place(F.col("rec"), 4096)[0].alias("page"),
        codecs.key_hex(F.col("k"), 4).alias("key"),
        codecs.scaled(F.col("rec"), -2, "exact").alias("exact"),
    ).first()
    assert (r.ts, r.s, r.b, r.txn, r.page, r.key, r.exact) == (dt.datetime(2000, 1, 2, 0, 0, 0, 1000), "ab", "  ", (2 << 32) + 7, 2, "00000004FFFFFFFE", decimal.Decimal("5.00"))
