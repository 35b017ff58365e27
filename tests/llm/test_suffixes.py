import pytest
from llm_helpers import rows_of

import brute
from stratamend.llm.suffixes import _covers, repeated_bytes

COLS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


@pytest.mark.parametrize("length", [400, 60, 8, 1])
def test_planted(frame, planted, length):
    docs = planted if length >= 60 else [(i, t and t[:300]) for i, t in planted]
    assert rows_of(repeated_bytes(frame(docs), length).select(COLS)) == sorted(brute.suffixes(docs, length), key=repr)


def test_sample(frame, sample):
    assert rows_of(repeated_bytes(frame(sample, False)).select(COLS)) == sorted(brute.suffixes(sample), key=repr)


def test_names_fit_the_window():
    for length in (2, 9, 50, 400, 2000):
        for cover, period, width in _covers(length):
            assert period + width - 1 == length and len({int(a - b) % period for a in cover for b in cover}) == period


def test_kept_bytes_and_spans(frame):
    got = {r.doc_id: r for r in repeated_bytes(frame([(1, "abXYZabc"), (2, "XYZ"), (3, "é")]), 3).collect()}
    assert bytes(got[1].kept) == b"ababc" and got[1].spans == [2, 5] and bytes(got[2].kept) == b"" and bytes(got[3].kept).decode() == "é"


def test_no_rows(frame):
    assert rows_of(repeated_bytes(frame([]))) == []


def test_sql(spark):
    """The SQL gives the operator's rows."""
    import duckdb

    from stratamend.llm.queries import oracle_sql, queries

    sf, name = "/root/testdata/sf0.001", "op8_suffix_difference_cover"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    found = con.sql(oracle_sql()[name])
    got = queries()[name](spark, sf)
    assert found.columns == got.columns == COLS
    assert rows_of(got) == sorted(found.fetchall(), key=repr)


def test_sql_of_planted_rows(planted):
    import duckdb
    import pyarrow as pa

    from stratamend.llm.queries import oracle_sql

    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([i for i, _ in planted], pa.int64()), "text": pa.array([t for _, t in planted], pa.string())}))
    assert sorted(con.sql(oracle_sql()["op8_suffix_difference_cover"]).fetchall(), key=repr) == sorted(brute.suffixes(planted), key=repr)
