import pytest
from llm_helpers import rows_of

import brute
import corpus_pipeline as P
from stratamend.llm import blocknames, mil, ngram_join, winnow

SF = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    one = P.quality(spark, docs, SF)
    model = mil.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"), "quality")
    assert ids(one) == ids(mil.score(docs, model).where("score >= 0.3")) and one.columns == columns
    left = [(r.doc_id, r.text) for r in one.collect()]
    two = P.exact(spark, one, SF)
    assert two.columns == columns and ids(two) == sorted(i for i, _, _, kept, _ in brute.exact(left) if kept)
    left = [(r.doc_id, r.text) for r in two.collect()]
    three = P.near(spark, two, SF)
    assert three.columns == columns and ids(three) == sorted(i for i, _, c in brute.near(left, 80, 5) if i == c)
    left = [(r.doc_id, r.text) for r in three.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    four = P.decontaminate(spark, three, SF)
    bad = {r[0] for r in brute.contamination(left, items) if r[-1]}
    assert four.columns == columns and ids(four) == sorted(i for i, _ in left if i not in bad) and bad
    five = P.encode(spark, four, SF).collect()
    assert sorted({r.doc_id for r in five}) == ids(four) and all(r.exact for r in five)
    whole = P.run(spark, SF).collect()
    assert sorted((r.doc_id, r.sample, bytes(r.ids)) for r in whole) == sorted((r.doc_id, r.sample, bytes(r.ids)) for r in five)


def test_rows_come_back_as_they_are(frame):
    docs = [(5, "A b"), (5, "a B"), (6, "a b"), (6, "other"), (None, "a b"), (None, None), (None, None), (8, ""), (9, "z z"), (9, "z z")]
    got = blocknames.one_of_each(frame(docs))
    assert got.columns == frame(docs).columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted([(6, "a b"), (6, "other"), (8, ""), (9, "z z")], key=repr)
    near = ngram_join.one_of_each(frame([(3, "a b c d"), (2, "A b c d"), (None, "a b c d"), (None, "x"), (None, "x"), (4, ""), (5, None)]), 80, 2)
    assert sorted(((r.doc_id, r.text) for r in near.collect()), key=repr) == sorted([(2, "A b c d"), (None, "x"), (4, ""), (5, None)], key=repr)


@pytest.mark.parametrize("block_bytes", [8 << 20, 30])
def test_decontaminated_rows(spark, frame, block_bytes):
    items = spark.createDataFrame([(1, "one two three"), (2, "four five six"), (3, "seven eight nine ten")], "item_id long, text string")
    docs = [(1, "x one two three"), (1, "clean words"), (None, "four, FIVE six"), (None, None), (3, ""), (4, "w " * 100 + "one two three")]
    got = winnow.decontaminated(frame(docs), items, 3, block_bytes=block_bytes)
    assert got.columns == frame(docs).columns
    assert rows_of(got.select("doc_id", "text")) == sorted([(1, "clean words"), (None, None), (3, ""), (4, docs[5][1])], key=repr)


def test_stages_take_empty_tables(spark, frame):
    docs = frame([], False).selectExpr("*", "'x' AS lang", "'s' AS source", "0L AS n_chars")
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and docs.collect() == []
    assert P.encode(spark, docs, SF).collect() == []
