import hashlib
import random

import numpy as np
import pytest
from llm_helpers import rows_of

import brute
from stratamend.llm.winnow import contamination, decontaminated, winnowed

COLS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
ITEMS = "item_id long, text string"


@pytest.fixture(scope="module")
def bench(planted):
    r = random.Random(9)
    words = [brute.ITEM.findall((t or "").lower()) for _, t in planted]
    out = [(k, " ".join((w := r.choice([x for x in words if len(x) > 40]))[(a := r.randrange(len(w) - 20)) : a + r.randint(13, 40)])) for k in range(20)]
    return out + [(20, "Two, WORDS!"), (21, "one"), (22, None), (23, "?!"), (24, "tab and odd"), (20, "three short words"), (1, out[0][1])]


@pytest.mark.parametrize("block_bytes", [8 << 20, 400])
def test_planted(spark, frame, planted, bench, block_bytes):
    got = contamination(frame(planted), spark.createDataFrame(bench, ITEMS), block_bytes=block_bytes).select(COLS)
    assert rows_of(got) == sorted(brute.contamination(planted, bench), key=repr)


def test_sample(spark, frame, sample):
    import pyarrow.parquet as pq

    t = pq.read_table("/root/testdata/sf0.001/benchmark.parquet").to_pydict()
    items = list(zip(t["item_id"], t["text"]))
    got = rows_of(contamination(frame(sample, False), spark.createDataFrame(items, ITEMS)).select(COLS))
    assert got == sorted(brute.contamination(sample, items), key=repr) and any(r[-1] for r in got)


def test_winnowing_misses_no_span():
    r = np.random.default_rng(3)
    a = r.integers(0, 50, 400).astype(np.uint64)
    at = set(winnowed(a, 7).tolist())
    assert all(at & set(range(p, p + 7)) for p in range(len(a) - 6))


def test_no_rows(spark, frame, planted):
    none = spark.createDataFrame([], ITEMS)
    assert rows_of(contamination(frame([]), none)) == []
    assert rows_of(contamination(frame(planted), none).select(COLS)) == sorted(brute.contamination(planted, []), key=repr)


@pytest.mark.parametrize("block_bytes", [8 << 20, 30])
def test_items_without_id(spark, frame, block_bytes):
    items = spark.createDataFrame([(None, "one two three"), (None, "four five six"), (7, "seven eight nine"), (8, None)], ITEMS)
    docs = frame([(1, "x one two three"), (2, "one two three four five six seven eight nine"), (3, "clean words"), (4, "seven eight nine")])
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = contamination(docs, items, 3, block_bytes=block_bytes)
    assert rows_of(got.select(COLS)) == [(1, 4, 3, 1, sha(""), True), (2, 9, 9, 2, sha("7"), True), (3, 2, 0, 0, sha(""), False), (4, 3, 3, 1, sha("7"), True)]
    assert {r.doc_id: r["items"] for r in got.collect()} == {1: [None], 2: ["7", None], 3: [], 4: ["7"]}
    assert [r.doc_id for r in decontaminated(docs, items, 3, block_bytes=block_bytes).collect()] == [3]
