import numpy as np
from llm_helpers import rows_of

import brute
from stratamend.llm.linefilter import Cuckoo, LineIndex, common_lines_dropped

COLS = ["doc_id", "n_lines", "n_dropped", "kept_sha256"]


def test_planted(frame, planted):
    for n in (10, 2):
        assert rows_of(common_lines_dropped(frame(planted), n).select(COLS)) == sorted(brute.line_dedup(planted, n), key=repr)


def test_sample(frame, sample):
    assert rows_of(common_lines_dropped(frame(sample, False)).select(COLS)) == sorted(brute.line_dedup(sample), key=repr)


def test_cuckoo():
    r = np.random.default_rng(1)
    a, b = r.integers(0, 1 << 63, 3000).astype(np.uint64), r.integers(0, 1 << 63, 3000).astype(np.uint64)
    f = Cuckoo.of(a, b)
    assert f.holds(a, b).all()
    for x in zip(*f.places(a[:1500], b[:1500])):
        assert f.delete(*x)
    assert f.holds(a[1500:], b[1500:]).all() and f.holds(a[:1500], b[:1500]).mean() < 0.01
    same = Cuckoo.sized(4)
    before = same.table.copy()
    while same.insert(1, 9):
        before = same.table.copy()
    assert (same.table == before).all()  # a failed insertion leaves no trace


def test_reversible(spark, frame):
    old = [(i, f"alpha\nbeta {i % 3}\nown {i}") for i in range(9)]
    new = [(100 + i, f" ALPHA \nbeta {i % 3}\ngamma") for i in range(6)]
    one = LineIndex(spark, 3, 5).insert(frame(old))
    two = one.insert(frame(new))
    back = two.delete(frame(new))
    state = lambda x: rows_of(x.refs.select("a", "b", "n"))
    assert state(back) == state(one) and state(two) != state(one)
    for index, docs in ((one, old), (two, old + new), (back, old)):
        assert rows_of(index.apply(frame(docs)).select(COLS)) == sorted(brute.line_dedup(docs, 3), key=repr)
    common = {(r.a, r.b) for r in back.common().collect()}
    held = {r.shard: Cuckoo.load(r.filter) for r in back.filters.collect()}
    for r in back.refs.collect():
        if (r.a, r.b) in common:
            assert held[r.shard].holds(np.array([r.a]).view(np.uint64), np.array([r.b]).view(np.uint64))[0]
    assert rows_of(back.delete(frame(old)).refs) == []


def test_no_rows(frame):
    assert rows_of(common_lines_dropped(frame([]))) == []
