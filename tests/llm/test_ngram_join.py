import random

import numpy as np
import pytest
from llm_helpers import rows_of

import brute
from stratamend.llm import ngram_join as J
from stratamend.llm.components import components

COLS = ["doc_id", "n_shingles", "component_id"]


@pytest.mark.parametrize("percent", [90, 60])
def test_planted(frame, planted, percent):
    assert rows_of(J.jaccard_components(frame(planted), percent).select(COLS)) == sorted(brute.near(planted, percent), key=repr)


def test_chains_and_tiles(frame, monkeypatch):
    """Chains whose ends don't link, in blocks larger than a tile."""
    r = random.Random(2)
    word = lambda: "w%d" % r.randrange(10**9)
    docs, base = [], [word() for _ in range(150)]
    for _ in range(60):
        docs.append(" ".join(base))
        base = list(base)
        base[r.randrange(len(base))] = word()
        base = base if r.random() < 0.9 else [word() if r.random() < 0.1 else x for x in base]
    docs = [(i + 1, t) for i, t in enumerate(r.sample(docs, len(docs)))]
    monkeypatch.setattr(J, "TILE", 4)
    assert rows_of(J.jaccard_components(frame(docs)).select(COLS)) == sorted(brute.near(docs), key=repr)


@pytest.mark.parametrize("bits", [32, 7])
def test_hot_block(frame, monkeypatch, bits):
    """5000 texts around one passage, some linked: a forest comes out, not all pairs; with few bits clashes are found and mended."""
    r = random.Random(3)
    word = lambda: "w%d" % r.randrange(10**9)
    passage, docs = [word() for _ in range(40)], []
    for k in range(5000 if bits == 32 else 400):
        own = [word() for _ in range(r.choice((3, 6, 14)))]
        docs.append((k + 1, " ".join(passage + own)))
    docs += [(10**6 + k, docs[k][1] + " more") for k in range(50)]
    monkeypatch.setattr(J, "BITS", bits)
    monkeypatch.setattr(J, "TILE", 128)
    made, linked = [], J._linked
    monkeypatch.setattr(J, "_linked", lambda pairs, cand, percent: made.append(pairs.count()) or linked(pairs, cand, percent))
    got = rows_of(J.jaccard_components(frame(docs, False)).select(COLS))
    if bits == 32:
        assert sum(made) < 2 * len(docs)
        # what is linked among some documents is linked among all
        comp, ties = {i: c for i, _, c in got}, {}
        for i, _, c in brute.near(docs[:200] + docs[5000:]):
            ties.setdefault(c, set()).add(comp[i])
        assert all(len(x) == 1 for x in ties.values())
    else:
        assert got == sorted(brute.near(docs), key=repr)
        assert len(made) > 2


def test_rows_that_share_an_id(frame):
    """Each row is a document of its own."""
    rows = [(1, "a b c d e f g h"), (1, "other words all of them new"), (2, "other words all of them new"), (2, "a b c d e f g h"), (None, "a b c d e f g h"), (3, "x")] * 2
    assert rows_of(J.jaccard_components(frame(rows)).select(COLS)) == sorted(brute.near(rows), key=repr)


def test_sample(frame, sample):
    assert rows_of(J.jaccard_components(frame(sample, False)).select(COLS)) == sorted(brute.near(sample), key=repr)


def test_marks_miss_no_link():
    r, levels = np.random.default_rng(4), J.Levels(90)
    for size in [*range(9, 60), 200, 900]:
        a = np.unique(r.integers(0, 1 << 63, size).astype(np.uint64))
        for drop in range(0, size // 10 + 1):
            b = a[drop:]
            if 100 * len(b) >= 90 * len(a):
                c = np.concatenate([b, r.integers(0, 1 << 63, max(0, len(b) * 100 // 90 - len(a))).astype(np.uint64)])
                both = len(np.intersect1d(a, c))
                if len(a) != both and 100 * both >= 90 * (len(a) + len(c) - both):
                    assert len(np.intersect1d(J.marks_of(a, levels), J.marks_of(np.unique(c), levels)))


def test_tree_is_exact():
    r = np.random.default_rng(5)
    points = r.integers(0, 12, (700, 8))
    tree = J.RTree(points)
    for p in points[:60]:
        want = np.flatnonzero(np.minimum(points, p).sum(1) >= J.enough(p.sum(), points.sum(1), 80))
        assert sorted(tree.search(p, 80)) == want.tolist()


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 103), (103, 101), (7, 7), (500, 499)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 1 for i in range(2, 61)}, 101: 100, 103: 100, 500: 499}


def test_no_rows(frame):
    assert rows_of(J.jaccard_components(frame([]))) == []


def test_texts_that_share_an_id_are_judged_one_by_one(frame):
    """Each text of an id stays, or not, by its own component, whichever row comes first."""
    rows = [(1, "a b c d e"), (2, "A B c d e"), (2, "quite another text here"), (2, "quite another text here"), (6, "a b c d e"), (6, "one more of its own"), (None, "one more of its own"), (None, "p q r s"), (None, "p q r s"), (7, ""), (7, None)]
    want = [(1, "a b c d e"), (2, "quite another text here"), (6, "one more of its own"), (None, "p q r s"), (7, ""), (7, None)]
    for some in (rows, rows[::-1]):
        docs = frame(some)
        got = J.one_of_each(docs, 80, 2)
        assert got.columns == docs.columns
        assert rows_of(got.select("doc_id", "text")) == sorted(want, key=repr)
