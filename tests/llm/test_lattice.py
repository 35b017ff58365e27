from collections import Counter

import numpy as np
import pytest
from llm_helpers import rows_of

from stratamend.llm.lattice import MARK, Vocabulary, _One, decode, encode, sample

PIECES = "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def toy():
    pieces = ["a", "b", "c", "▁", "ab", "bc", "abc", "▁a", "▁ab", "ca", "▁▁"]
    return Vocabulary([(300 + k, p, -1.0 - 0.3 * k - 0.05) for k, p in enumerate(pieces)], list(range(3, 259)), 400)


def every_path(v, text):
    """All segmentations and their probabilities, by enumeration."""
    spelt = {b.decode(): (i, w) for b, i, w in zip(v.bytes, v.ids.tolist(), v.weight.tolist())}
    out = {}

    def go(rest, ids, w):
        if not rest:
            out[tuple(ids)] = w
        for n in range(1, v.longest + 1):
            if len(rest) >= n and rest[:n] in spelt:
                i, x = spelt[rest[:n]]
                go(rest[n:], ids + [i], w * x)
        if rest and rest[0] not in spelt:
            go(rest[1:], ids + [3 + b for b in rest[0].encode()], w)

    go(" " + text, [], 1.0)
    total = sum(out.values())
    return {k: w / total for k, w in out.items()}


@pytest.mark.parametrize("text", ["abc", "ab cab", "abéc a", "a  bc"])
def test_samples_follow_the_lattice(toy, text):
    want, n = every_path(toy, text), 4000
    got = sample(toy, [text] * n, list(range(n)), 3)
    first = Counter(tuple(r[0][0].tolist()) for r in got)
    for path, p in want.items():
        assert abs(first[path] / n - p) < 4 * np.sqrt(p * (1 - p) / n) + 1e-3
    for rows in got:
        paths = [tuple(r[0].tolist()) for r in rows]
        assert len(set(paths)) == len(paths) == min(3, len(want)) and set(paths) <= set(want)
        assert all(np.isclose(np.exp(lp), want[p]) for p, (_, lp, _, _) in zip(paths, rows))
        scores = [r[2] for r in rows]
        assert scores == sorted(scores, reverse=True)
    # second paths follow sampling without replacement
    second = Counter(tuple(r[1][0].tolist()) for r in got)
    for path, p in want.items():
        q = sum(x * p / (1 - x) for other, x in want.items() if other != path)
        assert abs(second[path] / n - q) < 4 * np.sqrt(q * (1 - q) / n) + 1e-3
    # p / inclusion is an unbiased weight: the weights of a sample sum to one on average
    assert abs(np.mean([sum(np.exp(lp) / q for _, lp, _, q in rows) for rows in got]) - 1) < 0.05


def test_batches_do_not_matter(toy):
    texts = ["abc abc", "", "ab", "cab  bc a", "zz", "a▁b"]
    whole = sample(toy, texts, [5, 6, 7, 8, 9, 10], 2)
    for k, t in enumerate(texts):
        (alone,) = sample(toy, [t], [5 + k], 2)
        assert [(a.tolist(), b, c) for a, b, c, _ in alone] == [(a.tolist(), b, c) for a, b, c, _ in whole[k]]
        assert all(toy.decode(r[0].tolist()).decode() == t for r in alone)


def test_long_units(toy):
    text = "abc" * 60
    (rows,) = sample(toy, [text], [1], 2)
    assert len(rows) == 2 and all(toy.decode(r[0].tolist()).decode() == text for r in rows)
    lattice = _One(toy, [MARK, *map(ord, text)])
    for (path, log), other in ((lattice.draw(s), lattice.other(lattice.draw(s)[0], s)) for s in range(5)):
        assert path != other[0] and log < 0 and other[1] < 0


def test_public_model(spark, frame, planted):
    v = Vocabulary.load(PIECES)
    got = encode(frame(planted), v, k=2)
    rows = got.collect()
    assert all(r.exact for r in rows)
    count = Counter(r.doc_id for r in rows)
    assert set(count) == {i for i, _ in planted}
    texts = dict(planted)
    assert all(count[i] == (2 if t else 1) or "日本" in t for i, t in texts.items() if i is not None)
    back = decode(got, v).select("doc_id", "decoded").collect()
    assert all(r.decoded == (texts[r.doc_id] or "") for r in back if r.doc_id is not None)
    again = encode(frame(planted).repartition(5), v, k=2)
    assert rows_of(got) == rows_of(again)
    assert rows_of(encode(frame([]), v)) == []
    same = encode(frame([(1, "hello there")] * 3 + [(None, "x y")]), v, k=2).collect()
    assert len({(bytes(r.ids), r.sample) for r in same if r.doc_id == 1}) == 2


def test_all_paths_are_found():
    """Segmentations of small chance are found too, once each, and in the order of sampling without replacement."""
    v = Vocabulary([(300 + k, p, w) for k, (p, w) in enumerate({"▁": -0.1, "abc": -0.1, "ab": -2.3, "c": -0.1, "a": -4.6, "bc": -0.1, "b": -4.6}.items())], list(range(3, 259)), 400)
    want = every_path(v, "abc")
    assert len(want) == 4 and min(want.values()) < 1e-3
    for k in (4, 6):
        for rows in sample(v, ["abc"] * 300, list(range(300)), k):
            assert {tuple(r[0].tolist()) for r in rows} == set(want) and len(rows) == 4
            assert [r[2] for r in rows] == sorted((r[2] for r in rows), reverse=True) and all(r[3] == 1 for r in rows)
    n = 4000
    third = Counter(tuple(rows[2][0].tolist()) for rows in sample(v, ["abc"] * n, list(range(n)), 3))
    for path, p in want.items():
        q = sum(x * y / (1 - x) * p / (1 - x - y) for a, x in want.items() for b, y in want.items() if len({a, b, path}) == 3)
        assert abs(third[path] / n - q) < 4 * np.sqrt(q * (1 - q) / n) + 1e-3


def test_small_weights_are_kept():
    """Scores of any size count as they are, also where a product of weights leaves a double's range."""
    v = Vocabulary([(300, "▁", -0.5), (301, "a", -13.5), (302, "b", -16.25), (303, "ab", -28.5), (304, "▁a", -15.25)], list(range(3, 259)), 400)
    want = every_path(v, "ab")
    assert len(want) == 3 and 0 < v.long < 48
    for rows in sample(v, ["ab"] * 50, list(range(50)), 3):
        assert {tuple(r[0].tolist()): pytest.approx(np.exp(r[1])) for r in rows} == want
    v = Vocabulary([(300, "▁", -900.5), (301, "b", -900.25), (302, "▁b", -1800.25)], list(range(3, 259)), 400)
    want = {(302,): 1 / (1 + np.exp(-0.5)), (300, 301): 1 / (1 + np.exp(0.5))}
    for rows in sample(v, ["b"] * 50, list(range(50)), 2):
        assert {tuple(r[0].tolist()): pytest.approx(np.exp(r[1])) for r in rows} == want
