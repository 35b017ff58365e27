import numpy as np
import pytest
from llm_helpers import rows_of

from stratamend.llm import kernels as K
from stratamend.llm.anchors import repeated_windows

import brute

COLS = ["doc_id", "n_words", "n_removed", "kept_sha256"]


def test_covers():
    for q in (2, 3, 5, 7, 11, 13, 17):
        d, v = K.difference_cover(q)
        assert len(d) == q + 1 and v == q * q + q + 1 and K.is_cover(d, v)


def test_word_hashes_do_not_depend_on_place():
    a = np.frombuffer(b"xx one two one", np.uint8)
    s, e, first = K.word_spans(a, np.array([0, 10, 14]), K.PLAIN_WORD)
    h = K.span_hashes(a, s, e)
    assert first.tolist() == [0, 3, 4] and h[1] == h[3] and h[1] != h[2]


@pytest.mark.parametrize("window", [50, 9, 2])
def test_planted(frame, planted, window):
    assert rows_of(repeated_windows(frame(planted), window).select(COLS)) == sorted(brute.substring(planted, window), key=repr)


def test_sample(frame, sample):
    assert rows_of(repeated_windows(frame(sample, False), 50).select(COLS)) == sorted(brute.substring(sample), key=repr)


def test_no_rows_and_repeated_rows(frame):
    assert rows_of(repeated_windows(frame([]))) == []
    same = [(4, "a b c d")] * 3 + [(None, "a b c d")]
    assert rows_of(repeated_windows(frame(same), 3).select(COLS)) == sorted(brute.substring(same, 3), key=repr)


def test_spans_and_text(frame):
    got = {r.doc_id: r for r in repeated_windows(frame([(1, "a b c d e"), (2, "z b c d y")]), 3).collect()}
    assert got[2].spans == [1, 4] and got[2].kept_text == "z y" and got[1].spans == [] and got[1].kept_text == "a b c d e"
