import numpy as np
import pytest
import public_tokenizers as P

from stratamend.llm.trainorder import Feistel, Tokenizer, read_from, training_order, write_shards


@pytest.fixture(scope="module")
def tok():
    return Tokenizer(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 17, 64, 1000, 4097])
def test_permutation(n):
    for key in (0, 1, 99):
        f = Feistel(n, key)
        slots = f.slot(np.arange(n))
        assert sorted(slots.tolist()) == list(range(n)) and f.number(slots).tolist() == list(range(n))
    if n > 60:
        assert (Feistel(n, 1).slot(np.arange(n)) != Feistel(n, 2).slot(np.arange(n))).mean() > 0.9


def brute(docs, tok, length):
    enc, rows = tok.encoder(), []
    for i, t in docs:
        ids = enc.encode_ordinary(t or "")
        rows += [(i, p // length, len(ids[p : p + length]), np.array(ids[p : p + length] + [tok.pad] * (length - len(ids[p : p + length])), np.uint16).tobytes()) for p in range(0, len(ids), length)]
    return rows


@pytest.mark.parametrize("length", [16, 1024])
def test_against_brute_force(frame, planted, tok, length):
    docs = [d for d in planted if d[0] is not None]
    got = training_order(frame(docs), tok, 5, length, 8).collect()
    want = brute(docs, tok, length)
    assert sorted((r.doc_id, r.part, r.n_tokens, bytes(r.tokens)) for r in got) == sorted(want)
    # the slots are the permutation of a numbering in which a document's sequences follow one another
    assert sorted(r.slot for r in got) == list(range(len(want))) and all(r.shard == r.slot // 8 for r in got)
    number = {(r.doc_id, r.part): int(n) for r, n in zip(got, Feistel(len(want), 5).number([r.slot for r in got]))}
    assert all(n == number[i, 0] + p for (i, p), n in number.items())


def test_round_trip_and_resume(spark, frame, planted, tok, tmp_path):
    length, enc = 16, tok.encoder()
    rows = training_order(frame(planted), tok, 5, length, 8)
    write_shards(rows, str(tmp_path / "s"))
    n = rows.count()
    assert [r.slot for r in read_from(spark, str(tmp_path / "s"), 0, n, 8).collect()] == list(range(n))
    assert [r.slot for r in read_from(spark, str(tmp_path / "s"), 13, 21, 8).collect()] == list(range(13, 34))
    back = {}
    for r in rows.orderBy("doc_id", "part").collect():
        back.setdefault(r.doc_id, []).extend(np.frombuffer(r.tokens, np.uint16)[: r.n_tokens].tolist())
    assert all(enc.decode(back[i]) == t for i, t in planted if t and i is not None)


def test_odd_tables(frame, tok):
    assert training_order(frame([]), tok, 1).collect() == []
    assert training_order(frame([(1, None), (2, "")]), tok, 1).collect() == []
    got = training_order(frame([(3, "a b c")] * 4 + [(3, "other text here"), (None, "x"), (None, "x"), (None, "y")]), tok, 1, 2, 3).collect()
    assert sorted(r.slot for r in got) == list(range(len(got))) and len(got) == 4 * 2 + 2 + 3
