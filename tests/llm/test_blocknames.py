import pyarrow as pa
import pytest
from llm_helpers import rows_of

import brute
from stratamend.llm import blocknames
from stratamend.llm.blocknames import exact_groups


@pytest.mark.parametrize("block", [4096, 5])
def test_planted(frame, planted, block):
    got = rows_of(exact_groups(frame(planted), block=block).where("doc_id IS NOT NULL").select("doc_id", "group_size", "kept", "text_sha256"))
    want = [(i, n, k, s) for i, _, n, k, s in brute.exact([(-1 if i is None else i, t) for i, t in planted]) if i != -1]
    assert got == sorted(want, key=repr)


def test_sample(frame, sample):
    assert rows_of(exact_groups(frame(sample, False))) == sorted(brute.exact(sample), key=repr)


def test_ties_and_nulls(frame):
    got = exact_groups(frame([(5, "A"), (5, "a"), (None, "a"), (None, "B"), (2, None), (3, "")])).collect()
    assert {(r.doc_id, r.keep_id, r.group_size) for r in got} == {(5, 5, 3), (None, 5, 3), (None, None, 1), (2, 3, 2), (3, 3, 2)}
    assert sum(r.kept for r in got) == 3


def test_no_rows(frame):
    assert rows_of(exact_groups(frame([]))) == []


def test_rows_of_late_partitions(monkeypatch):
    """Rows of any partition that Spark can number have a number of their own."""
    rows = []
    for part in (0, 1, 2047, 2048, 1 << 24, (1 << 31) - 1):
        monkeypatch.setattr(blocknames, "TaskContext", type("Task", (), {"get": classmethod(lambda c, part=part: type("One", (), {"partitionId": lambda _: part})())}))
        monkeypatch.setattr(blocknames, "CHUNK", 8)
        batches = [pa.record_batch({"doc_id": pa.array([1, 2, 3]), "text": pa.array(["aaaa", "bbbb", "cccc"]), "tag": pa.array([0, 0, 0])})] * 2
        for out in blocknames._documents(4096)(iter(batches)):
            body = out.column("block")[out.num_rows - 1].as_py()
            rows += pa.ipc.open_stream(body).read_all().column("row").to_pylist()
    assert len(set(rows)) == len(rows) == 36 and min(rows) >= 0
