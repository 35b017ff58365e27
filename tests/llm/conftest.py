import random

import pytest

DOCS = "doc_id long, text string"


@pytest.fixture(scope="session")
def planted():
    """Documents with copies, near copies, shared passages and every odd text that the contracts name."""
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 6)))
    prose = lambda n: [word() for _ in range(n)]
    passage, docs = prose(120), []
    for _ in range(60):
        w = prose(r.randint(1, 400))
        if r.random() < 0.5:
            p, a = r.randint(0, len(w)), r.randint(0, 60)
            w[p:p] = passage[a : a + r.randint(40, 110)]
        docs.append(" ".join(w))
    base = prose(300)
    for _ in range(25):
        w = list(base)
        for _ in range(r.randint(0, 6)):
            w[r.randrange(len(w))] = word()
        docs.append(" ".join(w).upper() if r.random() < 0.2 else "\n".join(w) if r.random() < 0.2 else " ".join(w))
    docs += [docs[3]] * 5 + [docs[4].upper()] * 2 + ["", None, "", None, " \n\t ", "one", "One", "two words", "three  short words", "\x0b\x0ctab\tand\x1fodd\x00bytes"]
    docs += ["ab " * 900, "ab " * 900 + "c", "x" * 3000, "x" * 399, "x" * 400, "x" * 401, "日本 語 " * 300, "日本 語 " * 299]
    docs += ["Header line\n" + " ".join(prose(20)) + "\n  header LINE \n\n" for _ in range(14)]
    docs += [" ".join(prose(6)) + "\n" + "rare line\n" * 20]
    docs += [" ".join(prose(9000) + base + passage)]
    r.shuffle(docs)
    return [(None if k == 7 else k * 3 + 1, t) for k, t in enumerate(docs)]


@pytest.fixture(scope="session")
def frame(spark):
    def make(rows, extra=True):
        df = spark.createDataFrame(rows, DOCS).repartition(3)
        # columns whose names clash with those that the operators use inside
        return df.selectExpr("*", "'z' AS id", "7 AS chunk", "1.5D AS names", "'q' AS lang", "'s' AS kind", "0 AS n_words", "1L AS score") if extra else df

    return make


@pytest.fixture(scope="session")
def sample():
    """The documents of the smallest driver tables, if they are there."""
    import os

    import pyarrow.parquet as pq

    path = "/root/testdata/sf0.001/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no driver tables")
    t = pq.read_table(path, columns=["doc_id", "text"]).to_pydict()
    return list(zip(t["doc_id"], t["text"]))
