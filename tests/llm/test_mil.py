import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import rows_of

from stratamend.llm import kernels as K
from stratamend.llm import mil

SF = "/root/testdata/sf0.01"


def bags(texts):
    buf, offs = K.text_column(pa.array(texts, pa.string()))
    return mil.features(buf, offs)


def test_held_out_accuracy(spark):
    from pyspark.sql import functions as F

    from stratamend.llm.queries import queries

    got = queries()["op3_quality_attention_mil"](spark, SF)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    assert got.count() == docs.count() and got.where("score IS NULL OR score < 0 OR score > 1").isEmpty()
    right = got.join(labels, "doc_id").where("held_out").select(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0]
    assert right >= 0.95


def plain_score(m, x, begin):
    """Gated attention by its formula, bag by bag and passage by passage."""
    out = []
    for i, j in zip(begin, begin[1:]):
        h = [np.tanh(row @ m.p["W"] + m.p["b"]) for row in x[i:j]]
        s = [float((np.tanh(v @ m.p["V"]) * (1 / (1 + np.exp(-(v @ m.p["U"]))))) @ m.p["w"]) for v in h]
        e = [np.exp(y) for y in s]
        z = sum(y / sum(e) * v for y, v in zip(e, h))
        out.append(1 / (1 + np.exp(-float(z @ m.p["o"] + m.p["c"][0]))))
    return np.array(out)


def drawn():
    r = np.random.default_rng(0)
    return r.normal(size=(40, mil.SHAPES + mil.STATS)), np.array([0, 3, 4, 20, 33, 40]), np.array([1, 0, 1, 0, 1], np.float32)


def test_scores_by_the_formula():
    x, begin, _ = drawn()
    m = mil.Model()
    y, a = m.score(x, begin)
    assert np.allclose(y, plain_score(m, x, begin), atol=1e-6) and np.allclose(np.add.reduceat(a, begin[:-1]), 1)


def test_gradient():
    """Slopes agree with differences of the loss, for places of every parameter."""
    x, begin, y = drawn()
    m = mil.Model()
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}

    def loss():
        p = plain_score(m, x, begin)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    slopes, r = m.slopes(x, begin, y), np.random.default_rng(1)
    assert set(slopes) == set(m.p)
    for k, v in m.p.items():
        assert slopes[k].shape == v.shape
        for at in r.choice(v.size, min(v.size, 12), replace=False).tolist():
            was, sides = v.flat[at], []
            for step in (1e-5, -1e-5):
                v.flat[at] = was + step
                sides.append(loss())
            v.flat[at] = was
            assert slopes[k].flat[at] == pytest.approx((sides[0] - sides[1]) / 2e-5, rel=1e-3, abs=1e-6)


def test_fit_lowers_the_loss():
    x, begin, y = drawn()

    def loss(m):
        p = np.clip(m.score(x.astype(np.float32), begin)[0], 1e-6, 1 - 1e-6)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    assert loss(mil.Model().fit(x.astype(np.float32), begin, y, epochs=60, decay=0)) < 0.2 < loss(mil.Model())


def test_features_do_not_depend_on_neighbours():
    texts = ["One two, THREE!! four four", "", None, " \n", "x " * 200, "Éa ß9 ***"]
    x, begin = bags(texts)
    assert np.diff(begin).tolist() == [1, 1, 1, 1, 4, 1]
    for k, t in enumerate(texts):
        assert np.allclose(bags([t])[0], x[begin[k] : begin[k + 1]], atol=1e-6)


def test_long_text_is_read_to_its_end():
    r = np.random.default_rng(1)
    word = lambda: "".join(r.choice(list("abcdefgh"), 5))
    good, bad = [" ".join(word() for _ in range(300)) for _ in range(60)], [" ".join(word().upper() + "!!" for _ in range(300)) for _ in range(60)]
    x, begin = bags(good + bad)
    m = mil.Model().fit(x, begin, np.array([1] * 60 + [0] * 60, np.float32))
    assert m.score(*bags([good[0] + " " + bad[0]]))[0][0] != pytest.approx(m.score(*bags([good[0]]))[0][0], abs=1e-4)


def test_odd_tables(spark, frame, planted):
    labels = spark.createDataFrame([(1, 1), (4, 0), (4, 0), (7, None), (None, 1), (999999, 0)], "doc_id long, quality int")
    got = rows_of(mil.score(frame(planted), mil.fit(frame(planted), labels)).select("doc_id", "n_passages"))
    assert sorted([r[0] for r in got], key=repr) == sorted([i for i, _ in planted], key=repr)
    none = mil.fit(frame(planted), labels.where("false"))
    assert {r.score for r in mil.score(frame(planted), none).collect()} == {0.5}
    assert rows_of(mil.score(frame([]), none)) == []


def test_long_documents_teach_whole(spark, frame, monkeypatch):
    """Every passage of a labelled document is learnt from, however long it is."""
    seen = []
    was = mil.Model.fit
    monkeypatch.setattr(mil.Model, "fit", lambda self, x, begin, labels: (seen.append(np.diff(begin).tolist()), was(self, x, begin, labels, epochs=1))[1])
    docs = frame([(1, "word " * 64 * 300), (2, "other " * 64), (3, "not labelled")])
    mil.fit(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int"), "quality")
    assert [sorted(x) for x in seen] == [[1, 300]]
