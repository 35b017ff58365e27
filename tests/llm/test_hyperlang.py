import numpy as np
from llm_helpers import rows_of

from stratamend.llm import hyperlang as H

SF = "/root/testdata/sf0.01"


def slow_vector(space, text):
    """The sum over n-grams, one by one."""
    words = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text).split()
    out = np.zeros(space.dimensions)
    for w in words:
        w = f" {w} "
        for k in range(len(w) - 2):
            v = np.ones(space.dimensions)
            for j, c in enumerate(w[k : k + 3]):
                v *= np.roll(space.letter(ord(c)), 2 - j)
            out += v
    return out


def test_vectors_against_the_definition():
    space = H.Space(64)
    texts = ["Hello, wörld", "", "a", "x y  z!", "日本語 text", "😀 ok", "𝔘nicode", "ÉÉ éé", "1 2 3", "one\ntwo"]
    for one, text in zip(space.vectors(texts), texts):
        assert np.allclose(one, slow_vector(space, text)), text


def test_predictions_do_not_depend_on_batches(frame, planted):
    p = H.fit(frame([(1, "the cat and the hat"), (2, "der hund und die katze")]).selectExpr("text", "if(doc_id = 1, 'en', 'de') AS lang"))
    got = {(r.doc_id, r.lang_pred, round(r.score, 5)) for r in H.predict(frame(planted), p).collect()}
    want = set()
    for i, t in planted:
        (lang,), (s,) = p.predict([t or ""])
        want.add((i, lang, round(float(s), 5)))
    assert got == want


def test_held_out_accuracy(spark):
    from pyspark.sql import functions as F

    from stratamend.llm.queries import queries

    got = queries()["op7_language_hyperdimensional"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got.count() == docs.count()
    right = got.join(docs, "doc_id").where("held_out AND lang IS NOT NULL").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.97


def test_odd_tables(frame):
    p = H.Profiles([], np.zeros((0, 64)), H.Space(64))
    assert {(r.lang_pred, r.score) for r in H.predict(frame([(1, "abc"), (None, None)]), p).collect()} == {("und", 0.0)}
    p = H.fit(frame([(1, "abc def"), (1, "abc def"), (2, None), (3, "123")]))  # its lang column holds one language
    got = rows_of(H.predict(frame([(1, "abc"), (1, "abc"), (2, None), (3, "12 -"), (4, "")]), p).select("doc_id", "lang_pred"))
    assert got == [(1, "q"), (1, "q"), (2, "und"), (3, "und"), (4, "und")]
    assert rows_of(H.predict(frame([]), p)) == []
