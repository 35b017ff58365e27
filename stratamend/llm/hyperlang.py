"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1, drawn from its code point.  An
n-gram of letters is the product of its letters' vectors, each permuted once
more than the next; a text is the sum of its n-grams' vectors, and so is a
language.  A text's language is the prototype with the largest cosine.

Summing counts first and multiplying once by the n-grams' vectors gives the
same sums.  Fitting is one pass whose partial sums are combined before the
shuffle (languages x dimensions rows arrive at the driver, whatever the
input); predicting is one pass without a shuffle.

Rows: null text, and text without letters, is ``und`` with score 0.  Rows are
predicted one by one, so repeated rows and null ids keep their place.  Without
any labelled text every text is ``und``.  Of equal cosines, the language that
sorts first wins.  An empty table gives an empty result.  Extra columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K

DIMENSIONS, N = 512, 3
RESULT = "doc_id long, lang_pred string, score double"
_BLANK = 32


class Space:
    """Letter and n-gram vectors, made as they are met."""

    def __init__(self, dimensions: int = DIMENSIONS, n: int = N):
        self.dimensions, self.n = dimensions, n
        self.letters: dict[int, np.ndarray] = {}
        self.grams: dict[tuple, np.ndarray] = {}
        lower = np.arange(1 << 16, dtype=np.uint32)
        for c in range(1 << 16):
            ch = chr(c)
            lower[c] = (ord(ch.lower()) if len(ch.lower()) == 1 else c) if ch.isalpha() else _BLANK
        self.lower = lower

    def __getstate__(self):
        return {"dimensions": self.dimensions, "n": self.n}

    def __setstate__(self, state):
        self.__init__(**state)

    def letter(self, c: int) -> np.ndarray:
        if c not in self.letters:
            self.letters[c] = (np.random.default_rng(c).integers(0, 2, self.dimensions) * 2 - 1).astype(np.float32)
        return self.letters[c]

    def gram(self, letters: tuple) -> np.ndarray:
        if letters not in self.grams:
            if len(self.grams) > 200_000:  # keeps memory bounded over many scripts
                self.grams.clear()
            v = np.ones(self.dimensions, np.float32)
            for k, c in enumerate(letters):
                v = v * np.roll(self.letter(c), self.n - 1 - k)
            self.grams[letters] = v
        return self.grams[letters]

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(texts x n-grams met, vectors of those n-grams)."""
        sizes = np.array([len(t) + 1 for t in texts])
        cps = np.frombuffer((" " + " ".join(texts) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
        low = np.where(cps < 1 << 16, self.lower[np.minimum(cps, 0xFFFF)], cps)
        for c in np.unique(cps[cps >= 1 << 16]).tolist():
            ch = chr(c)
            low[cps == c] = ord(ch.lower()) if ch.isalpha() else _BLANK
        row = np.concatenate([[0], np.repeat(np.arange(len(texts)), sizes)])
        keep = np.ones(len(low), bool)
        keep[1:] = (low[1:] != _BLANK) | (low[:-1] != _BLANK)
        low, row = low[keep], row[keep]
        n, m = self.n, len(low) - self.n + 1
        none = np.zeros((len(texts), 0), np.float32)
        if m <= 0:
            return none, np.zeros((0, self.dimensions), np.float32)
        # n-grams with a blank inside join words: left out
        ok = np.ones(m, bool)
        for k in range(1, n - 1):
            ok &= low[k : m + k] != _BLANK
        at = np.flatnonzero(ok)
        if not len(at):
            return none, np.zeros((0, self.dimensions), np.float32)
        alphabet, code = np.unique(low, return_inverse=True)
        a = len(alphabet)
        name = np.zeros(len(at), np.int64)
        for k in range(n):
            name = name * a + code[at + k]
        if a**n <= 1 << 22:
            present = np.flatnonzero(np.bincount(name, minlength=a**n))
            place = np.zeros(a**n, np.int64)
            place[present] = np.arange(len(present))
            name = place[name]
        else:
            present, name = np.unique(name, return_inverse=True)
        wide = len(present)
        table = np.bincount(row[at + 1] * wide + name, minlength=len(texts) * wide).reshape(len(texts), wide).astype(np.float32)
        parts = [alphabet[present // a ** (n - 1 - k) % a].tolist() for k in range(n)]
        return table, np.stack([self.gram(x) for x in zip(*parts)])

    def vectors(self, texts: list[str]) -> np.ndarray:
        table, grams = self.counts(texts)
        return table @ grams if table.shape[1] else np.zeros((len(texts), self.dimensions), np.float32)


def _text_slices(column):
    """Lists of texts of bounded size and count."""
    _, offs = K.text_column(column)
    for i, j in K.row_slices(offs, 1 << 19):
        for k in range(i, j, 256):
            yield k, min(j, k + 256), [t or "" for t in column.slice(k, min(j, k + 256) - k).to_pylist()]


def _sums(space: Space):
    def f(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for i, j, texts in _text_slices(batch.column(1)):
                table, grams = space.counts(texts)
                if not table.shape[1]:
                    continue
                for lang in set(langs[i:j]):
                    own = np.array([x == lang for x in langs[i:j]])
                    sums[lang] = sums.get(lang, 0) + (table[own].sum(0) @ grams).astype(np.float64)
        for lang, v in sums.items():
            yield pa.record_batch({"lang": pa.array([lang] * len(v)), "dim": pa.array(np.arange(len(v)), pa.int32()), "value": pa.array(v)})

    return f


class Profiles:
    def __init__(self, langs: list[str], vectors: np.ndarray, space: Space):
        self.langs, self.space = langs, space
        self.vectors = (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)).astype(np.float32)

    def predict(self, texts: list[str]) -> tuple[list, np.ndarray]:
        v = self.space.vectors(texts)
        norm = np.linalg.norm(v, axis=1)
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        cos = (v @ self.vectors.T) / np.maximum(norm, 1e-9)[:, None]
        best = cos.argmax(1)
        has = norm > 0
        score = np.where(has, np.clip(cos[np.arange(len(texts)), best], 0, 1), 0.0)
        return [self.langs[b] if h else "und" for b, h in zip(best.tolist(), has.tolist())], score.astype(np.float64)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS, n: int = N) -> Profiles:
    """Prototypes from all rows with a language."""
    space = Space(dimensions, n)
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    # whole numbers, so the sums don't depend on their order
    sums = rows.mapInArrow(_sums(space), "lang string, dim int, value double").groupBy("lang", "dim").agg(F.sum("value").alias("value")).collect()
    langs = sorted({r.lang for r in sums})
    place, table = {x: k for k, x in enumerate(langs)}, np.zeros((len(langs), dimensions))
    for r in sums:
        table[place[r.lang], r.dim] = r.value
    return Profiles(langs, table, space)


def predict(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    def f(batches):
        for batch in batches:
            for i, j, texts in _text_slices(batch.column(1)):
                langs, score = profiles.predict(texts)
                yield pa.record_batch({"doc_id": batch.column(0).slice(i, j - i), "lang_pred": pa.array(langs, pa.string()), "score": pa.array(score, pa.float64())})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(f, RESULT)
