"""Quality classifier: gated-attention multiple-instance learning.

A document is a bag of passages of ``WORDS`` words.  Each passage is described
by hashed word shapes and a few shares (case, marks, repetition), encoded by a
small network, and weighted by gated attention learnt from document labels
alone; the score is that of the weighted sum.  Scoring is one pass over the
documents without a shuffle; the model (some kB) travels with the tasks.

Fitting takes at most ``FIT_ROWS`` labelled documents, those with the least
hash of their id (a parameter of ``fit``), and every passage of these; the
driver holds 152 bytes for each passage.  Scoring reads every word.

Rows: null and empty text, and text without words, is one empty passage and
gets a score too.  Rows are scored one by one, so repeated rows and null ids
keep their place; labels of documents that don't exist, null labels and null
ids teach nothing.  Without labels of both kinds every score is the share of
label 1 (one half without any).  An empty table gives an empty result.  Extra
columns are ignored, and no column but the text enters a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K

WORDS, SHAPES, STATS = 64, 64, 12
FIT_ROWS = 4000
RESULT = "doc_id long, score double, n_passages int, top_passage int, top_weight double"

_CLASS = np.zeros(256, np.uint8)  # a symbol's class: marks stand for themselves
_CLASS[:] = np.arange(256)
_CLASS[ord("a") : ord("z") + 1] = ord("a")
_CLASS[ord("A") : ord("Z") + 1] = ord("A")
_CLASS[ord("0") : ord("9") + 1] = ord("0")
_CLASS[0x80:] = 0x80
_MARK = np.zeros(256, bool)
_MARK[0x21:0x7F] = True
_MARK[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
#: Second bytes of the upper-case letters that follow 0xC3 in UTF-8.
_UPPER2 = np.zeros(256, bool)
_UPPER2[0x80:0x9F] = True


def _mean(values: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values.astype(np.float64), at) / n


def features(buf: np.ndarray, offs: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(passages x features, first passage of each row with the total)."""
    starts, ends, first = K.word_spans(buf, offs, K.PLAIN_WORD)
    count = np.diff(first)
    bags = np.maximum(1, -(-count // words))
    begin = np.concatenate([[0], np.cumsum(bags)])
    out = np.zeros((begin[-1], SHAPES + STATS), np.float32)
    if not len(starts):
        out[:, -1] = 1
        return out, begin
    row = np.repeat(np.arange(len(count)), count)
    bag = begin[row] + (np.arange(len(starts)) - first[row]) // words
    at = np.flatnonzero(np.concatenate([[True], bag[1:] != bag[:-1]]))
    which, n = bag[at], np.diff(np.append(at, len(bag)))
    # shapes: runs of one class become one symbol
    kind = _CLASS[buf]
    new = np.ones(len(buf), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[starts] = True
    place = np.concatenate([[0], np.cumsum(new)])
    shape = (K.span_hashes(kind[new], place[starts], place[ends]) % np.uint64(SHAPES)).astype(np.int64)
    out[:, :SHAPES] = np.bincount(bag * SHAPES + shape, minlength=begin[-1] * SHAPES).reshape(-1, SHAPES)
    out[which, :SHAPES] /= n[:, None]
    low = K.lower(buf)
    h = K.span_hashes(low, starts, ends)
    size = ends - starts
    sums = lambda m: (c := np.concatenate([[0], np.cumsum(m)]))[ends] - c[starts]
    upper = (kind == ord("A")).astype(np.int32)
    upper[1:] += (buf[:-1] == 0xC3) & _UPPER2[buf[1:]]
    order = np.lexsort((np.arange(len(h)), h, bag))
    fresh = np.ones(len(h), bool)
    fresh[order[1:]] = (h[order[1:]] != h[order[:-1]]) | (bag[order[1:]] != bag[order[:-1]])
    order = np.lexsort((np.arange(len(h)), h, row))
    early = np.zeros(len(h), bool)
    early[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
    grams = K.word_windows(h, 3) if len(h) > 2 else np.zeros(0, np.uint64)
    grow = row[: len(grams)]
    order = np.lexsort((np.arange(len(grams)), grams, grow))
    seen = np.zeros(len(h), bool)
    seen[order[1:]] = (grams[order[1:]] == grams[order[:-1]]) & (grow[order[1:]] == grow[order[:-1]])
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    letters = np.maximum(size, 1)
    stats = (
        np.log1p(n) / 4,
        _mean(np.minimum(size, 40), at, n) / 10,
        _mean(sums(upper) / letters, at, n),
        _mean(sums(kind == ord("0")) / letters, at, n),
        _mean(sums(_MARK[buf]) / letters, at, n),
        _mean(sums(kind == 0x80) / letters, at, n),
        _mean(fresh, at, n),
        _mean(same, at, n),
        _mean(seen, at, n),
        _mean(sums(_MARK[buf]) == size, at, n),
        _mean(early, at, n),
    )
    for k, x in enumerate(stats):
        out[which, SHAPES + k] = x
    empty = np.ones(begin[-1], bool)
    empty[which] = False
    out[empty, -1] = 1
    return out, begin


class Model:
    """Encoder, gated attention and score; ``fit`` is full-batch-free Adam over bags."""

    def __init__(self, hidden: int = 24, gate: int = 12, seed: int = 7):
        r, d = np.random.default_rng(seed), SHAPES + STATS
        put = lambda *s: r.normal(0, 1 / np.sqrt(s[0]), s).astype(np.float32)
        self.p = {"W": put(d, hidden), "b": np.zeros(hidden, np.float32), "V": put(hidden, gate), "U": put(hidden, gate), "w": put(gate), "o": put(hidden), "c": np.zeros(1, np.float32)}
        self.mean, self.std = np.zeros(d, np.float32), np.ones(d, np.float32)
        self.constant: float | None = None

    def _forward(self, x: np.ndarray, begin: np.ndarray):
        p = self.p
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        s = (t * g) @ p["w"]
        at, bag = begin[:-1], np.repeat(np.arange(len(begin) - 1), np.diff(begin))
        e = np.exp(s - np.maximum.reduceat(s, at)[bag])
        a = e / np.add.reduceat(e, at)[bag]
        z = np.add.reduceat(a[:, None] * h, at, axis=0)
        y = 1 / (1 + np.exp(-np.clip(z @ p["o"] + p["c"], -30, 30)))
        return h, t, g, a, z, y, bag, at

    def score(self, x: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of the bags and attention weights of the passages."""
        if self.constant is not None:
            return np.full(len(begin) - 1, self.constant), (1 / np.repeat(np.diff(begin), np.diff(begin)))
        _, _, _, a, _, y, _, _ = self._forward((x - self.mean) / self.std, begin)
        return y.astype(np.float64), a

    def slopes(self, x: np.ndarray, begin: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Slopes of the mean log loss of these bags, whose features are scaled already."""
        p = self.p
        h, t, g, a, z, y, bag, at = self._forward(x, begin)
        d = ((y - labels) / len(labels)).astype(np.float32)
        grad = {"o": z.T @ d, "c": d.sum(keepdims=True)}
        dz = (d[:, None] * p["o"])[bag]
        da = (h * dz).sum(1)
        ds = a * (da - np.add.reduceat(a * da, at)[bag])
        grad["w"] = (t * g).T @ ds
        dg = ds[:, None] * p["w"]
        dt, du = dg * g * (1 - t * t), dg * t * g * (1 - g)
        grad["V"], grad["U"] = h.T @ dt, h.T @ du
        dh = (a[:, None] * dz + dt @ p["V"].T + du @ p["U"].T) * (1 - h * h)
        return grad | {"W": x.T @ dh, "b": dh.sum(0)}

    def fit(self, x: np.ndarray, begin: np.ndarray, labels: np.ndarray, epochs: int = 30, batch: int = 128, rate: float = 0.01, decay: float = 1e-4, seed: int = 7) -> Model:
        if not len(labels) or labels.min() == labels.max():
            self.constant = float(labels.mean()) if len(labels) else 0.5
            return self
        self.mean, self.std = x.mean(0), np.maximum(x.std(0), 1e-2)
        x, p, r = (x - self.mean) / self.std, self.p, np.random.default_rng(seed)
        m, v, step = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
        for epoch in range(epochs):
            order = r.permutation(len(labels))
            for i in range(0, len(order), batch):
                bags = order[i : i + batch]
                size = (begin[1:] - begin[:-1])[bags]
                rows = np.concatenate([np.arange(begin[k], begin[k + 1]) for k in bags])
                grad = self.slopes(x[rows], np.concatenate([[0], np.cumsum(size)]), labels[bags])
                step += 1
                pace = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                for k in p:
                    q = grad[k] + decay * p[k]
                    m[k] = 0.9 * m[k] + 0.1 * q
                    v[k] = 0.999 * v[k] + 0.001 * q * q
                    p[k] -= (pace * m[k] / (np.sqrt(v[k]) + 1e-8)).astype(np.float32)
        return self


def _bags(batches):
    """(label, passages x features) of the rows to fit on."""
    for batch in batches:
        buf, offs = K.text_column(batch.column(1))
        for i, j in K.row_slices(offs, 1 << 19):
            x, begin = features(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
            bags = [x[a:b] for a, b in zip(begin, begin[1:])]
            yield pa.record_batch({"label": batch.column(0).slice(i, j - i), "bag": pa.array([b.astype(np.float16).tobytes() for b in bags], pa.binary())})


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text: str = "text", rows: int = FIT_ROWS) -> Model:
    """A model from at most ``rows`` of the labelled documents."""
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("int").alias("label")).where("id IS NOT NULL AND label IS NOT NULL")
    some = known.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(rows)
    # at most ``rows`` rows of two numbers
    body = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text")).join(F.broadcast(some), "id")
    got = body.select("label", "text", "id").mapInArrow(lambda it: _bags(b.select(["label", "text"]) for b in it), "label int, bag binary").collect()
    got.sort(key=lambda r: (r.label, bytes(r.bag)))  # the order of rows must not matter
    x = [np.frombuffer(r.bag, np.float16).astype(np.float32).reshape(-1, SHAPES + STATS) for r in got]
    begin = np.concatenate([[0], np.cumsum([len(a) for a in x])]).astype(np.int64)
    return Model().fit(np.concatenate(x) if x else np.zeros((0, SHAPES + STATS), np.float32), begin, np.array([r.label > 0 for r in got], np.float32))


def _scored(model: Model):
    def f(batches):
        for batch in batches:
            buf, offs = K.text_column(batch.column(1))
            for i, j in K.row_slices(offs, 1 << 19):
                x, begin = features(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                y, a = model.score(x, begin)
                weight = np.maximum.reduceat(a, begin[:-1])
                at = np.flatnonzero(a >= np.repeat(weight, np.diff(begin)))
                bag = np.searchsorted(begin, at, "right") - 1
                top = np.zeros(j - i, np.int64)
                top[bag[::-1]] = (at - begin[bag])[::-1]
                yield pa.record_batch({"doc_id": batch.column(0).slice(i, j - i).cast(pa.int64()), "score": pa.array(y, pa.float64()), "n_passages": pa.array(np.diff(begin), pa.int32()), "top_passage": pa.array(top, pa.int32()), "top_weight": pa.array(weight, pa.float64())})

    return f


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's score, its number of passages, and the passage that weighs most."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(_scored(model), RESULT)


def keep(docs: DataFrame, model: Model, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """The rows of ``docs``, as they are, that score ``threshold`` or more; null counts as empty text."""
    at = docs.columns.index(text)

    def f(batches):
        for batch in batches:
            buf, offs = K.text_column(batch.column(at))
            for i, j in K.row_slices(offs, 1 << 19):
                y, _ = model.score(*features(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i]))
                yield batch.slice(i, j - i).filter(pa.array(y >= threshold))

    return docs.mapInArrow(f, docs.schema)
