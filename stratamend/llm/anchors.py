"""Substring dedup by difference-cover anchors.

Two documents that share a run of ``window`` words share, for some step below
the cover's period, a place that both have in their cover; hashing only the
places in a document whose index modulo the period is in a perfect difference
set therefore misses no such run.  Anchors (short word windows at those
places) that two documents hold mark the only windows that can repeat; these
are extended to the whole window, named by 128 bits of hash, and the smallest
document that starts each name is looked up.

Rows: null text counts as no words.  A null id sorts after all others.  Rows
with one id count as one document's parts: a window that only they share
stays.  An empty table gives an empty result.  A document without words keeps
nothing and has the hash of the empty string.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import exchange as X
from . import kernels as K

RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
LAST = np.iinfo(np.int64).max


def _cover(window: int) -> tuple[np.ndarray, int]:
    """The largest cover whose period leaves anchors of at least two fifths of the window."""
    best = (np.zeros(1, np.int64), 1)
    for q in (2, 3, 5, 7, 11, 13, 17, 19, 23):
        if q * q + q + 1 <= window - max(1, 2 * window // 5) + 1:
            best = K.difference_cover(q)
    return best


class _Chunk:
    """The words of a chunk's documents, in slices of bounded text."""

    def __init__(self, t: pa.Table):
        t = t.combine_chunks()
        ids = t.column("id")
        self.ids = ids.fill_null(LAST).to_numpy().astype(np.int64)
        self.null = np.asarray(ids.is_null())
        self.buf, self.offs = K.text_column(t.column("text"))

    def __iter__(self):
        for i, j in K.row_slices(self.offs):
            a = self.offs[i]
            buf, offs = self.buf[a : self.offs[j]], self.offs[i : j + 1] - a
            starts, ends, first = K.word_spans(buf, offs, K.PLAIN_WORD)
            yield self.ids[i:j], self.null[i:j], buf, starts, ends, first, K.span_hashes(buf, starts, ends)


def _owners(first: np.ndarray) -> np.ndarray:
    """The row of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def _distinct(names: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct names with their least and largest id."""
    if not len(names):
        return names, ids, ids
    order = np.argsort(names, kind="stable")
    names, ids = names[order], ids[order]
    at = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
    return names[at], np.minimum.reduceat(ids, at), np.maximum.reduceat(ids, at)


def _chunk_id(t: pa.Table) -> int:
    return t.column("chunk")[0].as_py() if t.num_rows else -1


def _windows(first: np.ndarray, hashes: np.ndarray, shared: np.ndarray, window: int, cover: np.ndarray, period: int):
    """Starts of the windows that hold a shared anchor, and their two hashes."""
    width = window - period + 1
    anchors = K.word_windows(hashes, width)
    none = np.zeros(0, np.int64)
    if not len(anchors):
        return none, none.astype(np.uint64), none.astype(np.uint64)
    row = _owners(first)[: len(anchors)]
    at = np.flatnonzero(np.isin((np.arange(len(anchors)) - first[row]) % period, cover) & K.inside(first, width, len(anchors)))
    at = at[X.is_told(anchors[at], shared)]
    n = len(hashes) - window + 1
    if n <= 0 or not len(at):
        return none, none.astype(np.uint64), none.astype(np.uint64)
    near = np.zeros(n + 1, np.int32)
    lo, hi = np.maximum(at - period + 1, 0), np.minimum(at, n - 1) + 1
    ok = lo < hi
    np.add.at(near, lo[ok], 1)
    np.subtract.at(near, hi[ok], 1)
    p = np.flatnonzero((np.cumsum(near[:-1]) > 0) & K.inside(first, window, n))
    return p, K.word_windows(hashes, window, K.WORDS)[p], K.word_windows(hashes, window, K.WORDS2)[p]


def repeated_windows(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the words of windows that a document of smaller id has too.

    Returns (doc_id, n_words, n_removed, kept_sha256, spans, kept_text): spans
    are the removed runs as word indexes [from, to), kept_text has the words
    that stay, joined by a space.
    """
    spark, total = docs.sparkSession, X.text_bytes(docs, text)
    chunks = X.chunked(docs, total, id_col, text)
    cover, period = _cover(window)
    width = window - period + 1
    n_anchor, n_window = X.buckets_for(spark, total / 4), X.buckets_for(spark, total / 2)

    def anchors(t: pa.Table) -> pa.Table:
        got, owner = [], []
        for ids, _, _, _, _, first, hashes in _Chunk(t):
            names = K.word_windows(hashes, width)
            row = _owners(first)[: len(names)]
            at = np.flatnonzero(np.isin((np.arange(len(names)) - first[row]) % period, cover) & K.inside(first, width, len(names)))
            got.append(X.clipped(names[at]))
            owner.append(ids[row[at]])
        names, least, most = _distinct(np.concatenate(got), np.concatenate(owner)) if got else (np.zeros(0, np.uint64),) * 3
        return X.pack(_chunk_id(t), X.flagged(names, least != most), n_anchor)

    def windows(t: pa.Table, told: pa.Table) -> pa.Table:
        shared, got, again, owner = X.told_names(told, 1), [], [], []
        for ids, _, _, _, _, first, hashes in _Chunk(t):
            p, a, b = _windows(first, hashes, shared, window, cover, period)
            got.append(a)
            again.append(b)
            owner.append(ids[_owners(first)[p]])
        if not got:
            return X.pack(-1, np.zeros(0, np.uint64), n_window)
        a, b, ids = map(np.concatenate, (got, again, owner))
        order = np.lexsort((b, a))
        a, b, ids = a[order], b[order], ids[order]
        at = np.flatnonzero(np.concatenate([np.ones(min(1, len(a)), bool), (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        value = np.empty(len(at), [("b", "<u8"), ("least", "<i8"), ("many", "u1")])
        if len(at):
            value["b"], value["least"] = b[at], np.minimum.reduceat(ids, at)
            value["many"] = np.maximum.reduceat(ids, at) > value["least"]
        return X.pack(_chunk_id(t), a[at], n_window, value)

    def earliest(t: pa.Table) -> pa.Table:
        names, values = X.unpack(t, "names", np.uint64), X.unpack(t, "extra", [("b", "<u8"), ("least", "<i8"), ("many", "u1")])
        a, v = np.concatenate(names), np.concatenate(values)
        order = np.lexsort((v["b"], a))
        s, w = a[order], v[order]
        at = np.flatnonzero(np.concatenate([[True], (s[1:] != s[:-1]) | (w["b"][1:] != w["b"][:-1])]))
        least = np.empty(len(s), np.int64)
        least[order] = np.repeat(np.minimum.reduceat(w["least"], at), np.diff(np.append(at, len(s))))
        rows, i = [], 0
        for chunk, n, x in zip(t.column("chunk").to_pylist(), names, values):
            first = least[i : i + len(n)]
            i += len(n)
            hit = (x["many"] > 0) | (x["least"] > first)
            if hit.any():
                value = np.empty(int(hit.sum()), [("b", "<u8"), ("least", "<i8")])
                value["b"], value["least"] = x["b"][hit], first[hit]
                rows.append((chunk, 2, n[hit].tobytes(), value.tobytes()))
        return X.reply(rows)

    def cut(t: pa.Table, told: pa.Table) -> pa.Table:
        shared = X.told_names(told, 1)
        names, value = X.gathered(told, 2, [("b", "<u8"), ("least", "<i8")])
        order = np.lexsort((value["b"], names))
        names, value = names[order], value[order]
        out = {k: [] for k in ("doc_id", "n_words", "n_removed", "kept_sha256", "spans", "kept_text")}
        for ids, null, buf, starts, ends, first, hashes in _Chunk(t):
            p, a, b = _windows(first, hashes, shared, window, cover, period)
            if len(names) and len(p):
                at = np.minimum(np.searchsorted(names, a), len(names) - 1)
                while len(step := np.flatnonzero((names[at] == a) & (value["b"][at] != b) & (at + 1 < len(names)))):  # names that two windows share
                    if not len(step := step[names[at[step] + 1] == a[step]]):
                        break
                    at[step] += 1
                hit = (names[at] == a) & (value["b"][at] == b) & (value["least"][at] < ids[_owners(first)[p]])
                p = p[hit]
            else:
                p = p[:0]
            gone = K.covered(p, window, len(hashes))
            raw = buf.tobytes()
            for k in range(len(ids)):
                i, j = first[k], first[k + 1]
                g = gone[i:j]
                keep = np.flatnonzero(~g) + i
                kept = b" ".join([raw[x:y] for x, y in zip(starts[keep].tolist(), ends[keep].tolist())])
                edge = np.flatnonzero(np.diff(np.concatenate([[False], g, [False]]).astype(np.int8)))
                out["doc_id"].append(None if null[k] else int(ids[k]))
                out["n_words"].append(int(j - i))
                out["n_removed"].append(int(g.sum()))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["spans"].append(edge.tolist())
                out["kept_text"].append(kept)
        kinds = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string(), "spans": pa.list_(pa.int32()), "kept_text": pa.binary()}
        return pa.table({k: pa.array(v, kinds[k]).cast(pa.string()) if k == "kept_text" else pa.array(v, kinds[k]) for k, v in out.items()})

    # the chunk key travels with the group, and a chunk that was told nothing still comes
    one = chunks.groupBy("chunk").applyInArrow(anchors, X.NAMES).groupBy("bucket").applyInArrow(X.shared_names(1), X.REPLY)
    two = chunks.groupBy("chunk").cogroup(one.groupBy("chunk")).applyInArrow(windows, X.NAMES).groupBy("bucket").applyInArrow(earliest, X.REPLY)
    told = one.unionByName(two)
    return chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(cut, RESULT + ", spans array<int>, kept_text string")
