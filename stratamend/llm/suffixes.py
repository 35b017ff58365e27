"""Substring dedup over suffixes sampled by difference covers.

A repeat of ``length`` bytes only needs suffixes compared to that depth, so
the samples are narrowed in two levels and no suffix array is built:

1. sample the suffixes whose place modulo v is in a difference cover, name
   their first bytes by a hash (any long repeat aligns two samples within v
   places), group the names, and discard samples whose name is unique;
2. do so again, among what the survivors reach, with a denser cover and longer
   names, which are hashes of the text itself and not made of the first
   level's names;
3. take the suffixes that a surviving sample reaches, name them by their first
   ``length`` bytes, sort the names, and compare neighbours; equal neighbours
   are a repeat.

This is narrower than the difference-cover algorithm: names are not ranks,
nothing recurses on a string of names, and suffixes are ordered by hash, which
keeps equal prefixes adjacent but does not sort the texts.  The full suffix
array would need many times the input on disk.  Copies of a whole document are
one class beforehand: they are removed entirely, and one of them stands for
the class against other documents.

Rows: null counts as the empty text; texts under ``length`` bytes stay.  Rows
are documents of their own, repeated ids and null ids included.  An empty
table gives an empty result.  Extra columns are ignored.  A very long text is
held whole by one task.  Matches never cross
documents.  Names have 63 bits in steps 1 and 2, where a clash only adds
candidates, and 79 bits in step 3: fewer than 50 clashes are expected among
the repeats of 100 TB.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import exchange as X
from . import kernels as K

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<int>, kept binary"
_PAIR = [("b", "<u8"), ("n", "u1")]


def _covers(length: int) -> list[tuple[np.ndarray, int, int]]:
    """(cover, period, width of names): a sparse one, then a denser one with longer names."""
    fit = [q for q in (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31) if q * q + q + 1 < length]
    sparse = [q for q in fit if length - (q * q + q) >= length / 5]
    dense = [q for q in fit if length - (q * q + q) >= length * 4 / 5]
    out = []
    for qs in (sparse, dense):
        cover, period = K.difference_cover(qs[-1]) if qs else (np.zeros(1, np.int64), 1)
        out.append((cover, period, length - period + 1))
    return out


class _Chunk:
    """A chunk's documents of ``length`` bytes or more that take part, in slices of bounded text."""

    def __init__(self, t: pa.Table, length: int):
        t = t.combine_chunks()
        self.buf, self.offs = K.text_column(t.column("text"))
        self.long = np.flatnonzero(np.diff(self.offs) >= length)
        raw = self.buf.tobytes()
        self.names = np.zeros(len(self.long), [("a", "<u8"), ("b", "<u8")])
        for k, r in enumerate(self.long):
            d = hashlib.blake2b(raw[self.offs[r] : self.offs[r + 1]], digest_size=16).digest()
            self.names[k] = np.frombuffer(d, self.names.dtype)[0]

    def judge(self, told: pa.Table) -> _Chunk:
        """Learns which documents have copies and which of those stand for their class."""
        names, extra = X.gathered(told, 0, _PAIR)
        copies = {(a, b): bool(n) for a, b, n in zip(names.tolist(), extra["b"].tolist(), extra["n"].tolist())}
        self.copied, self.active, seen = np.zeros(len(self.long), bool), np.ones(len(self.long), bool), set()
        for k, key in enumerate(map(tuple, self.names.tolist())):
            if key in copies:
                self.copied[k] = True
                self.active[k] = copies[key] and key not in seen
                seen.add(key)
        return self

    def slices(self):
        """(indexes into ``long``, bytes, offsets) of active documents."""
        docs = np.flatnonzero(self.active)
        sizes = np.diff(self.offs)[self.long[docs]]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        for i, j in K.row_slices(ends):
            rows = self.long[docs[i:j]]
            yield docs[i:j], np.concatenate([self.buf[self.offs[r] : self.offs[r + 1]] for r in rows]), ends[i : j + 1] - ends[i]


def _samples(offs: np.ndarray, cover: np.ndarray, period: int, width: int) -> np.ndarray:
    """Places of all sampled suffixes of at least ``width`` bytes."""
    out = []
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
        n = b - a - width + 1
        if n > 0:
            p = (np.arange(0, n, period)[:, None] + cover[None, :]).ravel()
            out.append(a + np.sort(p[p < n]))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _reached(places: np.ndarray, offs: np.ndarray, period: int, length: int, total: int) -> np.ndarray:
    """Starts of whole windows that hold one of the sampled places within the first ``period`` bytes."""
    n = total - length + 1
    if n <= 0 or not len(places):
        return np.zeros(0, np.int64)
    d = np.zeros(n + 1, np.int32)
    lo, hi = np.maximum(places - period + 1, 0), np.minimum(places, n - 1) + 1
    ok = lo < hi
    np.add.at(d, lo[ok], 1)
    np.subtract.at(d, hi[ok], 1)
    return np.flatnonzero((np.cumsum(d[:-1]) > 0) & K.inside(offs, length, n))


def repeated_bytes(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the bytes of strings of ``length`` bytes that start twice anywhere, as RESULT."""
    spark, total = docs.sparkSession, X.text_bytes(docs, text)
    chunks = X.chunked(docs, total, id_col, text)
    covers = _covers(length)
    few, some, many = X.buckets_for(spark, total / 200), X.buckets_for(spark, total / 2), X.buckets_for(spark, total)

    def chunk_id(t: pa.Table) -> int:
        return t.column("chunk")[0].as_py() if t.num_rows else -1

    def whole(t: pa.Table) -> pa.Table:
        names, count = np.unique(_Chunk(t, length).names, return_counts=True)
        extra = np.zeros(len(names), _PAIR)
        extra["b"], extra["n"] = names["b"], np.minimum(count, 2)
        return X.pack(chunk_id(t), names["a"].copy(), few, extra)

    def classes(t: pa.Table) -> pa.Table:
        """Tells a chunk which of its texts have copies, and whether it stands for them (the least chunk does)."""
        held: dict[tuple, list] = {}
        for chunk, a, x in zip(t.column("chunk").to_pylist(), X.unpack(t, "names", np.uint64), X.unpack(t, "extra", _PAIR)):
            for name, b, n in zip(a.tolist(), x["b"].tolist(), x["n"].tolist()):
                held.setdefault((name, b), []).append((chunk, n))
        back: dict[int, list] = {}
        for (name, b), at in held.items():
            if len(at) > 1 or at[0][1] > 1:
                first = min(at)[0]
                for chunk, _ in at:
                    back.setdefault(chunk, []).append((name, b, chunk == first))
        rows = []
        for chunk, found in back.items():
            extra = np.array([(b, n) for _, b, n in found], _PAIR)
            rows.append((chunk, 0, np.array([a for a, _, _ in found], np.uint64).tobytes(), extra.tobytes()))
        return X.reply(rows)

    def survivors(chunk: _Chunk, told: pa.Table, level: int):
        """For each slice: its documents, bytes, offsets, hashes, and the places that levels below ``level`` leave as candidates."""
        kept = [X.told_names(told, k + 1) for k in range(level)]
        for rows, buf, offs in chunk.slices():
            runs, near = K.Runs(buf), None
            for (cover, period, width), names in zip(covers, kept):
                p = _samples(offs, cover, period, width)
                if near is not None:
                    p = p[near[p]]
                p = p[X.is_told(runs.at(p, width), names)]
                # a repeat that holds this sample starts at most a period before it and ends at most ``length`` later
                near = np.zeros(len(buf) + 1, bool)
                starts = _reached(p, offs, period, length, len(buf))
                near[:-1] = K.covered(starts, length, len(buf))
            yield rows, buf, offs, runs, near, p if level else None

    def sampled(level: int):
        cover, period, width = covers[level]

        def names(t: pa.Table, told: pa.Table) -> pa.Table:
            chunk, got = _Chunk(t, length).judge(told), []
            for _, _, offs, runs, near, _ in survivors(chunk, told, level):
                p = _samples(offs, cover, period, width)
                got.append(X.clipped(runs.at(p if near is None else p[near[p]], width)))
            found, count = np.unique(np.concatenate([np.zeros(0, np.uint64), *got]), return_counts=True)
            return X.pack(chunk_id(t), X.flagged(found, count > 1), some)

        return names

    def prefixes(chunk: _Chunk, told: pa.Table):
        """Candidate suffixes of each slice with the two names of their prefix."""
        period = covers[-1][1]
        for rows, buf, offs, runs, _, p in survivors(chunk, told, len(covers)):
            at = _reached(p, offs, period, length, len(buf))
            yield rows, offs, at, runs.at(at, length), (K.Runs(buf, K.BYTES2).at(at, length) >> np.uint64(49)).astype(np.uint16)

    def merged(t: pa.Table, told: pa.Table) -> pa.Table:
        chunk, got = _Chunk(t, length).judge(told), []
        for rows, offs, at, a, b in prefixes(chunk, told):
            double = chunk.copied[rows][np.searchsorted(offs, at, "right") - 1]
            got.append((a, b, double))
        a, b, double = map(np.concatenate, zip(*got)) if got else (np.zeros(0, np.uint64), np.zeros(0, np.uint16), np.zeros(0, bool))
        order = np.lexsort((b, a))
        a, b, double = a[order], b[order], double[order]
        first = np.flatnonzero(np.concatenate([np.ones(min(1, len(a)), bool), (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        many_here = (np.diff(np.append(first, len(a))) > 1) | (np.logical_or.reduceat(double, first) if len(first) else False)
        return X.pack(chunk_id(t), a[first], many, b[first] << np.uint16(1) | many_here.astype(np.uint16))

    def neighbours(t: pa.Table) -> pa.Table:
        """One bit for each prefix of each chunk: another suffix has the same."""
        names, extra = X.unpack(t, "names", np.uint64), X.unpack(t, "extra", np.uint16)
        a, x = np.concatenate(names), np.concatenate(extra)
        order = np.lexsort((x >> np.uint16(1), a))
        s, y = a[order], x[order]
        first = np.flatnonzero(np.concatenate([[True], (s[1:] != s[:-1]) | (y[1:] >> np.uint16(1) != y[:-1] >> np.uint16(1))]))
        size = np.diff(np.append(first, len(s)))
        again = (size > 1) | (np.maximum.reduceat(y & np.uint16(1), first) > 0)
        back = np.empty(len(s), bool)
        back[order] = np.repeat(again, size)
        rows, at, bucket = [], 0, t.column("bucket")[0].as_py()
        for chunk, n in zip(t.column("chunk").to_pylist(), names):
            rows.append((chunk, 9, np.packbits(back[at : at + len(n)]).tobytes(), np.array([bucket, len(n)], np.int64).tobytes()))
            at += len(n)
        return X.reply(rows)

    def cut(t: pa.Table, told: pa.Table) -> pa.Table:
        chunk = _Chunk(t, length).judge(told)
        found = list(prefixes(chunk, told))
        a, b = (np.concatenate([np.zeros(0, d), *(x[k] for x in found)]) for k, d in ((3, np.uint64), (4, np.uint16)))
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        first = np.concatenate([np.ones(min(1, len(a)), bool), (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        bits = sorted((*np.frombuffer(e, np.int64).tolist(), n) for k, n, e in zip(told.column("kind").to_pylist(), told.column("names").to_pylist(), told.column("extra").to_pylist()) if k == 9) if told.num_rows else []
        bits = np.concatenate([np.zeros(0, bool), *(np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(bool) for _, n, x in bits)])
        hit = np.empty(len(a), bool)
        hit[order] = bits[np.cumsum(first) - 1] if len(a) else bits
        gone, i = {}, 0
        for rows, offs, at, *_ in found:
            flags = K.covered(at[hit[i : i + len(at)]], length, int(offs[-1]))
            i += len(at)
            for k, (x, y) in zip(rows.tolist(), zip(offs[:-1], offs[1:])):
                gone[k] = flags[x:y]
        place = {int(r): k for k, r in enumerate(chunk.long)}
        out = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept")}
        for r in range(t.num_rows):
            text = chunk.buf[chunk.offs[r] : chunk.offs[r + 1]]
            k = place.get(r)
            if k is None:
                flags = None
            elif chunk.copied[k]:
                flags = np.ones(len(text), bool)
            else:
                flags = gone[k]
            if flags is None or not flags.any():
                spans, kept = [], text.tobytes()
            else:
                spans, kept = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8))).tolist(), text[~flags].tobytes()
            for k, v in zip(out, (len(text), len(text) - len(kept), len(spans) // 2, hashlib.sha256(kept).hexdigest(), spans, kept)):
                out[k].append(v)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.binary())
        return pa.table({"doc_id": t.column("id")} | {k: pa.array(v, kind) for (k, v), kind in zip(out.items(), kinds)})

    told = chunks.groupBy("chunk").applyInArrow(whole, X.NAMES).groupBy("bucket").applyInArrow(classes, X.REPLY)
    for level in range(len(covers)):
        names = chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(sampled(level), X.NAMES)
        told = told.unionByName(names.groupBy("bucket").applyInArrow(X.shared_names(level + 1), X.REPLY))
    names = chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(merged, X.NAMES)
    told = told.unionByName(names.groupBy("bucket").applyInArrow(neighbours, X.REPLY))
    return chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(cut, RESULT)
