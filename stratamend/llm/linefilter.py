"""Reversible line dedup: sharded cuckoo filters over exact reference counts.

The index counts, for each line key (128 bits of hash), the documents that
hold it.  Keys at or over the threshold also sit in the cuckoo filter of their
shard.  Inserting documents adds to the counts, deleting them subtracts; a key
that crosses the threshold enters or leaves its filter, so deletion undoes
insertion exactly.  A look-up asks the small filters first; only keys that pass
are joined with the exact counts, so a false positive never drops a line.

Rows: null and empty text is one empty line.  Every row counts as a document
of its own, null and repeated ids included; rows with one id lose the same
keys.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exchange as X
from . import kernels as K

RESULT = "doc_id long, n_lines long, n_dropped long, kept_sha256 string, kept_text string"
REFS = "shard int, a long, b long, n long"
FILTERS = "shard int, filter binary"
_BLANK = ~K.PLAIN_WORD


class Cuckoo:
    """A cuckoo filter of 16-bit fingerprints, four to a bucket, over pairs of 64-bit hashes."""

    SLOTS, KICKS = 4, 400

    def __init__(self, table: np.ndarray):
        self.table, self.mask = table, len(table) - 1

    @classmethod
    def sized(cls, n: int) -> Cuckoo:
        return cls(np.zeros((1 << max(2, int(np.ceil(np.log2(max(1, n) / (cls.SLOTS * 0.8))))), cls.SLOTS), np.uint16))

    @classmethod
    def of(cls, a: np.ndarray, b: np.ndarray) -> Cuckoo:
        n = len(a)
        while True:
            f = cls.sized(n)
            if all(f.insert(*x) for x in zip(*f.places(a, b))):
                return f
            n = max(8, 2 * n)

    def places(self, a: np.ndarray, b: np.ndarray) -> tuple[list, list]:
        """First buckets and fingerprints."""
        return (a & np.uint64(self.mask)).astype(np.int64).tolist(), (b % np.uint64(0xFFFF) + np.uint64(1)).astype(np.int64).tolist()

    def other(self, bucket: int, mark: int) -> int:
        return bucket ^ (mark * 0x5BD1E995 >> 7 & self.mask)

    def insert(self, bucket: int, mark: int) -> bool:
        for at in (bucket, self.other(bucket, mark)):
            for s in range(self.SLOTS):
                if not self.table[at, s]:
                    self.table[at, s] = mark
                    return True
        undo = []
        for kick in range(self.KICKS):
            s = (mark + kick) % self.SLOTS
            undo.append((at, s, mark))
            mark, self.table[at, s] = int(self.table[at, s]), mark
            at = self.other(at, mark)
            for s in range(self.SLOTS):
                if not self.table[at, s]:
                    self.table[at, s] = mark
                    return True
        for at, s, was in reversed(undo):  # as it was: the caller builds a larger one
            self.table[at, s], mark = mark, int(self.table[at, s])
        return False

    def delete(self, bucket: int, mark: int) -> bool:
        for at in (bucket, self.other(bucket, mark)):
            for s in range(self.SLOTS):
                if self.table[at, s] == mark:
                    self.table[at, s] = 0
                    return True
        return False

    def holds(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        at = (a & np.uint64(self.mask)).astype(np.int64)
        mark = (b % np.uint64(0xFFFF) + np.uint64(1)).astype(np.int64)
        two = at ^ (mark * 0x5BD1E995 >> 7 & self.mask)
        want = mark.astype(np.uint16)[:, None]
        return (self.table[at] == want).any(1) | (self.table[two] == want).any(1)

    def bytes(self) -> bytes:
        return self.table.tobytes()

    @classmethod
    def load(cls, raw: bytes) -> Cuckoo:
        return cls(np.frombuffer(raw, np.uint16).reshape(-1, cls.SLOTS).copy())


def line_spans(buf: np.ndarray, offs: np.ndarray):
    """Starts and ends of all lines, the first line of each row, and the two hashes of each key (``blank`` where it is empty)."""
    cut = np.flatnonzero(buf == 10)
    n = len(offs) - 1
    owner = np.concatenate([np.arange(n), np.searchsorted(offs, cut, "right") - 1])
    starts = np.concatenate([offs[:-1], cut + 1])
    order = np.lexsort((starts, owner))
    starts, owner = starts[order], owner[order]
    first = np.searchsorted(owner, np.arange(n + 1))
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:] - 1
    ends[first[1:] - 1] = offs[1:]
    low, solid = K.lower(buf), np.flatnonzero(~_BLANK[buf])
    i, j = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    blank = i >= j
    solid = np.append(solid, 0)
    s, e = np.where(blank, 0, solid[np.minimum(i, len(solid) - 1)]), np.where(blank, 0, solid[j - 1] + 1)
    return starts, ends, first, blank, K.span_hashes(low, s, e), K.span_hashes(low, s, e, K.BYTES2)


def _slices(column):
    buf, offs = K.text_column(column)
    for i, j in K.row_slices(offs):
        x = buf[offs[i] : offs[j]]
        yield i, j, x, *line_spans(x, offs[i : j + 1] - offs[i])


def _counts(a: np.ndarray, b: np.ndarray, row: np.ndarray):
    """Distinct keys and in how many rows each is."""
    order = np.lexsort((row, b, a))
    a, b, row = a[order], b[order], row[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    fresh = new.copy()
    fresh[1:] |= row[1:] != row[:-1]
    at = np.flatnonzero(new)
    return a[at], b[at], np.add.reduceat(fresh.astype(np.int64), at) if len(at) else np.zeros(0, np.int64)


def _keys(shards: int):
    def f(batches):
        for batch in batches:
            got = []
            for i, j, _, _, _, first, blank, a, b in _slices(batch.column(0)):
                got.append((a[~blank], b[~blank], np.repeat(np.arange(i, j), np.diff(first))[~blank]))
            if got:
                a, b, n = _counts(*map(np.concatenate, zip(*got)))
                yield pa.record_batch({"shard": pa.array(X.bucket_of(a, shards), pa.int32()), "a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64)), "n": pa.array(n)})

    return f


class LineIndex:
    """The state: ``refs`` (REFS) and ``filters`` (FILTERS), stored tables of one generation."""

    def __init__(self, spark: SparkSession, min_docs: int = 10, shards: int | None = None, refs: DataFrame | None = None, filters: DataFrame | None = None):
        self.min_docs, self.shards = min_docs, shards or X.partitions(spark)
        self.refs = refs if refs is not None else spark.createDataFrame([], REFS)
        self.filters = filters if filters is not None else spark.createDataFrame([], FILTERS)
        self.spark = spark

    def _changed(self, docs: DataFrame, sign: int, text: str) -> LineIndex:
        fresh = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(_keys(self.shards), REFS)
        both = self.refs.select("*", F.lit(0).alias("step")).unionByName(fresh.select("shard", "a", "b", F.lit(0).cast("long").alias("n"), (F.col("n") * sign).alias("step")))
        sums = both.groupBy("shard", "a", "b").agg(F.sum("n").alias("was"), F.sum(F.col("n") + F.col("step")).alias("n"))
        sums = X.stored(sums, "refs", narrow=True)
        limit = self.min_docs
        now, before = F.col("n") >= limit, F.col("was") >= limit
        keys = sums.where(now | before).select("shard", "a", "b", now.alias("now"), before.alias("before"))
        filters = keys.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(_updated, FILTERS)
        refs = sums.where("n > 0").select("shard", "a", "b", "n")
        return LineIndex(self.spark, limit, self.shards, refs, X.stored(filters, "filters", narrow=True))

    def insert(self, docs: DataFrame, text: str = "text") -> LineIndex:
        return self._changed(docs, 1, text)

    def delete(self, docs: DataFrame, text: str = "text") -> LineIndex:
        """Takes away documents that were inserted."""
        return self._changed(docs, -1, text)

    def common(self) -> DataFrame:
        return self.refs.where(F.col("n") >= self.min_docs)

    def apply(self, docs: DataFrame, id_col: str = "doc_id", text: str = "text", total: int | None = None) -> DataFrame:
        """``docs`` without the lines whose key is common, as RESULT."""
        chunks, shards = X.chunked(docs, X.text_bytes(docs, text) if total is None else total, id_col, text), self.shards

        def asked(t: pa.Table) -> pa.Table:
            got = [(a[~blank], b[~blank]) for *_, blank, a, b in _slices(t.column("text"))]
            if not got:
                return X.pack(-1, np.zeros(0, np.uint64), shards)
            a, b = map(np.concatenate, zip(*got))
            a, b, _ = _counts(a, b, np.zeros(len(a), np.int8))
            return X.pack(t.column("chunk")[0].as_py(), a, shards, b)

        def passed(t: pa.Table, held: pa.Table) -> pa.Table:
            f = Cuckoo.load(held.column("filter")[0].as_py()) if held.num_rows else None
            out = {"chunk": [], "a": [], "b": []}
            for chunk, a, b in zip(t.column("chunk").to_pylist(), X.unpack(t, "names", np.uint64), X.unpack(t, "extra", np.uint64)):
                if f is not None:
                    hit = f.holds(a, b)
                    out["a"].append(a[hit].view(np.int64))
                    out["b"].append(b[hit].view(np.int64))
                    out["chunk"].append(np.full(int(hit.sum()), chunk, np.int32))
            return pa.table({k: pa.array(np.concatenate([np.zeros(0, d), *out[k]])) for k, d in (("chunk", np.int32), ("a", np.int64), ("b", np.int64))})

        def cut(t: pa.Table, told: pa.Table) -> pa.Table:
            gone_a, gone_b = (told.column(c).to_numpy().view(np.uint64) for c in ("a", "b"))
            gone = set(zip(gone_a.tolist(), gone_b.tolist()))
            gone_a = np.unique(gone_a)
            out = {k: [] for k in ("n_lines", "n_dropped", "kept_sha256", "kept_text")}
            for i, j, buf, starts, ends, first, blank, a, b in _slices(t.column("text")):
                drop = K.member(a, gone_a) & ~blank
                at = np.flatnonzero(drop)
                drop[at] = [x in gone for x in zip(a[at].tolist(), b[at].tolist())]
                raw, sums = buf.tobytes(), np.concatenate([[0], np.cumsum(drop)])
                for r in range(j - i):
                    x, y = int(first[r]), int(first[r + 1])
                    n = int(sums[y] - sums[x])
                    if n:
                        keep = (np.flatnonzero(~drop[x:y]) + x).tolist()
                        kept = b"\n".join([raw[starts[k] : ends[k]] for k in keep])
                    else:
                        kept = raw[starts[x] : ends[y - 1]]
                    for k, v in zip(out, (y - x, n, hashlib.sha256(kept).hexdigest(), kept)):
                        out[k].append(v)
            return pa.table({"doc_id": t.column("id"), "n_lines": pa.array(out["n_lines"], pa.int64()), "n_dropped": pa.array(out["n_dropped"], pa.int64()), "kept_sha256": pa.array(out["kept_sha256"], pa.string()), "kept_text": pa.array(out["kept_text"], pa.binary()).cast(pa.string())})

        names = chunks.groupBy("chunk").applyInArrow(asked, X.NAMES).withColumnRenamed("bucket", "shard")
        likely = names.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(passed, "chunk int, a long, b long")
        sure = likely.join(self.common().select("a", "b"), ["a", "b"], "left_semi").select("chunk", "a", "b")
        return chunks.groupBy("chunk").cogroup(sure.groupBy("chunk")).applyInArrow(cut, RESULT)


def _updated(keys: pa.Table, held: pa.Table) -> pa.Table:
    """A shard's filter after keys entered and left; it is built anew from the exact keys where it has become too small."""
    shard = (keys if keys.num_rows else held).column("shard")[0].as_py()
    a, b = (keys.column(c).to_numpy().view(np.uint64) for c in ("a", "b"))
    now, before = (np.asarray(keys.column(c)).astype(bool) for c in ("now", "before"))
    f = Cuckoo.load(held.column("filter")[0].as_py()) if held.num_rows else Cuckoo.sized(int(now.sum()))
    gone, fresh = before & ~now, now & ~before
    fits = now.sum() <= 0.9 * f.table.size
    if fits:
        for x in zip(*f.places(a[gone], b[gone])):
            f.delete(*x)
        fits = all(f.insert(*x) for x in zip(*f.places(a[fresh], b[fresh])))
    f = f if fits else Cuckoo.of(a[now], b[now])
    return pa.table({"shard": pa.array([shard], pa.int32()), "filter": pa.array([f.bytes()], pa.binary())})


def common_lines_dropped(docs: DataFrame, min_docs: int = 10, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One whole corpus: insert it, then apply the index to it."""
    spark, total = docs.sparkSession, X.text_bytes(docs, text)
    index = LineIndex(spark, min_docs, X.buckets_for(spark, total / 8)).insert(docs, text)
    return index.apply(docs, id_col, text, total)
