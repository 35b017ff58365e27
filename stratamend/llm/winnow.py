"""Benchmark decontamination by winnowing.

Of each run of ``w`` successive k-gram hashes the least is a fingerprint, so
any two texts that share ``w + k - 1`` words share a fingerprint.  With that
sum equal to the window of the contamination rule, a document place outside
reach of a shared fingerprint cannot lie in a shared window; hits are extended
to whole windows, compared by 128 bits of hash.  Items shorter than a window
are one window of their own length.

The fingerprints and windows of the benchmark are collected only in blocks of
at most ``BLOCK_BYTES`` of item text, each sent to the executors and held
against all documents; with one block, which every known benchmark is, the
documents are read once and never shuffled.

Rows: null text has no words.  Null ids are kept.  Items without words and
empty tables match nothing.  Repeated rows are judged one by one; items that
repeat an item_id count once.  Items without id are judged like others: their
windows count in n_hit and spans, and all of them are one item of n_items (null
in items), without a name in items_sha256.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from . import kernels as K

RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<int>, items array<string>"
#: Item text that one block of the benchmark holds at most.
BLOCK_BYTES = 8 << 20
K_GRAM = 7


def _words(buf: np.ndarray, offs: np.ndarray):
    low = K.lower(buf)
    starts, ends, first = K.word_spans(low, offs, K.ITEM_WORD)
    return first, K.span_hashes(low, starts, ends)


def winnowed(grams: np.ndarray, w: int) -> np.ndarray:
    """Places of the least of each ``w`` successive values (the last of equal ones)."""
    n = len(grams) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at = grams[:n].copy(), np.arange(n)
    for step in range(1, w):
        x = grams[step : step + n]
        less = x <= best
        best[less] = x[less]
        at[less] = np.flatnonzero(less) + step
    return np.unique(at)


def _in_order(items) -> list:
    """Names sorted, null last."""
    return sorted(items, key=lambda x: (x is None, x or ""))


class Index:
    """Fingerprints and windows of one block of the benchmark."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        self.window, self.k = window, min(K_GRAM, window)
        self.w = window - self.k + 1
        prints, names, owners, size = [], [], [], []
        buf, offs = K.text_column(pa.array([t for _, t in items], pa.string()))
        first, hashes = _words(buf, offs)
        for r, (item, _) in enumerate(items):
            h = hashes[first[r] : first[r + 1]]
            if not len(h):
                continue
            n = min(window, len(h))
            a, b = K.word_windows(h, n), K.word_windows(h, n, K.WORDS2)
            if n == window:
                grams = K.word_windows(h, self.k)
                prints.append(grams[winnowed(grams, self.w)])
            names += zip(a.tolist(), b.tolist())
            owners += [item] * len(a)
            size += [n] * len(a)
        self.prints = np.unique(np.concatenate(prints)) if prints else np.zeros(0, np.uint64)
        bits = self.prints & np.uint64((1 << 20) - 1)
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[bits.astype(np.int64)] = True
        self.items: dict[tuple, set] = {}
        for key, n, item in zip(names, size, owners):
            self.items.setdefault((n, *key), set()).add(item)
        self.short = sorted({n for n in size if n != window})
        self.names = {n: np.unique(np.array([a for m, a, _ in self.items if m == n], np.uint64)) for n in {*size}}

    def hits(self, first: np.ndarray, hashes: np.ndarray):
        """(place, length, items) of every occurrence of an item's window in a row."""
        for n in self.short:
            a = K.word_windows(hashes, n)
            p = np.flatnonzero(K.member(a, self.names[n]) & K.inside(first, n, len(a)))
            yield from self._exact(p, n, hashes)
        grams = K.word_windows(hashes, self.k)
        if not len(grams) or not len(self.prints):
            return
        # a place that is a fingerprint here by its own row alone: rows are winnowed together, and
        # runs that cross rows only add places, which the exact windows then drop
        at = winnowed(grams, self.w)
        at = at[self.sieve[(grams[at] & np.uint64((1 << 20) - 1)).astype(np.int64)]]
        at = at[K.member(grams[at], self.prints)]
        n = len(hashes) - self.window + 1
        if n <= 0 or not len(at):
            return
        near = np.unique((at[:, None] - np.arange(self.w)[None, :]).ravel())
        near = near[(near >= 0) & (near < n)]
        near = near[K.inside(first, self.window, n)[near]]
        a = K.word_windows(hashes, self.window)[near]
        yield from self._exact(near[K.member(a, self.names[self.window])], self.window, hashes)

    def _exact(self, places: np.ndarray, n: int, hashes: np.ndarray):
        if not len(places):
            return
        rows = hashes[places[:, None] + np.arange(n)[None, :]]
        for p, words in zip(places.tolist(), rows):
            key = (n, int(K.word_windows(words, n)[0]), int(K.word_windows(words, n, K.WORDS2)[0]))
            if found := self.items.get(key):
                yield p, n, found


def _judged(index: Index):
    def f(batches):
        for batch in batches:
            ids = batch.column(0)
            buf, offs = K.text_column(batch.column(1))
            for i, j in K.row_slices(offs):
                first, hashes = _words(buf[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                delta, items = np.zeros(len(hashes) + 1, np.int32), {}
                for p, n, found in index.hits(first, hashes):
                    delta[p] += 1
                    delta[p + n] -= 1
                    items.setdefault(int(np.searchsorted(first, p, "right")) - 1, set()).update(found)
                spans = [[]] * (j - i)
                if items:
                    hit = np.cumsum(delta[:-1]) > 0
                    for r in items:
                        g = hit[first[r] : first[r + 1]]
                        spans[r] = np.flatnonzero(np.diff(np.concatenate([[False], g, [False]]).astype(np.int8))).tolist()
                yield pa.record_batch(
                    {
                        "doc_id": ids.slice(i, j - i).cast(pa.int64()),
                        "n_words": pa.array(np.diff(first), pa.int64()),
                        "spans": pa.array(spans, pa.list_(pa.int32())),
                        "items": pa.array([_in_order(items.get(r, ())) for r in range(j - i)], pa.list_(pa.string())),
                    }
                )

    return f


def _clean(index: Index, at: int):
    """Rows that aren't contaminated, as they are."""

    def f(batches):
        for batch in batches:
            found = _merged(_judged(index)([pa.record_batch({"doc_id": pa.nulls(batch.num_rows, pa.int64()), "text": batch.column(at)})]))
            bad = [x for part in found for x in part.column("contaminated").to_pylist()]
            yield batch.filter(pa.array([not x for x in bad], pa.bool_()))

    return f


def _merged(batches):
    """The sums of each document; a row may hold the overlapping spans of several blocks."""
    for batch in batches:
        rows = batch.to_pydict()
        out = {k: [] for k in ("n_hit", "n_items", "items_sha256", "contaminated", "spans", "items")}
        for n, spans, items in zip(rows["n_words"], rows["spans"], rows["items"]):
            flat = []
            for a, b in sorted(zip(spans[::2], spans[1::2])):
                if flat and a <= flat[-1]:
                    flat[-1] = max(flat[-1], b)
                else:
                    flat += [a, b]
            items = _in_order({*items})
            named = ",".join(x for x in items if x is not None)
            hit = sum(flat[1::2]) - sum(flat[::2])
            for k, v in zip(out, (hit, len(items), hashlib.sha256(named.encode()).hexdigest(), hit > 0 and 20 * hit >= n, flat, items)):
                out[k].append(v)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.string()))
        yield pa.record_batch({"doc_id": batch.column(0), "n_words": batch.column(1)} | {k: pa.array(v, t) for (k, v), t in zip(out.items(), kinds)})


def _bench(items: DataFrame, item_col: str, item_text: str, block_bytes: int) -> tuple[DataFrame, int]:
    """Items with text, and into how many blocks they go."""
    bench = items.select(F.col(item_col).cast("string").alias("item"), F.col(item_text).cast("string").alias("text")).where("text IS NOT NULL")
    total = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return bench, max(1, -(-2 * total // block_bytes)) if total > block_bytes else 1


def decontaminated(docs: DataFrame, items: DataFrame, window: int = 13, text: str = "text", item_col: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, as they are, that aren't contaminated."""
    bench, blocks = _bench(items, item_col, item_text, block_bytes)
    if blocks == 1:
        index = Index([(r.item, r.text) for r in bench.toLocalIterator()], window)
        return docs.mapInArrow(_clean(index, docs.columns.index(text)), docs.schema)
    row = "row_" + "_".join(docs.columns)  # a name that no column has
    rows = X.stored(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    bad = contamination(rows, items, window, row, text, item_col, item_text, block_bytes).where("contaminated").select(F.col("doc_id").alias(row))
    return rows.join(bad, row, "left_anti").drop(row)


def contamination(docs: DataFrame, items: DataFrame, window: int = 13, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each document's words inside occurrences of item windows, as ``RESULT``; spans are word indexes [from, to)."""
    body = F.col(text).cast("string").alias("text")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), body)
    bench, blocks = _bench(items, item_col, item_text, block_bytes)
    found = None
    if blocks > 1:  # several looks at the documents: each row needs a name of its own
        docs = X.stored(docs.withColumn("row", F.monotonically_increasing_id()), "documents")
    for b in range(blocks):
        part = bench if blocks == 1 else bench.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        index = Index([(r.item, r.text) for r in part.toLocalIterator()], window)
        if blocks == 1:
            return docs.mapInArrow(_judged(index), "doc_id long, n_words long, spans array<int>, items array<string>").mapInArrow(_merged, RESULT)
        one = docs.select("row", "text").mapInArrow(_judged(index), "doc_id long, n_words long, spans array<int>, items array<string>").where("size(items) > 0")
        found = one if found is None else found.unionByName(one)
    # only documents with hits travel; at most ``blocks`` rows of each
    met = found.groupBy(F.col("doc_id").alias("row")).agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    words = docs.select("row", "text").mapInArrow(_judged(Index([], window)), "doc_id long, n_words long, spans array<int>, items array<string>").select(F.col("doc_id").alias("row"), "n_words")
    every = docs.select("doc_id", "row").join(words, "row").join(met, "row", "left")
    empty = lambda c, t: F.coalesce(F.col(c), F.array().cast(t)).alias(c)
    return every.select("doc_id", "n_words", empty("spans", "array<int>"), empty("items", "array<string>")).mapInArrow(_merged, RESULT)
