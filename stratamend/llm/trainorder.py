"""Training-order materialisation: fixed-length sequences in keyed random order.

Documents become token ids, and these become sequences of ``length`` tokens
(the last of a document is padded).  The ids are written once, compressed, to
the shared folder; sequences are numbered from 0 in the order of that table:
each task numbers its own, and the tasks' counts (one number each) give the
offsets.  A keyed Feistel network over the next power of four, walked until it
lands below the count, is a permutation of the numbers, so every sequence has
a slot of its own: no random state, no sort of the corpus in a single place,
and slot and number give each other back.

Slots are cut into shards of ``per_shard``.  A shard's rows have a fixed
stride and are stored in slot order, so slot s is row s % per_shard of shard
s // per_shard: a reader opens one shard after the other, and resumes from a
slot number alone.  One shuffle, by shard, moves the sequences.

Rows: null and empty text gives no sequence.  Repeated rows and null ids are
documents of their own.  An empty table gives an empty result.  Extra columns
are ignored.  The same table in other partitions is numbered in another order.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exchange as X
from . import kernels as K

RESULT = "slot long, shard long, doc_id long, part int, n_tokens int, tokens binary"
LENGTH, PER_SHARD, ROUNDS = 1024, 4096, 4


class Feistel:
    """A keyed permutation of 0..n-1."""

    def __init__(self, n: int, key: int):
        self.n, self.half = n, max(1, (max(1, n - 1).bit_length() + 1) // 2)
        mask = (1 << 64) - 1
        self.keys = [int(x) for x in K.mix(np.array([(key * ROUNDS + r) * 0x9E3779B97F4A7C15 + 0x1F83D9AB & mask for r in range(ROUNDS)], np.uint64))]

    def _walk(self, x: np.ndarray, step) -> np.ndarray:
        x = np.array(x, np.uint64)
        if self.n < 2:
            return x.astype(np.int64)
        x = step(x)
        while len(out := np.flatnonzero(x >= np.uint64(self.n))):
            x[out] = step(x[out])
        return x.astype(np.int64)

    def _round(self, right: np.ndarray, key: int) -> np.ndarray:
        return K.mix(right ^ np.uint64(key)) & np.uint64((1 << self.half) - 1)

    def _forth(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(self.half), x & np.uint64((1 << self.half) - 1)
        for key in self.keys:
            left, right = right, left ^ self._round(right, key)
        return left << np.uint64(self.half) | right

    def _back(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(self.half), x & np.uint64((1 << self.half) - 1)
        for key in reversed(self.keys):
            left, right = right ^ self._round(left, key), left
        return left << np.uint64(self.half) | right

    def slot(self, numbers) -> np.ndarray:
        return self._walk(numbers, self._forth)

    def number(self, slots) -> np.ndarray:
        return self._walk(slots, self._back)


class Tokenizer:
    """A byte-level BPE vocabulary read once by the driver and sent with the tasks."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern, self.pad = pattern, max(self.ranks.values()) + 1

    def __getstate__(self):
        return {"ranks": self.ranks, "pattern": self.pattern, "pad": self.pad}

    def encoder(self):
        import tiktoken

        return tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={})


def _tokens(tokenizer: Tokenizer, length: int):
    """One row a document: its sequences' ids, compressed together, and the number of its first within the task."""

    def f(batches):
        enc, pack = tokenizer.encoder(), zstandard.ZstdCompressor(level=1)
        task, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            _, offs = K.text_column(batch.column(1))
            for i, j in K.row_slices(offs, 1 << 20):
                texts = batch.column(1).slice(i, j - i).to_pylist()
                ids = [np.array(enc.encode_ordinary(t), np.uint16 if tokenizer.pad < 1 << 16 else np.uint32) if t else None for t in texts]
                keep = [k for k, x in enumerate(ids) if x is not None and len(x)]
                parts = np.array([-(-len(ids[k]) // length) for k in keep], np.int64)
                yield pa.record_batch(
                    {
                        "task": pa.array(np.full(len(keep), task), pa.int64()),
                        "first": pa.array(done + np.cumsum(parts) - parts),
                        "doc_id": batch.column(0).slice(i, j - i).take(pa.array(keep, pa.int64())),
                        "parts": pa.array(parts),
                        "size": pa.array([len(ids[k]) for k in keep], pa.int64()),
                        "ids": pa.array([pack.compress(ids[k].tobytes()) for k in keep], pa.binary()),
                    }
                )
                done += int(parts.sum())

    return f


def _placed(order: Feistel, base: np.ndarray, dtype, length: int, per_shard: int):
    """A row for each sequence, with its slot; tokens still compressed."""

    def f(batches):
        unpack, pack = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            task, first, doc, parts, size, ids = batch.columns
            first, parts = base[task.to_numpy()] + first.to_numpy(), parts.to_numpy()
            owner = np.repeat(np.arange(len(parts)), parts)
            part = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
            slot = order.slot(first[owner] + part)
            tokens, count = [], []
            for raw, n in zip(ids.to_pylist(), size.to_pylist()):
                x = np.frombuffer(unpack.decompress(raw), dtype)
                for a in range(0, n, length):
                    y = x[a : a + length]
                    count.append(len(y))
                    tokens.append(pack.compress(y.tobytes()))
            yield pa.record_batch({"slot": pa.array(slot), "shard": pa.array(slot // per_shard), "doc_id": doc.take(pa.array(owner)), "part": pa.array(part, pa.int32()), "n_tokens": pa.array(count, pa.int32()), "tokens": pa.array(tokens, pa.binary())})

    return f


def _padded(dtype, pad: int, length: int):
    def f(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for raw in batch.column(5).to_pylist():
                x = np.full(length, pad, dtype)
                y = np.frombuffer(unpack.decompress(raw), dtype)
                x[: len(y)] = y
                rows.append(x.tobytes())
            yield batch.set_column(5, "tokens", pa.array(rows, pa.binary()))

    return f


def training_order(docs: DataFrame, tokenizer: Tokenizer, key: int, length: int = LENGTH, per_shard: int = PER_SHARD, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """All sequences as RESULT: tokens is the fixed-stride row, little-endian, padded with ``tokenizer.pad``."""
    spark, dtype = docs.sparkSession, np.uint16 if tokenizer.pad < 1 << 16 else np.uint32
    body = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = X.stored(body.mapInArrow(_tokens(tokenizer, length), "task long, first long, doc_id long, parts long, size long, ids binary"), "tokens")
    # one number for each task that wrote the table
    counts = {r["task"]: r["n"] for r in rows.groupBy("task").agg(F.sum("parts").alias("n")).collect()}
    sizes = np.zeros(max(counts, default=0) + 1, np.int64)
    for task, n in counts.items():
        sizes[task] = n
    total = int(sizes.sum())
    placed = rows.mapInArrow(_placed(Feistel(total, key), np.cumsum(sizes) - sizes, dtype, length, per_shard), RESULT)
    shards = max(1, -(-total // per_shard))
    # whole shards to a partition, each in slot order
    dealt = placed.repartitionByRange(min(shards, 4 * X.partitions(spark)), "shard").sortWithinPartitions("slot")
    return dealt.mapInArrow(_padded(dtype, tokenizer.pad, length), RESULT)


def write_shards(rows: DataFrame, path: str) -> None:
    """Shards as Parquet folders ``shard=N`` of rows in slot order: each holds the fixed-stride rows of its slots."""
    rows.write.partitionBy("shard").option("compression", "zstd").parquet(path)


def read_from(spark: SparkSession, path: str, slot: int, count: int, per_shard: int = PER_SHARD) -> DataFrame:
    """``count`` sequences from ``slot`` on, in order: only the shards that hold them are opened."""
    rows = spark.read.parquet(path).where(F.col("shard").between(slot // per_shard, (slot + count - 1) // per_shard))
    return rows.where(F.col("slot").between(slot, slot + count - 1)).orderBy("slot")
