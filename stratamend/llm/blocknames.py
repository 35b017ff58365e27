"""Exact dedup by deterministic block naming.

A text (A-Z lower-cased) is cut into blocks of fixed size.  Equal blocks meet
in one partition, are sorted there, and get their partition and rank as an
integer name, so equal names mean equal blocks: no fingerprint is trusted.
Then the names of a document are taken two by two as blocks of 16 bytes and
named again, until each document has one name; documents are equal when they
have as many blocks and the same last name.

What travels is a chunk's dictionary of distinct blocks, never a row for each
copy: a block that a third of all documents hold costs one row a chunk.  Names
go back to the chunk, which holds its documents as lists of dictionary places.

Numbers of rows and chunks are a partition (31 bits, all that Spark has) and a
count in it (32 bits); a block's name is a partition (23) and its rank (40).

Rows: null counts as the empty text, which is one empty block.  The row with
the largest id stays, null ids last; of rows that share that id too, one.  An
empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from . import kernels as K

RESULT = "doc_id long, keep_id long, group_size long, kept boolean, text_sha256 string"
BLOCK = 4096
#: Text that one chunk's dictionary covers at most (or one document).
CHUNK = 8 << 20
_ROWS = "route long, kind int, chunk long, place int, block binary"
_NAMED = "chunk long, kind int, place int, name long, block binary"
_SEQ = "row long, doc_id long, tag long, sha binary, symbols binary"


def _documents(size: int):
    """Chunks of documents as rows of _ROWS: kind 0 for each distinct block, kind 1 for the documents."""

    def f(batches):
        part, count, done = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            buf, offs = K.text_column(batch.column(1))
            for i, j in K.row_slices(offs, CHUNK):
                raw = K.lower(buf[offs[i] : offs[j]]).tobytes()
                at = (offs[i : j + 1] - offs[i]).tolist()
                texts = [raw[x:y] for x, y in zip(at, at[1:])]
                shas = [hashlib.sha256(x).digest() for x in texts]
                yield from _dictionary(part << 32 | count, [part << 32 | done + k for k in range(j - i)], batch.column(0).slice(i, j - i).to_pylist(), batch.column(2).slice(i, j - i).to_pylist(), shas, texts, size)
                count, done = count + 1, done + j - i

    return f


def _sequences(size: int):
    """The same for the symbols of documents that already have names."""

    def f(batches):
        part, count = TaskContext.get().partitionId(), 0
        for batch in batches:
            t = batch.to_pydict()
            yield from _dictionary(part << 32 | count, t["row"], t["doc_id"], t["tag"], t["sha"], t["symbols"], size)
            count += 1

    return f


def _dictionary(chunk: int, rows: list, ids: list, tags: list, shas: list, texts: list[bytes], size: int):
    places: dict[bytes, int] = {}
    lists = []
    for x in texts:
        lists.append([places.setdefault(x[k : k + size], len(places)) for k in range(0, max(1, len(x)), size)])
    body = pa.record_batch(
        {
            "row": pa.array(rows, pa.int64()),
            "doc_id": pa.array(ids, pa.int64()),
            "tag": pa.array(tags, pa.int64()),
            "sha": pa.array(shas, pa.binary()),
            "places": pa.array(lists, pa.list_(pa.int32())),
        }
    )
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, body.schema) as w:
        w.write_batch(body)
    blocks = list(places)
    n = len(blocks) + 1
    yield pa.record_batch(
        {
            "route": pa.array([int.from_bytes(hashlib.blake2b(b, digest_size=8).digest(), "little", signed=True) for b in blocks] + [chunk], pa.int64()),
            "kind": pa.array([0] * len(blocks) + [1], pa.int32()),
            "chunk": pa.array([chunk] * n, pa.int64()),
            "place": pa.array([*range(len(blocks)), -1], pa.int32()),
            "block": pa.array([*blocks, sink.getvalue().to_pybytes()], pa.binary()),
        }
    )


def _name(batches):
    """Sorted blocks of a partition get integer names; kind 1 passes through."""
    base, rank, last = TaskContext.get().partitionId() << 40, -1, None
    for batch in batches:
        kinds, blocks = batch.column(1).to_pylist(), batch.column(4)
        names, out = [], []
        for kind, block in zip(kinds, blocks):
            if kind:
                names.append(None)
                out.append(block.as_py())
                continue
            block = block.as_py()
            if block != last:
                rank, last = rank + 1, block
            names.append(base + rank)
            out.append(None)
        yield pa.record_batch({"chunk": batch.column(2), "kind": batch.column(1), "place": batch.column(3), "name": pa.array(names, pa.int64()), "block": pa.array(out, pa.binary())})


def _resolve(batches):
    """Within a partition sorted by chunk and kind: a chunk's names, then its documents, which get them."""
    chunk, places, names = None, [], []
    for batch in batches:
        for c, kind, place, name, block in zip(*(x.to_pylist() for x in batch.columns)):
            if c != chunk:
                chunk, places, names = c, [], []
            if not kind:
                places.append(place)
                names.append(name)
                continue
            table = np.zeros(len(places), np.int64)
            table[places] = names
            body = pa.ipc.open_stream(block).read_all().combine_chunks()
            lists = body.column("places").combine_chunks() if isinstance(body.column("places"), pa.ChunkedArray) else body.column("places")
            flat, at = table[lists.values.to_numpy()], lists.offsets.to_numpy()
            # names as big-endian bytes, so that sorting the next level's blocks sorts by name
            symbols = [flat[x:y].astype(">i8").tobytes() for x, y in zip(at, at[1:])]
            t = pa.table({"row": body.column("row"), "doc_id": body.column("doc_id"), "tag": body.column("tag"), "sha": body.column("sha"), "symbols": pa.array(symbols, pa.binary())})
            yield from t.to_batches()


def _round(rows: DataFrame) -> DataFrame:
    named = rows.repartition(F.col("route")).sortWithinPartitions("kind", "block").mapInArrow(_name, _NAMED)
    return named.repartition(F.col("chunk")).sortWithinPartitions("chunk", "kind").mapInArrow(_resolve, _SEQ)


def identities(docs: DataFrame, id_col: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """(row, doc_id, tag, sha, blocks, name), with the hash of the text as it is for a tag: equal (blocks, name) means equal texts, and the other way round."""
    body = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("tag", F.xxhash64("text"))
    left = _round(body.mapInArrow(_documents(block), _ROWS)).withColumn("blocks", F.expr("octet_length(symbols) div 8"))
    left = X.stored(left, "names", narrow=True)
    most, done = left.agg(F.max("blocks")).first()[0] or 1, left.where("blocks = 1")
    sizes, left = left.where("blocks > 1").select("row", "blocks"), left.where("blocks > 1").drop("blocks")
    levels = (most - 1).bit_length()
    # documents of few blocks end at a lower level; their last name stays and is paired with nothing further
    for _ in range(levels):
        left = _round(left.mapInArrow(_sequences(16), _ROWS))
    if levels:
        done = done.select("row", "doc_id", "tag", "sha", "blocks", "symbols").unionByName(left.join(sizes, "row").select("row", "doc_id", "tag", "sha", "blocks", "symbols"))
    return done.select("row", "doc_id", "tag", "sha", "blocks", F.conv(F.hex("symbols"), 16, -10).cast("long").alias("name"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row for each document, as RESULT."""
    named = identities(docs, id_col, text, block)
    # as text: the join then deals both sides anew, and Spark can split a hot group's side
    key = F.concat_ws(":", "blocks", "name").alias("key")
    rows = named.select("row", "doc_id", "sha", "blocks", "name")
    groups = rows.groupBy("blocks", "name").agg(F.max(F.struct(F.col("doc_id").isNotNull().alias("real"), "doc_id", "row")).alias("top"), F.count(F.lit(1)).alias("group_size"))
    out = rows.select(key, "row", "doc_id", "sha").join(groups.select(key, "top", "group_size"), "key")
    return out.select("doc_id", F.col("top.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("top.row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, as they are, that stay: of equal texts one, that of the largest id.

    They come back by id and text hash; rows that repeat both are one.
    """
    own, tag = ("key_" + "_".join(docs.columns), "tag_" + "_".join(docs.columns))  # names that no column has
    whole = lambda c: F.coalesce(c, F.lit(-(1 << 63) + 1))
    best = F.max(F.struct(F.col("doc_id").isNotNull().alias("real"), "doc_id", "row", "tag")).alias("top")
    stay = identities(docs, id_col, text).groupBy("blocks", "name").agg(best).select(whole(F.col("top.doc_id")).alias(own), F.col("top.tag").alias(tag))
    rows = docs.withColumns({own: whole(F.col(id_col).cast("long")), tag: F.xxhash64(F.col(text).cast("string"))})
    return rows.join(stay, [own, tag], "left_semi").dropDuplicates([own, tag]).drop(own, tag)
