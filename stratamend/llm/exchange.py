"""How the operators meet across documents without meeting all rows of a key.

Documents are dealt once into *chunks* of bounded text (a chunk is the unit a
Python call sees).  A chunk boils what it wants to compare down to a sorted
list of distinct 64-bit names, so a key that a third of all documents hold
costs one entry a chunk, never one a row.  Names travel as packed arrays by
hash range (*bucket*); the bucket answers each chunk about its own names.  All
plans are lazy DataFrame plans: Spark reuses the exchange that deals out the
documents for each later look at them, and a lost executor costs only the
tasks that it ran.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one chunk holds on average; a longer document is a chunk's only large one.
CHUNK_BYTES = 4 << 20
#: Bytes of names that one bucket gathers on average.
BUCKET_BYTES = 4 << 20

NAMES = "bucket int, chunk int, names binary, extra binary"
REPLY = "chunk int, kind int, names binary, extra binary"


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts (one column is read, one row comes back)."""
    return docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0


def buckets_for(spark: SparkSession, total: float) -> int:
    return int(min(1 << 20, max(partitions(spark), total / BUCKET_BYTES)))


def chunked(docs: DataFrame, total: int, id_col: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(chunk, id, text) with documents dealt into chunks by id (a row without id by its text) and by the input partition.

    The partition keeps an id or a null id that very many rows share out of a
    single chunk.  ``docs`` must deal its rows to the same partitions whenever
    it is evaluated, as a scan of files does; store the result of a shuffle
    first (``stored``).
    """
    key, body = F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text")
    out = docs.select(key, body)
    n = max(partitions(docs.sparkSession), -(-total // chunk_bytes))
    return out.select(F.pmod(F.xxhash64(F.coalesce("id", F.xxhash64("text")), F.spark_partition_id()), F.lit(n)).cast("int").alias("chunk"), "id", "text")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder that spark.checkpoint.dir names; where it is unset (tests), a local one."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = tempfile.mkdtemp(prefix="stratamend-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at


def stored(df: DataFrame, name: str, batch: int | None = None, narrow: bool = False) -> DataFrame:
    """``df`` written as a table in the shared folder and read back, which cuts its lineage; it goes when Python ends.

    ``batch`` bounds the rows that travel to Python at once, for wide rows.
    ``narrow`` says that the rows are a small part of what the stage before
    them handles: a small shuffle then leaves a file for 16 partitions, not one
    for each.
    """
    spark, conf = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    path = f"{scratch_dir(spark).rstrip('/')}/stratamend-{name}-{uuid.uuid4().hex}"
    was = spark.conf.get(conf)
    if batch:
        spark.conf.set(conf, str(batch))
    try:
        out = df.repartition(max(1, partitions(spark) // 16)) if narrow else df
        out.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(conf, was)
    _paths[path] = spark
    back = spark.read.schema(df.schema).parquet(path)
    back.stored_at = path
    return back


def discard(df: DataFrame) -> None:
    """Deletes a table of ``stored`` that nothing reads any more."""
    path = df.stored_at
    _drop(_paths.pop(path), path)


#: Tables of ``stored`` that are still there.
_paths: dict[str, SparkSession] = {}


@atexit.register
def _drop_all() -> None:
    for path, spark in _paths.items():
        _drop(spark, path)


def _drop(spark: SparkSession, path: str) -> None:
    try:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)
    except Exception:  # the session is gone
        pass


def bucket_of(names: np.ndarray, n: int) -> np.ndarray:
    return (((names >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def pack(chunk: int, names: np.ndarray, n: int, extra: np.ndarray | None = None) -> pa.Table:
    """Rows of NAMES for a chunk's sorted distinct ``names``; ``extra`` has a fixed-width value for each."""
    at = np.searchsorted(bucket_of(names, n), np.arange(n + 1)) if len(names) else np.zeros(n + 1, np.int64)
    full = np.flatnonzero(np.diff(at))
    return pa.table(
        {
            "bucket": pa.array(full, pa.int32()),
            "chunk": pa.array(np.full(len(full), chunk), pa.int32()),
            "names": pa.array([names[at[b] : at[b + 1]].tobytes() for b in full], pa.binary()),
            "extra": pa.array([None if extra is None else extra[at[b] : at[b + 1]].tobytes() for b in full], pa.binary()),
        }
    )


def unpack(t: pa.Table, column: str, dtype) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py() or b"", dtype) for x in t.column(column)]


def reply(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [(), (), (), ()]
    return pa.table({"chunk": pa.array(cols[0], pa.int32()), "kind": pa.array(cols[1], pa.int32()), "names": pa.array(cols[2], pa.binary()), "extra": pa.array(cols[3], pa.binary())})


def gathered(t: pa.Table, kind: int, dtype=None):
    """All names of a kind that a chunk was told, sorted; with ``dtype``, also their values."""
    t = t.filter(pa.array(np.asarray(t.column("kind")) == kind)) if t.num_rows else t
    names = np.concatenate([np.zeros(0, np.uint64), *unpack(t, "names", np.uint64)])
    order = np.argsort(names, kind="stable")
    if dtype is None:
        return names[order]
    return names[order], np.concatenate([np.zeros(0, dtype), *unpack(t, "extra", dtype)])[order]


def clipped(names: np.ndarray) -> np.ndarray:
    """Names without their lowest bit, which flags those that a chunk holds twice."""
    return names & ~np.uint64(1)


def flagged(names: np.ndarray, twice: np.ndarray) -> np.ndarray:
    return names | twice.astype(np.uint64)


def shared_names(kind: int):
    """For groupBy(bucket).applyInArrow: tells each chunk which of its flagged names another chunk holds too, or itself holds twice.

    The answer has the names' upper halves: in a chunk's few names, one that is
    told by mistake is rare, and only adds a candidate.
    """

    def f(t: pa.Table) -> pa.Table:
        names = unpack(t, "names", np.uint64)
        every = np.concatenate(names)
        order = np.argsort(every, kind="stable")
        s = clipped(every[order])
        first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        size = np.diff(np.append(first, len(s)))
        many = (size > 1) | (np.maximum.reduceat(every[order] & np.uint64(1), first) > 0)
        back = np.empty(len(s), bool)
        back[order] = np.repeat(many, size)
        rows, at = [], 0
        for chunk, n in zip(t.column("chunk").to_pylist(), names):
            hit = n[back[at : at + len(n)]]
            at += len(n)
            if len(hit):
                rows.append((chunk, kind, (hit >> np.uint64(32)).astype(np.uint32).tobytes(), None))
        return reply(rows)

    return f


def told_names(t: pa.Table, kind: int) -> np.ndarray:
    """What ``shared_names`` told a chunk, sorted."""
    t = t.filter(pa.array(np.asarray(t.column("kind")) == kind)) if t.num_rows else t
    return np.unique(np.concatenate([np.zeros(0, np.uint32), *unpack(t, "names", np.uint32)]))


def is_told(names: np.ndarray, told: np.ndarray) -> np.ndarray:
    x = (names >> np.uint64(32)).astype(np.uint32)
    if not len(told) or not len(x):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(told, x), len(told) - 1)
    return told[at] == x
