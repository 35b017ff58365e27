"""Loading tables whole: one, several or all; export; reports."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codecs, copybinary
from ..functions import types as K
from ..sources import pagefile as P
from ..sources.paged import Layout, register
from .files import Files
from .state import StateStore
from .table import VersionedTable

REPORT = "table string, status string, rows long, nanos long, bytes long, error string"


def read_table(spark: SparkSession, path: str, table: str, versions: bool = False, **options) -> DataFrame:
    register(spark)
    return spark.read.format("paged_file").options(path=path, table=table, versions=str(versions).lower(), **options).load()


def read_pages(spark: SparkSession, path: str, table: str) -> DataFrame:
    """(page, gen) of a table's data pages."""
    register(spark)
    return spark.read.format("paged_file").options(path=path, relation="pages", table=table).load().select("page", "gen")


def read_slots(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Every slot of a table's data pages, whatever it holds."""
    register(spark)
    return spark.read.format("paged_file").options(path=path, relation="slots", table=table).load()


def table_ddl(path: str, table: str, unlogged: bool = False) -> str:
    """CREATE TABLE of a table of a paged file."""
    with P.PageFile(path) as f:
        layout = Layout(f, table)
        names = [name for _, name in layout.columns]
        try:
            key = f.key(table)
        except LookupError:
            key = None
        return K.create_table(table, list(zip(names, (d for _, d in layout.latest))), key, unlogged)


def load_table(spark: SparkSession, path: str, table: str, target: str, state: StateStore | None = None) -> int:
    """The current rows of a table, swapped in whole.  The state remembers what was seen, so that a feed goes on from there."""
    with P.PageFile(path) as f:
        generation = f.generation()
        try:
            key = [k.lower() for k in f.key(table)]
        except LookupError:
            key = []
    store = VersionedTable(spark, f"{target}/{table.lower()}", key)
    if state is None or not key:
        store.swap(read_table(spark, path, table))
    else:
        from ..operators import changes

        rows = read_table(spark, path, table, versions=True)
        seen = changes.scan(rows, key, 0, pages=read_pages(spark, path, table))
        store.swap(read_table(spark, path, table))
        state.save(table, seen.stats.first()["max_txn"], generation, seen.page_gens, seen.keys)
    return store.read().count()


def load_tables(spark: SparkSession, path: str, tables: Iterable[str] | None, target: str, state: StateStore | None = None, threads: int = 4) -> DataFrame:
    """Several tables, or all: each on its own, so one that fails doesn't stop the others.  A report row for each."""
    if tables is None:
        with P.PageFile(path) as f:
            tables = f.tables()

    def one(table: str) -> tuple:
        began = time.perf_counter_ns()
        try:
            rows = load_table(spark, path, table, target, state)
            return table, "OK", rows, time.perf_counter_ns() - began, 0, None
        except Exception as e:  # reported, and the rest goes on
            return table, "FAILED", 0, time.perf_counter_ns() - began, 0, str(e)[:500]

    with ThreadPoolExecutor(threads) as pool:
        return spark.createDataFrame(list(pool.map(one, tables)), REPORT)


def report(results: DataFrame) -> DataFrame:
    """Totals of each status, with the rate."""
    sums = results.groupBy("status").agg(F.count(F.lit(1)).alias("tables"), F.sum("rows").alias("rows"), F.sum("nanos").alias("nanos"), F.sum("bytes").alias("bytes"))
    return sums.withColumn("rate", codecs.speed(F.col("rows"), F.col("nanos"), F.col("bytes")))


def export_copy(df: DataFrame, path: str) -> None:
    """COPY BINARY as numbered parts: a header, the rows of each partition, a trailer; their concatenation is one stream.

    Parts are written by tasks as sequence-of-bytes Parquet, and joined into
    ``path``/stream by the driver part by part, so no part is held whole.
    """
    spark = df.sparkSession
    parts = copybinary.rows(df).withColumn("part", F.spark_partition_id())
    parts.write.mode("overwrite").parquet(f"{path}/parts")
    files = Files(spark)
    fs, at = files._at(f"{path}/stream")
    out = fs.create(at, True)
    out.write(bytearray(copybinary.HEADER))
    for r in spark.read.parquet(f"{path}/parts").select("copy").toLocalIterator():
        out.write(r.copy if isinstance(r.copy, bytearray) else bytearray(r["copy"]))
    out.write(bytearray(copybinary.TRAILER))
    out.close()


def isolated(tables: Iterable[str], step: Callable[[str], object]) -> dict[str, Exception]:
    """Runs ``step`` for each table and gives back the failures."""
    failed = {}
    for table in tables:
        try:
            step(table)
        except Exception as e:
            failed[table] = e
    return failed
