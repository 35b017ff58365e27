"""Queries that run the engine over a paged file: customers, 40 keys to a page, and what a feed makes of them.

A first transaction stores them all.  A second one, on each third page alone,
deletes keys divisible by 7 (every other one leaves a stub, the rest nothing)
and raises the balance of those divisible by 5.
"""

from __future__ import annotations

import os
import struct
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import types as K
from ..sources import pagefile as P
from ..sources.pagewriter import Builder, data_page, put_generation, put_pages, record, row, varying
from ..streaming.feed import ChangeFeed, TableSink
from .load import read_table
from .scratch import folder
from .state import StateStore
from .table import VersionedTable

PER_PAGE, FIRST_PAGE, SIZE = 40, 3, 8192
FIELDS = [("CUSTKEY", K.Field(K.INT64, 0, 8, offset=8)), ("NAME", K.Field(K.VARYING, 0, 42, offset=16)), ("NATIONKEY", K.Field(K.LONG, 0, 4, offset=60)), ("ACCTBAL", K.Field(K.DOUBLE, 0, 8, offset=64))]
_CHANGED = "(c_custkey // 40) % 3 = 0"
_GONE = f"({_CHANGED} AND c_custkey % 7 = 0)"


class Customers:
    """The file in a folder that tasks share, and a feed of it into a table.

    Pages of keys get successive numbers, whatever lies between the keys; tasks
    encode them and write them to their places, so the driver holds pointers only:
    the planner, which goes by a file's compressed bytes, may broadcast no side of a join.
    """

    def __init__(self, spark: SparkSession, d: str):
        self.spark, at = spark, folder(spark, "paged")
        self.rows = spark.read.parquet(f"{d}/customer.parquet").select(F.expr(f"coalesce(c_custkey div {PER_PAGE}, 0)").alias("page"), "c_custkey", "c_name", "c_nationkey", "c_acctbal")
        local = at.removeprefix("file://").removeprefix("file:")
        os.makedirs(local, exist_ok=True)
        self.path, self.to, self.state = f"{local}/customers", f"{at}/to", StateStore(spark, f"{at}/state")
        self.target = VersionedTable(spark, f"{self.to}/customer", ["custkey"])
        self.numbers, room = self._numbered(f"{at}/pages")
        Builder(self.path, size=SIZE).table(130, "CUSTOMER", FIELDS, ["CUSTKEY"], room=room).write()
        self._put(self.rows, 1)

    def feed(self) -> ChangeFeed:
        return ChangeFeed(self.spark, self.path, TableSink(self.spark, self.to), self.state)

    @staticmethod
    def poll(feed: ChangeFeed) -> dict[str, dict]:
        """One cycle.  A feed sets a table that fails aside and goes on; a query has no rows to give then, so it fails."""
        found = feed.poll()
        for e in feed.failed.values():
            raise e
        return found

    def _numbered(self, path: str) -> tuple[DataFrame, int]:
        """(page, number) of all pages of keys, in order, with numbers that follow each other in the file; and how many they are."""
        self.rows.select("page").distinct().repartitionByRange("page").withColumn("part", F.spark_partition_id()).write.parquet(path)
        pages, starts, n = self.spark.read.parquet(path), [], 0
        for part, count in sorted(map(tuple, pages.groupBy("part").count().collect())):  # a row for each task
            starts.append((part, n + FIRST_PAGE))
            n += count
        place = F.row_number().over(Window.partitionBy("part").orderBy("page")) - 1
        return pages.join(F.broadcast(self.spark.createDataFrame(starts, "part int, start long")), "part").select("page", (F.col("start") + place).alias("number")), n

    def _put(self, rows: DataFrame, txn: int) -> None:
        """Pages as a transaction leaves them."""
        path = self.path

        def put(batches):
            each = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)))
            pages = ((number, data_page(SIZE, _slots(txn, number, [r[1:] for r in held]), txn)) for number, held in groupby(each, itemgetter(0)))
            yield pa.record_batch({"pages": pa.array([put_pages(path, pages)], pa.int64())})

        placed = rows.join(self.numbers.hint("merge"), "page").select("number", "c_custkey", "c_name", "c_nationkey", "c_acctbal")
        placed.repartitionByRange("number").sortWithinPartitions("number", "c_custkey").mapInArrow(put, "pages long").agg(F.sum("pages")).collect()

    def write(self, generation: int, second: bool = False) -> None:
        if second:
            self._put(self.rows.where("page % 3 = 0"), 2)
        put_generation(self.path, generation)


def _slots(txn: int, number: int, rows: list[tuple]) -> list[bytes]:
    """A page's records after the first transaction, or the second."""
    slots = []
    for r in rows:
        if txn == 2 and r[0] % 7 == 0:
            if r[0] % 14 == 0:
                slots += [record(2, b"", P.DELETED, 1, (number, len(slots) + 1)), _stored(1, r, P.CHAIN)]
        elif txn == 2 and r[0] % 5 == 0:
            slots.append(_stored(2, (*r[:3], None if r[3] is None else r[3] + 1)))
        else:
            slots.append(_stored(1, r))
    return slots


def _stored(txn: int, r: tuple, flags: int = 0) -> bytes:
    key, name, nation, balance = r
    values = [struct.pack("<q", key), None if name is None else varying(name), None if nation is None else struct.pack("<i", nation), None if balance is None else struct.pack("<d", balance)]
    return record(txn, row([f for _, f in FIELDS], values), flags, 1)


def paged_snapshot(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, Customers(spark, d).path, "customer")


def noop_cycle(spark: SparkSession, d: str) -> DataFrame:
    """A file whose counter moved and nothing else: the scan finds nothing, and the target gets no version."""
    c = Customers(spark, d)
    c.poll(c.feed())
    before = c.target.version
    c.write(2)
    found = c.poll(c.feed())["CUSTOMER"]
    pages = c.state.load("customer").page_gens.agg(F.count(F.lit(1)).alias("pages"))
    return pages.select(F.lit(found["upserts"]).cast("long").alias("upserts"), F.lit(found["deletes"]).cast("long").alias("deletes"), F.lit(c.target.version - before).cast("long").alias("versions"), "pages")


def stream_trigger(spark: SparkSession, d: str) -> DataFrame:
    """Polls fire when the file's counter differs from the last one seen; the first always does."""
    c, rows = Customers(spark, d), []
    feed = c.feed()
    for poll in range(1, 5):
        if poll == 3:
            c.write(2, second=True)
        found = c.poll(feed)
        counts = found.get("CUSTOMER", {"upserts": 0, "deletes": 0})
        rows.append((poll, bool(found), counts["upserts"], counts["deletes"]))
    return spark.createDataFrame(rows, "poll int, fired boolean, upserts long, deletes long")


def _after(spark: SparkSession, d: str) -> Customers:
    c = Customers(spark, d)
    feed = c.feed()
    c.poll(feed)
    c.write(2, second=True)
    c.poll(feed)
    return c


def snapshot_advance(spark: SparkSession, d: str) -> DataFrame:
    """The keys that the state remembers by page, after both transactions."""
    c = _after(spark, d)
    keys = c.state.load("customer").keys.select(F.col("page").alias("number"), F.col("custkey").alias("pk"))
    return keys.join(c.numbers.hint("merge"), "number", "left").select("page", "pk")


def paged_feed(spark: SparkSession, d: str) -> DataFrame:
    """The feed's target after both transactions."""
    return _after(spark, d).target.read()


_COLUMNS = "c_custkey AS custkey, c_name AS name, c_nationkey AS nationkey"
QUERIES = {f.__name__: f for f in (paged_snapshot, noop_cycle, stream_trigger, snapshot_advance, paged_feed)}
SQL = {
    "paged_snapshot": f"SELECT {_COLUMNS}, c_acctbal AS acctbal FROM customer",
    "noop_cycle": "SELECT CAST(0 AS BIGINT) AS upserts, CAST(0 AS BIGINT) AS deletes, CAST(0 AS BIGINT) AS versions, count(DISTINCT c_custkey // 40) AS pages FROM customer",
    "stream_trigger": f"""SELECT 1 AS poll, true AS fired, count(*) AS upserts, CAST(0 AS BIGINT) AS deletes FROM customer
UNION ALL SELECT 2, false, 0, 0
UNION ALL SELECT 3, true, count(*) FILTER (WHERE {_CHANGED} AND c_custkey % 5 = 0 AND c_custkey % 7 <> 0), count(*) FILTER (WHERE {_GONE}) FROM customer
UNION ALL SELECT 4, false, 0, 0""",
    "snapshot_advance": f"SELECT c_custkey // 40 AS page, c_custkey AS pk FROM customer WHERE NOT {_GONE}",
    "paged_feed": f"SELECT {_COLUMNS}, c_acctbal + CASE WHEN {_CHANGED} AND c_custkey % 5 = 0 THEN 1 ELSE 0 END AS acctbal FROM customer WHERE NOT {_GONE}",
}
