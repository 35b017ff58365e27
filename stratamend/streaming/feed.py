"""The change feed: scan, apply, advance; and replays of it as Structured Streaming.

``ChangeFeed`` polls a paged file.  Its stream form uses a source whose offset
is the file's header counter, so a micro-batch runs only when the file has
changed; the batch lists tables and schema versions anew, so tables that
appear later and new columns are found.
"""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming import StreamingQuery

from ..operators import changes, versions
from ..plans.files import Files
from ..plans.load import isolated, read_pages, read_table
from ..plans.state import StateStore
from ..plans.table import VersionedTable
from ..plans.tenants import ensure_database
from ..sources import pagefile as P
from ..sources.paged import changed_versions

LOG = logging.getLogger("stratamend")


class Sink(Protocol):
    """Where change sets go.  ``apply`` must be idempotent: a set may come again after a crash."""

    def apply(self, table: str, key: list[str], upserts: DataFrame, deletes: DataFrame) -> None: ...

    def reconnect(self) -> None: ...


class TableSink:
    """Merges into versioned tables under a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def apply(self, table: str, key: list[str], upserts: DataFrame, deletes: DataFrame) -> None:
        VersionedTable(self.spark, f"{self.path}/{table.lower()}", key).apply(upserts, deletes)

    def reconnect(self) -> None:
        pass


class LandingSink:
    """Leaves change sets as files for a tenant's gateway, which applies them in order.

    A set's ``_META`` is written last: without it the set isn't there yet.
    """

    def __init__(self, spark: SparkSession, path: str, tenant: str):
        self.spark, self.path, self.files = spark, f"{path.rstrip('/')}/tenant={tenant}", Files(spark)

    def _leave(self, table: str, key: list[str], parts: dict[str, DataFrame]) -> None:
        at = f"{self.path}/{table.lower()}/{time.time_ns():020d}"
        for name, df in parts.items():
            df.write.parquet(f"{at}/{name}")
        self.files.replace(f"{at}/_META", json.dumps({"table": table.lower(), "key": key, "parts": sorted(parts)}))

    def apply(self, table: str, key: list[str], upserts: DataFrame, deletes: DataFrame) -> None:
        self._leave(table, key, {"upserts": upserts, "deletes": deletes.select(*key)})

    def full(self, table: str, key: list[str], rows: DataFrame) -> None:
        """A whole table, which the gateway swaps in."""
        self._leave(table, key, {"full": rows})

    def reconnect(self) -> None:
        pass


class Gateway:
    """Applies what tenants left to their databases; what an unknown tenant left is refused and stays."""

    def __init__(self, spark: SparkSession, path: str, registry: dict[str, str], target: str):
        self.spark, self.path, self.registry, self.target, self.files = spark, path.rstrip("/"), registry, target.rstrip("/"), Files(spark)

    def poll(self) -> tuple[int, list[str]]:
        """(sets applied, tenants refused).  A set is removed once it is applied, so a crash applies it again."""
        done, refused = 0, []
        for folder in self.files.children(self.path):
            tenant = folder.removeprefix("tenant=")
            if not folder.startswith("tenant="):
                continue
            if tenant not in self.registry:
                refused.append(tenant)
                continue
            if ensure_database(self.spark, self.registry[tenant], self.target):
                LOG.info("database %s made for tenant %s", self.registry[tenant], tenant)
            for table in self.files.children(f"{self.path}/{folder}"):
                for name in self.files.children(f"{self.path}/{folder}/{table}"):
                    at = f"{self.path}/{folder}/{table}/{name}"
                    meta = self.files.read(f"{at}/_META")
                    if meta is None:
                        break  # still being written: later sets wait for it
                    body = json.loads(meta)
                    to = VersionedTable(self.spark, f"{self.target}/{self.registry[tenant]}/{table}", body["key"])
                    read = lambda part: self.spark.read.parquet(f"{at}/{part}")  # noqa: E731, B023
                    if "full" in body["parts"]:
                        to.swap(read("full"))
                    else:
                        to.apply(read("upserts"), read("deletes"))
                    self.files.delete(at)
                    done += 1
        return done, refused


class ChangeFeed:
    def __init__(self, spark: SparkSession, path: str, sink: Sink, state: StateStore, tables: list[str] | None = None):
        self.spark, self.path, self.sink, self.state, self.only = spark, path, sink, state, tables
        self.last: int | None = None
        self.failed: dict[str, Exception] = {}
        self.keyless: set[str] = set()
        #: Of each table's last scan: seconds in which pages were decoded, and seconds of the sink.
        self.timings: dict[str, dict[str, float]] = {}

    def tables(self) -> dict[str, list[str]]:
        """Tables with a primary key, and the key; tables without one aren't followed, and are warned of once."""
        out = {}
        with P.PageFile(self.path) as f:
            for table in self.only or f.tables():
                try:
                    out[table] = [k.lower() for k in f.key(table)]
                except LookupError as e:
                    if table not in self.keyless:
                        self.keyless.add(table)
                        LOG.warning("table %s is not followed: %s", table, e)
        return out

    def sync(self, table: str, key: list[str], generation: int) -> dict:
        """One table: scan, apply unless there is nothing, then advance the state."""
        was = self.state.load(table)
        if was.generation == generation and was.page_gens is not None:
            return {"upserts": 0, "deletes": 0}
        pages = read_pages(self.spark, self.path, table).persist()
        if was.page_gens is not None and was.keys is not None:
            seen = changed_versions(self.spark, self.path, table, was.page_gens)  # of unchanged pages only delete stubs are decoded
        else:
            seen = read_table(self.spark, self.path, table, versions=True, resolve="true")
        seen = seen.persist()  # decoded once: the scan's branches share it
        try:
            began = time.perf_counter()
            seen.count()
            decoded = time.perf_counter()
            found = changes.scan(seen, key, was.watermark, was.page_gens, was.keys, pages=pages, resolved=True)
            n = {"upserts": found.upserts.count(), "deletes": found.deletes.count()}
            sunk = time.perf_counter()
            if any(n.values()):
                self.sink.apply(table, key, found.upserts, found.deletes)
            self.timings[table] = {"decode_s": decoded - began, "sink_s": time.perf_counter() - sunk}
            LOG.info("table %s: %d upserts, %d deletes; decoded in %.3f s, applied in %.3f s", table, *n.values(), *self.timings[table].values())
            self.state.save(table, found.stats.first()["max_txn"], generation, found.page_gens, found.keys, found.touched if was.page_gens is not None else None)
            return n
        finally:
            seen.unpersist()
            pages.unpersist()

    def poll(self) -> dict[str, dict]:
        """One cycle: nothing unless the file has changed since the last; a table that fails is tried again."""
        with P.PageFile(self.path) as f:
            generation = f.generation()
        if generation == self.last and not self.failed:
            return {}
        out: dict[str, dict] = {}

        def step(table: str) -> None:
            out[table] = self.sync(table, keys[table], generation)

        keys = self.tables()
        self.failed = isolated(keys, step)
        if self.failed:
            self.sink.reconnect()
        self.last = generation
        return out

    def watch(self, interval: float = 5.0, cycles: int | None = None, stop: Callable[[], bool] = lambda: False) -> None:
        """Polls every ``interval`` seconds, one at least."""
        done = 0
        while not stop() and (cycles is None or done < cycles):
            self.poll()
            done += 1
            until = time.monotonic() + max(1.0, interval)
            while time.monotonic() < until and not stop() and (cycles is None or done < cycles):
                time.sleep(0.1)


class GenerationSource(DataSource):
    """A stream with a row for each change of a paged file's header counter (option ``path``)."""

    @classmethod
    def name(cls) -> str:
        return "paged_file_changes"

    def schema(self) -> str:
        return "generation long"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return GenerationReader(self.options["path"])


class GenerationReader(SimpleDataSourceStreamReader):
    def __init__(self, path: str):
        self.path = path

    def initialOffset(self) -> dict:
        return {"generation": -1}

    def read(self, start: dict):
        with P.PageFile(self.path) as f:
            now = f.generation()
        return iter([(now,)] if now != start["generation"] else []), {"generation": now}

    def readBetweenOffsets(self, start: dict, end: dict):
        return iter([(end["generation"],)] if end != start else [])


def stream(feed: ChangeFeed, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """The feed as a streaming query; without ``interval`` it handles what is there and ends."""
    spark = feed.spark
    spark.dataSource.register(GenerationSource)
    rows = spark.readStream.format("paged_file_changes").option("path", feed.path).load()

    def batch(df: DataFrame, _: int) -> None:
        if not df.isEmpty():
            feed.last = None
            feed.poll()

    writer = rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def replay(spark: SparkSession, folder: str, schema: str, key: list[str], order: list[str], target: VersionedTable, checkpoint: str, files: int = 1) -> None:
    """A folder of change files, in the order of their names' times, merged batch by batch: the last by ``order`` of each key stays."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)

    def batch(df: DataFrame, _: int) -> None:
        fresh = versions.winners(df, key, order)
        if target.version:
            # an older change that comes late doesn't replace a newer one
            old = target.read(keys=fresh).select(*key, F.struct(*order).alias("_was"))
            fresh = fresh.join(old, key, "left").where(F.col("_was").isNull() | (F.struct(*order) > F.col("_was"))).drop("_was")
        target.apply(fresh, fresh.limit(0))

    rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
