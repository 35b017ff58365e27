"""A keyed table of Parquet files whose versions are swapped atomically.

A version is a base, dealt into buckets by a hash of the key, and the change
sets since: each has the rows that it adds and the keys that it drops.  A
change set costs what it holds; readers join the dropped keys with the base.
When change sets are many they become one, and when they are no longer small
beside the base, the base is written anew, with as many buckets as its bytes
then ask for.

Every version has a manifest of its own number, which only one writer can
create: a writer that finds its number taken starts from the newer version, so
no update is lost.  Readers always see one whole version, and a writer that
dies leaves nothing visible.
"""

from __future__ import annotations

import functools
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import Files

#: Bytes of a bucket of the base, and of the change sets that are kept beside any base, however small.
BUCKET_BYTES, LEAST_BYTES = 64 << 20, 16 << 20
#: Change sets beside a base, and the share of its bytes that they may have.
SETS, SHARE = 8, 10


class Conflict(RuntimeError):
    """Other writers were faster, again and again."""


class VersionedTable:
    TRIES, KEEP = 20, 5

    def __init__(self, spark: SparkSession, path: str, key: list[str], buckets: int | None = None):
        """``buckets`` fixes their number; else it follows the size."""
        self.spark, self.path, self.key, self.files, self.buckets = spark, path.rstrip("/"), key, Files(spark), buckets

    # manifests

    def _numbers(self) -> list[int]:
        return [int(n) for n in self.files.children(f"{self.path}/_versions") if n.isdigit()]

    def manifest(self) -> dict | None:
        numbers = self._numbers()
        return json.loads(self.files.read(f"{self.path}/_versions/{max(numbers):020d}")) if numbers else None

    @property
    def version(self) -> int:
        return max(self._numbers(), default=0)

    def _commit(self, make) -> int:
        """``make`` gives the manifest that follows another, or that one itself."""
        for _ in range(self.TRIES):
            was = self.manifest()
            new = make(was)
            if new is was:
                return was["version"]
            if self.files.create(f"{self.path}/_versions/{new['version']:020d}", json.dumps(new)):
                for n in self._numbers():
                    if n <= new["version"] - self.KEEP:
                        self.files.delete(f"{self.path}/_versions/{n:020d}")
                return new["version"]
        raise Conflict(self.path)

    # reading

    def _bucket(self, n: int) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(n)).cast("int") if self.key else F.lit(0)

    def _parquet(self, paths: list[str], schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{p}" for p in paths)) if paths else self.spark.createDataFrame([], schema)

    def read(self, manifest: dict | None = None, keys: DataFrame | None = None) -> DataFrame:
        """The current version, or that of a ``manifest``; of the buckets that hold some ``keys`` only, if they are given."""
        m = manifest or self.manifest()
        if m is None:
            raise FileNotFoundError(f"{self.path} has no version yet")
        schema, paths = T.StructType.fromJson(m["schema"]), m["paths"]
        if keys is not None and len(paths) > 1:
            held = {str(r[0]) for r in keys.select(self._bucket(m["buckets"]).alias("b")).distinct().collect()}  # at most as many as there are buckets
            paths = {b: p for b, p in paths.items() if b in held}
        base = self._parquet(list(paths.values()), schema)
        return self._merged(m, base, 0) if m["sets"] else base

    def _merged(self, m: dict, rows: DataFrame, first: int) -> DataFrame:
        """``rows`` of the layer ``first`` and the change sets from there on: a row stays unless a later set drops its key."""
        schema = rows.schema
        layer, drop = self._free(schema, "layer"), self._free(schema, "drop")
        every = rows.withColumn(layer, F.lit(first))
        for k, s in enumerate(m["sets"], 1):
            if k > first:
                every = every.unionByName(self._parquet([s["adds"]], schema).withColumn(layer, F.lit(k)))
        gone = self._dropped(m, schema, first).groupBy(*self.key).agg(F.max("set").alias(drop))
        return every.join(gone, self.key, "left").where(F.coalesce(F.col(drop), F.lit(0)) <= F.col(layer)).select(*schema.names)

    def _dropped(self, m: dict, schema: T.StructType, first: int) -> DataFrame:
        keys = T.StructType([schema[k] for k in self.key])
        parts = [self._parquet([s["drops"]], keys).withColumn("set", F.lit(k)) for k, s in enumerate(m["sets"], 1) if k > first]
        return functools.reduce(DataFrame.unionByName, parts)

    @staticmethod
    def _free(schema: T.StructType, name: str) -> str:
        while name.lower() in {c.lower() for c in schema.names}:
            name = f"_{name}"
        return name

    # writing

    def _write(self, df: DataFrame, buckets: int) -> tuple[str, list[int]]:
        """Rows under a new folder, a sub-folder for each bucket."""
        name = f"v-{uuid.uuid4().hex}"
        column = self._free(df.schema, "_bucket")
        parted = df.withColumn(column, self._bucket(buckets))
        # one shuffle by bucket; a rebalance may cut a large bucket into several files
        parted.hint("rebalance", column).write.partitionBy(column).parquet(f"{self.path}/{name}")
        return name, [int(c.split("=")[1]) for c in self.files.children(f"{self.path}/{name}") if c.startswith(f"{column}=")]

    def _expected(self, df: DataFrame) -> int:
        """Buckets for rows that aren't written yet, by the planner's estimate; it multiplies the sides of a join, so no more than for all that is read."""
        plan = df._jdf.queryExecution().optimizedPlan()
        leaves = plan.collectLeaves()
        sizes = [plan, *(leaves.apply(k) for k in range(leaves.size()))]
        size, *read = (int(str(p.stats().sizeInBytes())) for p in sizes)
        size = min(size, sum(read))
        return 16 if size >> 50 else size // BUCKET_BYTES + 1

    def staged_swap(self, df: DataFrame, version: int = 1, buckets: int | None = None) -> dict:
        """The whole table anew, written but not current: its manifest."""
        n = self.buckets or buckets or self._expected(df)
        name, held = self._write(df, n)
        paths = {str(b): f"{name}/{self._free(df.schema, '_bucket')}={b}" for b in held}
        return {"version": version, "buckets": n, "schema": df.schema.jsonValue(), "paths": paths, "bytes": self.files.size(f"{self.path}/{name}"), "sets": []}

    def _set(self, adds: DataFrame, drops: DataFrame) -> dict:
        name = f"v-{uuid.uuid4().hex}"
        for part, df in (("adds", adds), ("drops", drops)):
            df.hint("rebalance").write.parquet(f"{self.path}/{name}/{part}")
        return {"adds": f"{name}/adds", "drops": f"{name}/drops", "bytes": self.files.size(f"{self.path}/{name}")}

    def _change(self, schema: T.StructType, upserts: DataFrame, deletes: DataFrame) -> dict | None:
        keys = upserts.select(*self.key).unionByName(deletes.select(*self.key)).distinct()
        fit = T.StructType([schema[k] for k in self.key])
        made = self._set(upserts.select(*(F.col(f.name).cast(f.dataType) for f in schema)), keys.select(*(F.col(f.name).cast(f.dataType) for f in fit)))
        return None if self._parquet([made["drops"]], fit).isEmpty() else made

    def _followed(self, m: dict, change: dict) -> dict:
        """The manifest after a change set; sets are put together, or into the base, where they have become many or large."""
        new = m | {"version": m["version"] + 1, "sets": [*m["sets"], change]}
        size = sum(s["bytes"] for s in new["sets"])
        if size > max(LEAST_BYTES, m["bytes"] // SHARE):
            return self.staged_swap(self.read(new), new["version"], (m["bytes"] + size) // BUCKET_BYTES + 1)
        if len(new["sets"]) >= SETS:
            schema = T.StructType.fromJson(m["schema"])
            adds = self._merged(new, self._parquet([new["sets"][0]["adds"]], schema), 1)
            new["sets"] = [self._set(adds, self._dropped(new, schema, 0).select(*self.key).distinct())]
        return new

    def staged(self, m: dict, upserts: DataFrame, deletes: DataFrame) -> dict:
        """A change set over the version of a manifest, written but not current: the new manifest, or the same if there is no change."""
        change = self._change(T.StructType.fromJson(m["schema"]), upserts, deletes)
        return self._followed(m, change) if change else m

    def swap(self, df: DataFrame) -> int:
        """The whole table anew."""
        new = self.staged_swap(df)
        return self._commit(lambda was: new | {"version": was["version"] + 1 if was else 1})

    def apply(self, upserts: DataFrame, deletes: DataFrame) -> int:
        """A change set.  Applying it again changes nothing."""
        m = self.manifest()
        if m is None:
            new = self.staged_swap(upserts)
            if self.files.create(f"{self.path}/_versions/{1:020d}", json.dumps(new)):
                return 1
            m = self.manifest()
        change = self._change(T.StructType.fromJson(m["schema"]), upserts, deletes)
        return self._commit(lambda was: self._followed(was, change)) if change else m["version"]

    def vacuum(self, manifest: dict | None = None) -> None:
        """Drops folders that the current version doesn't use; not while others read older ones, or write."""
        m = manifest or self.manifest() or {"paths": {}, "sets": []}
        used = {p.split("/")[0] for p in [*m["paths"].values(), *(s["drops"] for s in m["sets"])]}
        for name in self.files.children(self.path):
            if name.startswith("v-") and name not in used:
                self.files.delete(f"{self.path}/{name}")
