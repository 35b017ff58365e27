"""``spark.read.format("paged_file")``: tables of a paged file as DataFrames.

Options: ``path``; ``table`` (all its columns); ``versions`` = true adds every
stored version with its page, generation, slot, transaction, flags, schema
version and back pointer, instead of the current rows alone; ``relation`` =
``pages``, ``slots`` or ``tables`` lists pages, every slot of them (fragments,
blobs and slots without a record too) or the catalog; ``decimals`` = exact keeps
scaled integers as decimals; ``pages_per_task`` sizes the partitions; and
``resolve`` = true fills a delete stub with the row of its nearest whole back
version.  ``relation`` = ``places`` lists page numbers without opening pages.

The driver reads the catalog and walks the table's pointer pages, each of which
names some thousands of pages; tasks get stretches of them, and seek to the
pages in disk order.  ``changed_versions`` is the scan of a change feed: page
numbers and the generations of the last scan meet by stretches of pages, so
neither the driver nor a task ever holds all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import types as K
from . import pagefile as P

META = T.StructType(
    [
        T.StructField("_page", T.LongType()),
        T.StructField("_gen", T.LongType()),
        T.StructField("_slot", T.IntegerType()),
        T.StructField("_txn", T.LongType()),
        T.StructField("_flags", T.IntegerType()),
        T.StructField("_fmt", T.IntegerType()),
        T.StructField("_back_page", T.LongType()),
        T.StructField("_back_line", T.IntegerType()),
        T.StructField("_whole", T.BooleanType()),
    ]
)
PAGES = T.StructType([T.StructField("page", T.LongType()), T.StructField("gen", T.LongType()), T.StructField("records", T.IntegerType())])
SLOTS = T.StructType(
    [
        T.StructField("page", T.LongType()),
        T.StructField("gen", T.LongType()),
        T.StructField("slot", T.IntegerType()),
        T.StructField("state", T.StringType()),
        T.StructField("length", T.IntegerType()),
        T.StructField("txn", T.LongType()),
        T.StructField("flags", T.IntegerType()),
        T.StructField("fmt", T.IntegerType()),
        T.StructField("back_page", T.LongType()),
        T.StructField("back_line", T.IntegerType()),
    ]
)
TABLES = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("is_view", T.BooleanType()), T.StructField("system", T.IntegerType())])
PLACES = T.StructType([T.StructField("page", T.LongType())])
BATCH = 4096
#: Back versions that a stub's key is looked for in.
DEPTH = 8
#: Successive pages that a change scan decodes at once.
STRETCH = 256


class Layout:
    """A table's columns and its descriptors in every schema version, as the catalog has them."""

    def __init__(self, f: P.PageFile, table: str, decimals: str = "double"):
        self.relation = f.relation_id(table)
        self.formats = f.formats(self.relation)
        latest = self.formats[max(self.formats)]
        try:
            self.columns = f.columns(table)
        except LookupError:
            self.columns = [(k, f"col_{k}") for k in range(len(latest))]
        self.decimals = decimals
        none = K.Field()
        self.latest = [(name.lower(), latest[fid] if fid < len(latest) else none) for fid, name in self.columns]
        self.schema = T.StructType([T.StructField(name, K.spark_type(d, decimals), True, {"ddl": K.ddl_type(d)}) for name, d in self.latest])
        # per version: the descriptors of the columns that it has
        self.by_format = {v: [(fid, ds[fid]) if fid < len(ds) and ds[fid].dtype else None for fid, _ in self.columns] for v, ds in self.formats.items()}

    def decode(self, row: bytes, fmt: int) -> list:
        """Values by the record's own schema version; columns that it lacks are null."""
        slots = self.by_format.get(fmt, self.by_format[max(self.by_format)])
        return [self._fit(s, row, d) if s else None for s, (_, d) in zip(slots, self.latest)]

    def _fit(self, slot: tuple[int, K.Field], row: bytes, latest: K.Field):
        fid, own = slot
        if K.is_null(row, fid):
            return None
        v = K.value(row, own, self.decimals)
        # a column whose type has changed since takes the newer type where that keeps the value
        kind = K.spark_type(latest, self.decimals)
        if v is None or K.spark_type(own, self.decimals) == kind:
            return v
        if isinstance(kind, T.StringType):
            return str(v)
        if isinstance(kind, (T.DoubleType, T.FloatType)) and isinstance(v, (int, float)):
            return float(v)
        if isinstance(kind, (T.IntegerType, T.LongType)) and isinstance(v, int) and not isinstance(v, bool):
            return v
        return None


class PageRange(InputPartition):
    """Stretches (pointer page, from, to) of the entries of pointer pages."""

    def __init__(self, stretches: list[tuple[int, int, int]]):
        self.stretches = stretches


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_file"

    def _layout(self) -> Layout:
        with P.PageFile(self.options["path"]) as f:
            return Layout(f, self.options["table"], self.options.get("decimals", "double"))

    def _versions(self) -> bool:
        return self.options.get("versions", "false").lower() == "true"

    def schema(self) -> T.StructType:
        if "relation" in self.options:
            return {"pages": PAGES, "places": PLACES, "slots": SLOTS, "tables": TABLES}[self.options["relation"]]
        own = self._layout().schema
        return T.StructType([*META, *own]) if self._versions() else own

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return PagedReader(dict(self.options), schema, self._versions())


class PagedReader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType, versions: bool):
        self.path, self.options, self.schema, self.versions = options["path"], options, schema, versions
        self.kind = options.get("relation")
        self.layout = None
        if not self.kind:
            with P.PageFile(self.path) as f:
                self.layout = Layout(f, options["table"], options.get("decimals", "double"))

    def partitions(self) -> list[InputPartition]:
        if self.kind == "tables":
            return [PageRange([])]
        with P.PageFile(self.path) as f:
            rid = f.relation_id(self.options["table"]) if "table" in self.options else self.layout.relation
            most, step = (f.page_size - 32) // 4, int(self.options.get("pages_per_task", 4096))
            stretches = [(n, k, min(k + step, most)) for n, _ in f.pointers(f.first_pointer(rid) or 0) for k in range(0, most, step)]
        each = max(1, step // most)
        return [PageRange(stretches[k : k + each]) for k in range(0, len(stretches), each)] or [PageRange([])]

    def read(self, partition: PageRange) -> Iterator[pa.RecordBatch]:
        schema, rows = to_arrow_schema(self.schema), []
        with P.PageFile(self.path) as f:
            pages = sorted(n for at, a, b in partition.stretches for n in f.pointed(f.page(at), a, b))
            for row in self._rows(f, pages, {}):
                rows.append(row)
                if len(rows) == BATCH:
                    yield self._batch(rows, schema)
                    rows = []
        if rows:
            yield self._batch(rows, schema)

    def decoded(self, pages: list[int], known: dict[int, int]) -> pa.Table:
        """The rows of some pages; of those whose generation is ``known``, delete stubs alone."""
        schema = to_arrow_schema(self.schema)
        with P.PageFile(self.path) as f:
            rows = list(self._rows(f, pages, known))
        return pa.Table.from_batches([self._batch(rows, schema)] if rows else [], schema)

    @staticmethod
    def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    @staticmethod
    def _back(f: P.PageFile, v: P.Version) -> tuple[bytes | None, int]:
        """The row and schema version of a stub's nearest whole back version."""
        page, line = v.back_page, v.back_line
        for _ in range(DEPTH):
            raw = f.slot(page, line) if page else None
            if raw is None or len(raw) < 13:
                break
            flags, fmt = int.from_bytes(raw[10:12], "little"), raw[12]
            row = f.payload(P.Version(page, line, 0, flags, fmt, 0, 0, raw))
            if row is not None:
                return row, fmt
            if not flags & (P.CHAIN | P.DELETED):
                break
            page, line = int.from_bytes(raw[4:8], "little"), int.from_bytes(raw[8:10], "little")
        return None, v.fmt

    def _rows(self, f: P.PageFile, pages: list[int], known: dict[int, int]) -> Iterator[list]:
        if self.kind == "tables":
            yield from map(list, f.relations())
            return
        hidden = P.DELETED | P.CHAIN | P.FRAGMENT | P.BLOB
        resolve = self.options.get("resolve", "false").lower() == "true"
        for n in pages:
            if self.kind == "places":
                yield [n]
                continue
            body = f.page(n)
            if body[0] != P.DATA:
                continue
            gen = int.from_bytes(body[4:8], "little")
            if self.kind == "pages":
                yield [n, gen, sum(1 for _ in f.slots(body))]
                continue
            if self.kind == "slots":
                records = {v.slot: v for v in f.versions(n, body)}
                for s, at, size in f.entries(body):
                    if v := records.get(s):
                        yield [n, gen, s, "record", size, v.txn, v.flags, v.fmt, v.back_page, v.back_line]
                    else:
                        state = "empty" if not (at and size) else "outside" if at + size > len(body) else "short"
                        yield [n, gen, s, state, size, None, None, None, None, None]
                continue
            for v in f.versions(n, body):
                if self.versions:
                    deleted = v.flags & P.DELETED
                    if v.flags & (P.FRAGMENT | P.BLOB) or known.get(n) == gen and not deleted:
                        continue
                    row, fmt = self._back(f, v) if deleted and resolve else (f.payload(v), v.fmt)
                    values = self.layout.decode(row, fmt) if row else [None] * len(self.layout.columns)
                    yield [n, gen, v.slot, v.txn, v.flags, v.fmt, v.back_page, v.back_line, row is not None, *values]
                elif not v.flags & hidden and (row := f.payload(v)) is not None:
                    yield self.layout.decode(row, v.fmt)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PagedSource)


def changed_versions(spark: SparkSession, path: str, table: str, known: DataFrame, **options) -> DataFrame:
    """All versions on pages whose generation isn't the ``known`` one (page, gen), and the delete stubs of the others, resolved."""
    register(spark)
    places = spark.read.format("paged_file").options(path=path, table=table, relation="places").load()
    source = PagedSource({"path": path, "table": table, "versions": "true", "resolve": "true", **options})
    reader = PagedReader(source.options, source.schema(), True)

    def decode(now: pa.Table, was: pa.Table) -> pa.Table:
        return reader.decoded(sorted(now.column("page").to_pylist()), dict(zip(was.column("page").to_pylist(), was.column("gen").to_pylist())))

    stretch = F.expr(f"page div {STRETCH}").alias("stretch")
    now, was = places.select(stretch, "page"), known.select(stretch, "page", "gen")
    return now.groupBy("stretch").cogroup(was.groupBy("stretch")).applyInArrow(decode, reader.schema)
