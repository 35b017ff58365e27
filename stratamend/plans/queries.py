"""One query for each operator over the driver's tables, with SQL that DuckDB runs on the same tables.

The tables hold no paged file, so for the plans over versions keys stand in for
its structure: an order's page, slot, transaction and flags follow from its key
by integer arithmetic.  ``pagedqueries`` writes such a file and reads it.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codecs as C
from ..functions import copybinary, frames
from ..functions import types as K
from ..operators import catalog, changes, merge, versions
from ..streaming import feed
from . import load, pagedqueries, tenants
from .scratch import folder
from .state import StateStore
from .table import VersionedTable

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
MARK = 50000
QUERIES: dict = {}
SQL: dict[str, str] = {}

# the orders as record versions
_V = """(SELECT o_orderkey AS pk, o_orderkey // 64 AS page, o_orderkey % 64 AS slot, (o_orderkey * 7919) % 100000 AS txn,
  CASE WHEN o_orderkey % 17 = 0 THEN 1 WHEN o_orderkey % 13 = 0 THEN 2 ELSE 0 END AS flags,
  o_orderkey // 64 + CASE WHEN (o_orderkey // 64) % 3 = 0 THEN 1 ELSE 0 END AS gen, o_custkey, o_totalprice FROM orders)"""
_CHANGED = "(page % 5 = 0 OR page % 3 = 0)"
_NOW = f"(SELECT page, pk FROM {_V} v WHERE pk % 11 <> 0)"
_RELATIONS = "(VALUES (128, 'ORDERS', false, 0), (129, 'Lineitem', false, 0), (130, 'BIG_ORDERS', true, 0), (6, 'RELS', false, 1), (131, 'CUSTOMER', false, 0), (132, NULL, false, 0)) AS r(id, name, is_view, system)"
_FIELDS = "(VALUES ('ORDERS', 0, 'O_ORDERKEY', 2), ('ORDERS', 1, 'O_CUSTKEY', 0), ('ORDERS', 2, 'O_TOTALPRICE', NULL), ('ORDERS', 3, 'O_STATUS', 1), ('CUSTOMER', 0, 'C_CUSTKEY', 0)) AS f(relation, id, name, position)"
_FORMATS = "(VALUES (128, 1, 'a'), (128, 3, 'c'), (128, 2, 'b'), (131, 1, 'x')) AS f(relation, version, descriptor)"
_CONSTRAINTS = "(VALUES ('ORDERS', 'PRIMARY KEY', 'PK_O'), ('ORDERS', 'NOT NULL', NULL), ('Lineitem', 'Primary Key', 'PK_L'), ('CUSTOMER', 'UNIQUE', 'U_C')) AS c(relation, type, index)"
_SEGMENTS = "(VALUES ('PK_O', 'O_ORDERKEY', 0), ('PK_L', 'L_LINENUMBER', 1), ('PK_L', 'L_ORDERKEY', 0), ('U_C', 'C_NAME', 0)) AS s(index, \"column\", position)"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")


def _values(spark: SparkSession, text: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM {text}".replace('"column"', "`column`"))


def _versions(spark: SparkSession, d: str) -> DataFrame:
    page = F.expr("o_orderkey div 64")
    flags = F.when(F.col("o_orderkey") % 17 == 0, 1).when(F.col("o_orderkey") % 13 == 0, 2).otherwise(0)
    gen = page + F.when(page % 3 == 0, 1).otherwise(0)
    o = _read(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("pk"), page.alias("page"), (F.col("o_orderkey") % 64).alias("slot"), (F.col("o_orderkey") * 7919 % 100000).alias("txn"), flags.alias("flags"), gen.alias("gen"), "o_custkey", "o_totalprice")


def _known(v: DataFrame) -> DataFrame:
    """The generations of the last scan: pages divisible by 5 were not seen."""
    return v.where("page % 5 <> 0").select("page", F.col("page").alias("gen")).distinct()


def _state(v: DataFrame) -> DataFrame:
    return changes.page_changes(v.select("page", "gen").distinct(), _known(v))


def _with_change(v: DataFrame) -> DataFrame:
    return v.join(_state(v).select("page", "changed"), "page")


def _now(v: DataFrame) -> DataFrame:
    return v.where("pk % 11 <> 0").select("page", "pk")


# scans and catalog


@query("SELECT * FROM lineitem")
def full_snapshot(spark, d):
    return _read(spark, d, "lineitem")


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def project_columns(spark, d):
    return _read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")


def _counts(spark, d) -> DataFrame:
    out = None
    for t in TABLES:
        one = _read(spark, d, t).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES)


@query(_COUNTS)
def table_counts(spark, d):
    return _counts(spark, d)


@query(f"SELECT CASE WHEN n_rows = 0 THEN 'EMPTY' ELSE 'OK' END AS status, count(*) AS tables, CAST(sum(n_rows) AS BIGINT) AS rows, CAST(sum(n_rows * 1000) AS BIGINT) AS nanos, CAST(sum(n_rows * 8) AS BIGINT) AS bytes, '1000000 rows/s  7.6 MB/s' AS rate FROM ({_COUNTS}) GROUP BY 1")
def throughput_report(spark, d):
    rows = _counts(spark, d).select(F.col("table_name").alias("table"), F.when(F.col("n_rows") == 0, "EMPTY").otherwise("OK").alias("status"), F.col("n_rows").alias("rows"), (F.col("n_rows") * 1000).alias("nanos"), (F.col("n_rows") * 8).alias("bytes"))
    return load.report(rows)


@query(f"SELECT DISTINCT page FROM {_V} v ORDER BY page")
def page_enumeration(spark, d):
    return _versions(spark, d).select("page").distinct().orderBy("page")


@query("SELECT o_orderkey FROM orders WHERE (o_orderkey * 37) % 4096 <> 0 AND o_orderkey % 40 >= 13 AND (o_orderkey * 37) % 4096 + o_orderkey % 40 <= 4096")
def slot_validity(spark, d):
    return _read(spark, d, "orders").where(versions.slot_valid(F.col("o_orderkey") * 37 % 4096, F.col("o_orderkey") % 40, 4096)).select("o_orderkey")


@query(f"SELECT a.pk AS pk, b.pk AS back_pk, b.o_totalprice AS back_price FROM {_V} a JOIN {_V} b ON b.page = a.page AND b.slot = (a.slot * 3 + 1) % 64 WHERE a.flags = 1")
def slot_point_join(spark, d):
    v = _versions(spark, d)
    back = v.select(F.col("page").alias("p"), F.col("slot").alias("s"), F.col("pk").alias("back_pk"), F.col("o_totalprice").alias("back_price"))
    return v.where("flags = 1").join(back, F.expr("p = page AND s = (slot * 3 + 1) % 64")).select("pk", "back_pk", "back_price")


@query(f"SELECT id, name FROM {_RELATIONS} WHERE upper(name) = 'LINEITEM'")
def catalog_point_lookup(spark, d):
    return catalog.relation(_values(spark, _RELATIONS), "lineitem").select("id", "name")


@query(f"SELECT name FROM {_RELATIONS} WHERE name IS NOT NULL AND NOT is_view AND system = 0 ORDER BY name")
def list_tables(spark, d):
    return catalog.tables(_values(spark, _RELATIONS))


@query(f"SELECT type FROM {_CONSTRAINTS} WHERE upper(relation) = 'ORDERS'")
def list_constraints(spark, d):
    return catalog.constraint_types(_values(spark, _CONSTRAINTS), "orders")


@query(f"SELECT coalesce(position, id) AS place, id, name FROM {_FIELDS} WHERE upper(relation) = 'ORDERS' ORDER BY place, id")
def column_order(spark, d):
    return catalog.columns(_values(spark, _FIELDS), "orders")


@query(f"SELECT relation, max(version) AS version, arg_max(descriptor, version) AS descriptor FROM {_FORMATS} GROUP BY relation")
def latest_format(spark, d):
    return catalog.latest_format(_values(spark, _FORMATS))


@query(f"SELECT c.relation, s.\"column\", s.position FROM {_CONSTRAINTS} JOIN {_SEGMENTS} ON c.index = s.index WHERE upper(c.type) = 'PRIMARY KEY'")
def pk_lookup_join(spark, d):
    return catalog.key_columns(_values(spark, _CONSTRAINTS), _values(spark, _SEGMENTS))


@query(f"SELECT pk, flags, flags & 1 <> 0 AS deleted, flags & 2 <> 0 AS chain, flags & 4 <> 0 AS fragment, flags & 8 <> 0 AS incomplete, flags & 16 <> 0 AS blob FROM {_V} v")
def inspect_flags(spark, d):
    return _versions(spark, d).select("pk", "flags", *versions.flag_columns(F.col("flags")))


@query("SELECT o_orderkey, o_orderkey // 239 AS page, o_orderkey % 239 AS slot FROM orders")
def blob_address(spark, d):
    page, slot = C.blob_place(F.col("o_orderkey"), 4096)
    return _read(spark, d, "orders").select("o_orderkey", page.alias("page"), slot.alias("slot"))


# predicates


@query(f"SELECT pk FROM {_V} v WHERE flags & 31 = 0")
def current_version_filter(spark, d):
    return _versions(spark, d).where(versions.is_current(F.col("flags"))).select("pk")


@query(f"SELECT pk FROM {_V} v WHERE flags & 21 = 0")
def metadata_version_filter(spark, d):
    return _versions(spark, d).where(versions.is_metadata(F.col("flags"))).select("pk")


@query(f"SELECT pk, txn FROM {_V} v WHERE txn > {MARK}")
def watermark_filter(spark, d):
    return _versions(spark, d).where(F.col("txn") > MARK).select("pk", "txn")


@query(f"SELECT page % 7 AS part, greatest(max(txn) FILTER (WHERE flags = 1), {MARK}) AS watermark FROM {_V} v GROUP BY 1")
def effective_watermark(spark, d):
    return _versions(spark, d).groupBy((F.col("page") % 7).alias("part")).agg(F.greatest(F.max(F.when(F.col("flags") == 1, F.col("txn"))), F.lit(MARK).cast("long")).alias("watermark"))


@query(f"SELECT greatest(coalesce(max(txn), {MARK}), {MARK}) AS max_txn FROM {_V} v")
def max_txn(spark, d):
    return _versions(spark, d).agg(F.greatest(F.coalesce(F.max("txn"), F.lit(MARK)), F.lit(MARK)).alias("max_txn"))


@query(f"SELECT page, min(gen) AS gen, bool_or({_CHANGED}) AS changed FROM {_V} v GROUP BY page")
def page_gen_prune(spark, d):
    return _state(_versions(spark, d))


@query(f"SELECT pk, o_totalprice FROM {_V} v WHERE flags = 0 AND txn > {MARK} AND {_CHANGED}")
def change_upserts(spark, d):
    v = _with_change(_versions(spark, d))
    fresh = v.where(versions.is_current(F.col("flags")) & (F.col("txn") > MARK) & F.col("changed")).select("txn", "pk", "o_totalprice")
    return versions.winners(fresh, ["pk"], ["txn"]).select("pk", "o_totalprice")


@query(f"SELECT DISTINCT b.pk FROM {_V} a JOIN {_V} b ON b.page = a.page AND b.slot = (a.slot + 1) % 64 WHERE a.flags = 1 AND a.txn > {MARK} AND b.flags <> 1")
def change_deletes(spark, d):
    """A stub's back version is the next slot; where that is a stub itself, the walk ends without a key."""
    v = _versions(spark, d).select(F.col("page").alias("_page"), F.col("slot").cast("int").alias("_slot"), F.col("txn").alias("_txn"), F.col("flags").alias("_flags"), F.when(F.col("flags") == 1, F.lit(-1).cast("long")).otherwise(F.col("page")).alias("_none"), (F.col("flags") != 1).alias("_whole"), "pk")
    v = v.withColumns({"_back_page": F.lit(0).cast("long"), "_back_line": F.lit(0)})
    stubs = v.where(versions.has(F.col("_flags"), versions.DELETED) & (F.col("_txn") > MARK)).withColumns({"_back_page": F.col("_page") + 1, "_back_line": (F.col("_slot") + 1) % 64})
    shifted = v.withColumn("_page", F.col("_page") + 1)  # page 0 means no back version, so pages count from 1
    found, _ = versions.resolve_stubs(stubs, shifted, ["pk"], 2)
    return found.select("pk").distinct()


@query(
    f"SELECT count(*) FILTER (WHERE flags = 0 AND txn > {MARK} AND {_CHANGED}) AS upserts, count(*) FILTER (WHERE flags = 1 AND txn > {MARK}) AS deletes, count(DISTINCT page) AS pages, count(DISTINCT page) FILTER (WHERE NOT {_CHANGED}) AS pages_skipped, count(*) FILTER (WHERE {_CHANGED} OR flags = 1) AS records_checked FROM {_V} v"
)
def cycle_stats(spark, d):
    v = _with_change(_versions(spark, d))
    up, gone = versions.is_current(F.col("flags")) & (F.col("txn") > MARK) & F.col("changed"), versions.has(F.col("flags"), 1) & (F.col("txn") > MARK)
    # first by page, so that distinct pages need no expansion
    by_page = v.groupBy("page", "changed").agg(F.count_if(up).alias("u"), F.count_if(gone).alias("x"), F.count_if(F.col("changed") | versions.has(F.col("flags"), 1)).alias("r"))
    return by_page.agg(F.sum("u").alias("upserts"), F.sum("x").alias("deletes"), F.count(F.lit(1)).alias("pages"), F.count_if(~F.col("changed")).alias("pages_skipped"), F.sum("r").alias("records_checked"))


# codecs


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN ((o_custkey % 5) << 32) | o_orderkey ELSE o_orderkey END AS txn FROM orders")
def txn_compose(spark, d):
    flags = F.when(F.col("o_orderkey") % 2 == 0, 1024).otherwise(0)
    return _read(spark, d, "orders").select("o_orderkey", C.txn(F.col("o_orderkey"), F.col("o_custkey") % 5, flags).alias("txn"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 OR (o_orderkey % 256) & (1 << CAST(o_custkey % 8 AS INTEGER)) <> 0 THEN NULL ELSE o_totalprice END AS value FROM orders")
def null_bitmap(spark, d):
    bitmap = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey") % 256)
    return _read(spark, d, "orders").select("o_orderkey", C.unless_null(F.col("o_totalprice"), bitmap, F.expr("shiftleft(1L, CAST(o_custkey % 8 AS INT))")).alias("value"))


@query("SELECT o_orderkey, o_orderkey % 3 <> 0 AS flag FROM orders")
def bool_normalize(spark, d):
    return _read(spark, d, "orders").select("o_orderkey", C.boolean(F.col("o_orderkey") % 3).alias("flag"))


@query(r"SELECT doc_id, md5(regexp_replace(text || chr(9) || '  ', '[\x00-\x20]+$', '')) AS digest FROM documents")
def trim_fixed_text(spark, d):
    return _read(spark, d, "documents").select("doc_id", F.md5(C.trim_fixed(F.concat("text", F.lit("\t  ")))).alias("digest"))


@query(r"SELECT doc_id, md5(CASE WHEN doc_id % 5 = 0 THEN '   ' ELSE regexp_replace(text || '  ', '[\x00-\x20]+$', '') END) AS digest FROM documents")
def trim_var_text(spark, d):
    text = F.when(F.col("doc_id") % 5 == 0, "   ").otherwise(F.concat("text", F.lit("  ")))
    return _read(spark, d, "documents").select("doc_id", F.md5(C.trim_var(text)).alias("digest"))


_HIGH = ", ".join("'" + K.CP1252.get(b, chr(b)) + "'" for b in range(0x80, 0xA0))


@query(f"SELECT doc_id, 'x' || CASE WHEN doc_id % 128 < 32 THEN [{_HIGH}][CAST(doc_id % 128 + 1 AS BIGINT)] ELSE chr(CAST(128 + doc_id % 128 AS INTEGER)) END AS text FROM documents")
def cp1252_text(spark, d):
    raw = F.unhex(F.concat(F.lit("7800"), F.hex(128 + F.col("doc_id") % 128)))
    return _read(spark, d, "documents").select("doc_id", C.cp1252(raw).alias("text"))


@query("SELECT o_orderkey, CAST(o_custkey AS DOUBLE) / 100 AS amount FROM orders")
def scaled_numeric(spark, d):
    return _read(spark, d, "orders").select("o_orderkey", C.scaled(F.col("o_custkey"), -2).alias("amount"))


@query("SELECT o_orderkey, CAST(date_diff('day', DATE '1858-11-17', CAST(o_orderdate AS DATE)) AS INTEGER) AS mjd, CAST(o_orderdate AS DATE) AS day FROM orders")
def date_epoch(spark, d):
    mjd = C.date_mjd(F.col("o_orderdate").cast("date"))
    return _read(spark, d, "orders").select("o_orderkey", mjd.alias("mjd"), C.mjd_date(mjd).alias("day"))


@query("SELECT o_orderkey, ((o_orderkey * 104729) % 864000000) * 100 AS micros FROM orders")
def time_ticks(spark, d):
    return _read(spark, d, "orders").select("o_orderkey", C.ticks_micros(F.col("o_orderkey") * 104729 % 864000000).alias("micros"))


@query("SELECT event_id, epoch_us(ts) - epoch_us(TIMESTAMP '2000-01-01 00:00:00') AS micros, CAST(ts AS TIMESTAMP) AS back FROM events")
def timestamp_epoch(spark, d):
    micros = C.epoch_micros(F.col("ts"))
    days, ticks = F.expr("CAST(floor(micros / 86400000000D) AS INT) + 51544"), F.expr("pmod(micros, 86400000000L)")
    rows = _read(spark, d, "events").select("event_id", "ts", micros.alias("micros"))
    # whole ticks of 100 microseconds; what is below is added again
    return rows.select("event_id", "micros", F.timestamp_add("MICROSECOND", ticks % 100, C.timestamp(days, F.floor(ticks / 100))).alias("back"))


@query(
    "SELECT o_orderkey, CAST(o_orderkey % 30000 AS SMALLINT) AS a_short, CAST(o_custkey AS INTEGER) AS a_long, o_orderkey AS an_int64, CAST(o_totalprice AS REAL) AS a_real, o_totalprice AS a_double, CAST(o_orderdate AS DATE) AS a_date, o_orderkey % 2 = 1 AS a_boolean, CAST(NULL AS VARCHAR) AS a_blob FROM orders"
)
def type_map_values(spark, d):
    kind = lambda code: K.spark_type(K.Field(code))
    return _read(spark, d, "orders").select(
        "o_orderkey",
        (F.col("o_orderkey") % 30000).cast(kind(K.SHORT)).alias("a_short"),
        F.col("o_custkey").cast(kind(K.LONG)).alias("a_long"),
        F.col("o_orderkey").cast(kind(K.INT64)).alias("an_int64"),
        F.col("o_totalprice").cast(kind(K.REAL)).alias("a_real"),
        F.col("o_totalprice").cast(kind(K.DOUBLE)).alias("a_double"),
        F.col("o_orderdate").cast(kind(K.DATE)).alias("a_date"),
        (F.col("o_orderkey") % 2 == 1).cast(kind(K.BOOLEAN)).alias("a_boolean"),
        F.lit(None).cast(kind(K.BLOB)).alias("a_blob"),
    )


@query(
    """SELECT * FROM (VALUES (1, 'VARCHAR(12)'), (2, 'VARCHAR(12)'), (3, 'VARCHAR(10)'), (8, 'SMALLINT'), (9, 'INTEGER'), (10, 'BIGINT'), (11, 'REAL'), (12, 'DOUBLE PRECISION'), (13, 'DOUBLE PRECISION'), (14, 'DATE'), (15, 'TIME'), (16, 'TIMESTAMP'),
    (17, 'TEXT'), (18, 'TEXT'), (19, 'BIGINT'), (20, 'BYTEA'), (21, 'BOOLEAN'), (22, 'TEXT'), (23, 'TEXT'), (24, 'TEXT'), (25, 'TIME'), (26, 'TIMESTAMP')) AS t(dtype, ddl)"""
)
def type_map_ddl(spark, d):
    codes = [1, 2, 3, *range(8, 27)]
    return spark.createDataFrame([(c, K.ddl_type(K.Field(c, 0, 12))) for c in codes], "dtype int, ddl string")


@query(
    """SELECT 'CREATE TABLE "orders" (' || chr(10) || '    "o_orderkey"                               BIGINT,' || chr(10) || '    "o_totalprice"                             DOUBLE PRECISION,' || chr(10) || '    PRIMARY KEY ("o_orderkey")' || chr(10) || ');' AS ddl,
    'CREATE TABLE "orders__new" (' || chr(10) || '    "o_orderkey"                               BIGINT,' || chr(10) || '    "o_totalprice"                             DOUBLE PRECISION,' || chr(10) || '    PRIMARY KEY ("o_orderkey")' || chr(10) || ');' AS staged"""
)
def create_table_ddl(spark, d):
    sql = K.create_table("ORDERS", [("O_ORDERKEY", K.Field(K.INT64)), ("O_TOTALPRICE", K.Field(K.LONG, -2))], ["O_ORDERKEY"])
    return spark.createDataFrame([(sql, K.retarget(sql, "orders", "orders__new"))], "ddl string, staged string")


@query("SELECT o_orderkey, '00000008' || format('{:016X}', o_orderkey) AS wide, '00000004' || format('{:08X}', o_custkey) AS narrow FROM orders")
def pk_encode(spark, d):
    return _read(spark, d, "orders").select("o_orderkey", C.key_hex(F.col("o_orderkey"), 8).alias("wide"), C.key_hex(F.col("o_custkey"), 4).alias("narrow"))


@query("SELECT * FROM (VALUES ('INTEGER', 8), ('INT64', 12), ('DATE', 8), ('INTEGER+INT64', 20), ('VARCHAR', 0), ('missing', 0), ('SCALED SHORT', 12)) AS t(key, stride)")
def pk_stride(spark, d):
    f = K.Field
    keys = {"INTEGER": [f(K.LONG)], "INT64": [f(K.INT64)], "DATE": [f(K.DATE)], "INTEGER+INT64": [f(K.LONG), f(K.INT64)], "VARCHAR": [f(K.VARYING, 0, 9)], "missing": [None], "SCALED SHORT": [f(K.SHORT, -1)]}
    return spark.createDataFrame([(k, K.key_stride(v)) for k, v in keys.items()], "key string, stride int")


@query("SELECT o_orderkey, '0003' || '00000008' || format('{:016X}', o_orderkey) || CASE WHEN o_custkey % 2 = 0 THEN 'FFFFFFFF' ELSE '00000008' || format('{:016X}', o_custkey) END || format('{:08X}', strlen(o_orderstatus)) || hex(o_orderstatus) AS row FROM orders")
def copy_binary_rows(spark, d):
    o = _read(spark, d, "orders").select("o_orderkey", F.when(F.col("o_custkey") % 2 != 0, F.col("o_custkey")).alias("c"), "o_orderstatus")
    return copybinary.rows(o, ["o_orderkey"]).select("o_orderkey", F.hex("copy").alias("row"))


@query("SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 1 THEN o_totalprice END AS o_totalprice FROM orders")
def format_versions(spark, d):
    o = _read(spark, d, "orders")
    return versions.unify({1: o.where("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey"), 2: o.where("o_orderkey % 2 = 1").select("o_custkey", "o_totalprice", "o_orderkey")}, ["o_orderkey", "o_custkey", "o_totalprice"])


@query("SELECT doc_id, md5(text) AS digest FROM documents WHERE length(text) > 0")
def fragment_reassembly(spark, d):
    pieces = _read(spark, d, "documents").select("doc_id", "text", F.explode(F.expr("sequence(0, (length(text) - 1) div 200)")).alias("seq")).where("length(text) > 0")
    pieces = pieces.select("doc_id", "seq", F.expr("substring(text, CAST(seq * 200 + 1 AS INT), 200)").alias("piece"))
    return versions.reassembled(pieces, ["doc_id"], "seq", "piece", "text").select("doc_id", F.md5("text").alias("digest"))


@query("SELECT doc_id, CAST(ceil(strlen(text) / 1000.0) AS BIGINT) + 1 AS n_chunks, md5(text) AS digest FROM documents")
def chunk_roundtrip(spark, d):
    def f(batches):
        import hashlib
        import io

        for batch in batches:
            n, digest = [], []
            for text in batch.column(1).to_pylist():
                parts = frames.chunks((text or "").encode(), 1000)
                n.append(len(parts))
                digest.append(hashlib.md5(b"".join(frames.read_chunks(io.BytesIO(b"".join(parts))))).hexdigest())
            yield pa.record_batch({"doc_id": batch.column(0), "n_chunks": pa.array(n, pa.int64()), "digest": pa.array(digest)})

    return _read(spark, d, "documents").select("doc_id", "text").mapInArrow(f, "doc_id long, n_chunks long, digest string")


# chains, merges, set algebra


@query(
    """WITH RECURSIVE v AS (SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN event_id - 1 END AS back FROM events),
    walk(root, node, depth) AS (SELECT event_id, event_id, 0 FROM v UNION ALL SELECT w.root, v.back, w.depth + 1 FROM walk w JOIN v ON v.event_id = w.node WHERE v.back IS NOT NULL AND w.depth < 8)
    SELECT root, node, depth FROM walk"""
)
def version_chain(spark, d):
    events = _read(spark, d, "events").selectExpr("event_id", "CASE WHEN event_id % 4 <> 0 THEN event_id - 1 END AS back")
    return versions.chain(events, "true", "event_id", "back")


def _base(spark, d) -> DataFrame:
    return _read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


def _ups(base: DataFrame) -> DataFrame:
    changed = base.where("o_orderkey % 5 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return changed.unionByName(base.where("o_orderkey % 50 = 0").withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000))


_UPS = "(SELECT o_orderkey, o_custkey, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderkey % 5 = 0 UNION ALL SELECT o_orderkey + 10000000, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 50 = 0)"


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0")
def delete_using(spark, d):
    base = _base(spark, d)
    return merge.delete_using(base, base.where("o_orderkey % 3 = 0").select("o_orderkey"), ["o_orderkey"])


@query(f"SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 5 <> 0 UNION ALL SELECT * FROM {_UPS}")
def upsert_merge(spark, d):
    base = _base(spark, d)
    return merge.upsert(base, _ups(base), ["o_orderkey"])


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_custkey % 2 = 0 UNION SELECT o_custkey FROM orders WHERE o_custkey % 3 = 0")
def upsert_all_pk(spark, d):
    keys = _base(spark, d).select("o_custkey").distinct()
    return merge.upsert(keys.where("o_custkey % 2 = 0"), keys.where("o_custkey % 3 = 0"), ["o_custkey"])


@query(f"SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 5 <> 0 UNION ALL SELECT * FROM {_UPS}")
def apply_delta(spark, d):
    base = _base(spark, d)
    return merge.apply_delta(base, _ups(base), base.where("o_orderkey % 3 = 0").select("o_orderkey"), ["o_orderkey"])


@query(f"SELECT DISTINCT pk FROM {_V} v WHERE {_CHANGED} AND pk % 11 = 0")
def express_delete(spark, d):
    v = _versions(spark, d)
    changed = _state(v).where("changed")
    return changes.express_deletes(_now(v).join(changed.select("page"), "page", "left_semi"), v.select("page", "pk"), changed, ["pk"])


@query(f"SELECT DISTINCT pk FROM {_V} v WHERE (pk % 11 <> 0 AND {_CHANGED}) OR NOT {_CHANGED}")
def alive_set(spark, d):
    v = _versions(spark, d)
    changed = _state(v).where("changed")
    return changes.alive_keys(_now(v).join(changed.select("page"), "page", "left_semi"), v.select("page", "pk"), changed, ["pk"])


@query("SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def pk_contains(spark, d):
    keys = _read(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return _base(spark, d).select("o_orderkey").join(keys, "o_orderkey", "left_semi")


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem ORDER BY 1, 2")
def pk_sort_dedup(spark, d):
    return _read(spark, d, "lineitem").select("l_orderkey", "l_linenumber").distinct().orderBy("l_orderkey", "l_linenumber")


@query(f"SELECT DISTINCT page, page AS gen FROM {_V} v WHERE page % 5 <> 0 AND page % 2 = 0")
def state_retention(spark, d):
    v = _versions(spark, d)
    return changes.retained(_known(v), v.where("page % 2 = 0"))


def _meta(v: DataFrame) -> DataFrame:
    """Versions with the metadata columns of the paged source."""
    return v.select(F.col("page").alias("_page"), F.col("gen").alias("_gen"), F.col("slot").cast("int").alias("_slot"), F.col("txn").alias("_txn"), F.col("flags").alias("_flags"), F.lit(0).cast("long").alias("_back_page"), F.lit(0).alias("_back_line"), F.lit(True).alias("_whole"), "pk", "o_totalprice")


@query(f"SELECT count(*) FILTER (WHERE flags = 0 AND txn > {MARK}) AS upserts, 0 AS deletes, count(DISTINCT page) AS pages FROM {_V} v")
def cold_start(spark, d):
    """Without state every page counts as changed, and no key as vanished."""
    found = changes.scan(_meta(_versions(spark, d)), ["pk"], MARK)
    counts = found.upserts.agg(F.count(F.lit(1)).alias("upserts")), found.deletes.where("reason = 'vanished'").agg(F.count(F.lit(1)).cast("int").alias("deletes")), found.page_gens.agg(F.count(F.lit(1)).alias("pages"))
    return counts[0].join(counts[1], F.lit(True)).join(counts[2], F.lit(True))


@query(f"SELECT count(*) AS upserts, 0 AS deletes FROM {_V} v WHERE flags = 0 AND txn > {MARK}")
def untracked_pk(spark, d):
    """A key column that the table lacks turns deletes off, not upserts."""
    found = changes.scan(_meta(_versions(spark, d)), ["no_such_column"], MARK)
    return found.upserts.agg(F.count(F.lit(1)).alias("upserts")).join(found.deletes.agg(F.count(F.lit(1)).cast("int").alias("deletes")), F.lit(True))


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1")
def latest_version(spark, d):
    return versions.winners(_read(spark, d, "events").select("user_id", "event_id", "event_type", "value"), ["user_id"], ["event_id"])


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (1, 2, 3, 500, 999999999) ORDER BY o_orderkey")
def point_selects(spark, d):
    return _read(spark, d, "orders").where(F.col("o_orderkey").isin(1, 2, 3, 500, 999999999)).select("o_orderkey", "o_totalprice").orderBy("o_orderkey")


@query("SELECT max(o_orderkey) AS max_key, CAST(count(*) AS INTEGER) AS n_rows, count(*) FILTER (WHERE o_orderkey BETWEEN 100 AND 200) AS n_between FROM orders")
def acceptance_counts(spark, d):
    return _read(spark, d, "orders").agg(F.max("o_orderkey").alias("max_key"), F.count(F.lit(1)).cast("int").alias("n_rows"), F.count_if(F.col("o_orderkey").between(100, 200)).alias("n_between"))


# state, tables, streams, tenants


@query(f"SELECT DISTINCT 'gen' AS what, page, gen AS value FROM {_V} v UNION ALL SELECT 'key', page, pk FROM {_NOW} n UNION ALL SELECT 'mark', 0, {MARK}")
def state_roundtrip(spark, d):
    v, store = _versions(spark, d), StateStore(spark, folder(spark, "state"))
    store.save("orders", MARK, 1, v.select("page", "gen").distinct(), _now(v))
    got = store.load("ORDERS")
    mark = spark.range(1).select(F.lit("mark").alias("what"), F.lit(0).cast("long").alias("page"), F.lit(got.watermark).cast("long").alias("value"))
    gens = got.page_gens.select(F.lit("gen").alias("what"), "page", F.col("gen").alias("value"))
    return gens.unionByName(got.keys.select(F.lit("key").alias("what"), "page", F.col("pk").alias("value"))).unionByName(mark)


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 5 <> 0 UNION ALL SELECT * FROM " + _UPS)
def atomic_swap(spark, d):
    """A whole table swapped in over another, then a change set beside it."""
    base, t = _base(spark, d), VersionedTable(spark, folder(spark, "table"), ["o_orderkey"])
    t.swap(base.where("o_orderkey % 2 = 0"))
    t.swap(base)
    t.apply(_ups(base), base.where("o_orderkey % 3 = 0"))
    return t.read()


@query("SELECT 'customer' AS name, count(*) AS n_rows, 'OK' AS status FROM customer UNION ALL SELECT 'no_such_table', 0, 'FAILED' UNION ALL SELECT 'orders', count(*), 'OK' FROM orders")
def failure_isolation(spark, d):
    counted: dict[str, int] = {}
    failed = load.isolated(["customer", "no_such_table", "orders"], lambda t: counted.update({t: _read(spark, d, t).count()}))
    rows = [(t, n, "OK") for t, n in counted.items()] + [(t, 0, "FAILED") for t in failed]
    return spark.createDataFrame(rows, "name string, n_rows long, status string")


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1")
def stream_replay(spark, d):
    """The events as a stream of four files, merged by user into a versioned table."""
    at = folder(spark, "replay")
    events = _read(spark, d, "events").select("user_id", "event_id", "event_type", "value")
    for k in range(4):
        events.where(F.col("event_id") % 4 == k).coalesce(1).write.mode("append").parquet(f"{at}/in")
    target = VersionedTable(spark, f"{at}/out", ["user_id"])
    feed.replay(spark, f"{at}/in", "user_id long, event_id long, event_type string, value double", ["user_id"], ["event_id"], target, f"{at}/check")
    return target.read()


_ENTRIES = "(VALUES (1, '0', 'europe'), (2, '1', NULL), (3, '0', 'asia'), (4, '2', 'x'), (5, 'a=b', 'bad'), (6, '7', 'seven'), (7, '2', 'y')) AS e(seq, tenant, database)"
_REGISTRY = f"(SELECT tenant, arg_max(coalesce(database, 'replica_' || tenant), seq) AS database FROM {_ENTRIES} WHERE tenant NOT LIKE '%=%' GROUP BY tenant)"


def _customers(spark, d) -> DataFrame:
    return _read(spark, d, "customer").select(F.col("c_nationkey").cast("string").alias("tenant"), "c_custkey")


@query(f"SELECT * FROM {_REGISTRY}")
def tenant_registry(spark, d):
    return tenants.registry(_values(spark, _ENTRIES))


@query(f"SELECT CAST(c_nationkey AS VARCHAR) AS tenant, c_custkey, r.database FROM customer JOIN {_REGISTRY} r ON r.tenant = CAST(c_nationkey AS VARCHAR)")
def tenant_routing(spark, d):
    return tenants.routed(_customers(spark, d), tenants.registry(_values(spark, _ENTRIES)), "tenant")


@query(f"SELECT CAST(c_nationkey AS VARCHAR) AS tenant, c_custkey FROM customer WHERE CAST(c_nationkey AS VARCHAR) NOT IN (SELECT tenant FROM {_REGISTRY})")
def tenant_reject(spark, d):
    return tenants.rejected(_customers(spark, d), tenants.registry(_values(spark, _ENTRIES)), "tenant")


QUERIES |= pagedqueries.QUERIES
SQL |= pagedqueries.SQL
