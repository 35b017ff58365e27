"""Every query of the catalogue against its SQL in DuckDB."""

import os

import pytest

from stratamend.plans.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(SF):
        pytest.skip("no driver tables")
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v


def same(spark, duck, f, sql):
    df = f(spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(x) for x in r) for r in df.select(columns).collect()), key=repr)
    r = duck.sql(sql)
    assert sorted(r.columns) == columns
    want = sorted((tuple(plain(x[r.columns.index(c)]) for c in columns) for x in r.fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    same(spark, duck, QUERIES[name], SQL[name])


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(SQL) == set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert not entry.entry(spark).isEmpty()


def test_nothing_outside_llm_imports_it():
    import ast
    import pathlib

    root = pathlib.Path(__file__).resolve().parent.parent
    for p in (root / "stratamend").rglob("*.py"):
        if "llm" in p.relative_to(root).parts:
            continue
        for node in ast.walk(ast.parse(p.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") for n in names), p


def test_plans(spark):
    """Filters and columns reach the scans; a merge shuffles its base once at most; no query is a nested loop over two tables."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in plan(QUERIES["project_columns"](spark, SF))
    assert "PushedFilters: [In(o_orderkey" in plan(QUERIES["point_selects"](spark, SF))
    for name in ("apply_delta", "upsert_merge", "express_delete", "alive_set", "change_deletes", "tenant_routing"):
        text = plan(QUERIES[name](spark, SF))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
    assert plan(QUERIES["apply_delta"](spark, SF)).count("LeftAnti") == 1


def test_chains_beyond_the_row_limit_of_recursive_queries(spark, duck):
    limit = "spark.sql.cteRecursionRowLimit"
    was = spark.conf.get(limit)
    spark.conf.set(limit, 100)
    try:
        same(spark, duck, QUERIES["version_chain"], SQL["version_chain"])
    finally:
        spark.conf.set(limit, was)


@pytest.fixture(scope="module")
def spread(tmp_path_factory):
    """Customers whose keys are far apart, one negative and some without values: a file of a few pages."""
    duckdb = pytest.importorskip("duckdb")
    at = tmp_path_factory.mktemp("spread")
    duckdb.sql(
        f"""COPY (SELECT k + i * 1000003 AS c_custkey, CASE WHEN k % 9 <> 0 THEN 'Customer#' || k END AS c_name, CASE WHEN k % 8 <> 0 THEN CAST(k % 25 AS INTEGER) END AS c_nationkey, CASE WHEN k % 11 <> 0 THEN k / 4 END AS c_acctbal
            FROM range(150) a(k), range(4) b(i) UNION ALL SELECT -50, 'x', 1, 0.5) TO '{at}/customer.parquet'"""
    )
    c = duckdb.connect()
    c.execute(f"CREATE VIEW customer AS SELECT * FROM '{at}/customer.parquet'")
    return str(at), c


@pytest.mark.parametrize("name", ["paged_snapshot", "noop_cycle", "stream_trigger", "paged_feed", "snapshot_advance"])
def test_paged_queries_of_spread_keys(spark, spread, name):
    same(spark, spread[1], lambda s, _: QUERIES[name](s, spread[0]), SQL[name])


@pytest.mark.parametrize("name", ["stream_trigger", "paged_feed", "snapshot_advance"])
def test_a_feed_that_fails_fails_its_query(spark, spread, name, monkeypatch):
    """The second change set isn't applied: the query has no rows, rather than those of the first."""
    from stratamend.streaming.feed import TableSink

    apply, sets = TableSink.apply, []

    def broken(self, *a):
        sets.append(a)
        if len(sets) == 2:
            raise OSError("no room")
        apply(self, *a)

    monkeypatch.setattr(TableSink, "apply", broken)
    with pytest.raises(OSError, match="no room"):
        QUERIES[name](spark, spread[0]).collect()


def test_feeds_do_not_broadcast_their_rows(spark, tmp_path):
    """20,000 customers are 300 kB in their file and over 2 MB in a hash table, which the driver of a small heap has no room for; only a row for each task may go there."""
    duckdb = pytest.importorskip("duckdb")
    duckdb.sql(f"COPY (SELECT k AS c_custkey, 'Customer#' || k AS c_name, CAST(k % 25 AS INTEGER) AS c_nationkey, k / 4 AS c_acctbal FROM range(20000) a(k)) TO '{tmp_path}/customer.parquet'")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet'")
    most = "spark.sql.maxBroadcastTableSize"
    spark.conf.set(most, "1500k")
    try:
        same(spark, c, lambda s, _: QUERIES["snapshot_advance"](s, str(tmp_path)), SQL["snapshot_advance"])
    finally:
        spark.conf.unset(most)


def _scan(spark, read=lambda name, df: df):
    """One row on a page that changed, and a page that is gone."""
    from stratamend.operators import changes

    versions = read("versions", spark.createDataFrame([(1, 2, 0, 1, 0, 1, 0, 0, True, 7)], "_page long, _gen long, _slot int, _txn long, _flags int, _fmt int, _back_page long, _back_line int, _whole boolean, k long"))
    pages = read("pages", spark.createDataFrame([(1, 2), (3, 1)], "page long, gen long"))
    known = read("known", spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "page long, gen long"))
    keys = read("keys", spark.createDataFrame([(1, 7), (2, 8), (3, 9)], "page long, k long"))
    return changes.scan(versions, ["k"], 0, known, keys, pages=pages, resolved=True)


def test_scans_broadcast_nothing(spark, tmp_path):
    """No side of a scan's joins goes to the driver, however small its files look."""

    def read(name, df):
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    found = _scan(spark, read)
    for df in (found.upserts, found.deletes, found.touched, found.page_gens, found.keys):
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_scans_whose_joins_are_merge_joins(spark, adaptive):
    """Joins with the pages that changed or left fit these pages' partitions, adaptive execution or not."""
    name = "spark.sql.adaptive.enabled"
    was = spark.conf.get(name)
    spark.conf.set(name, adaptive)
    try:
        found = _scan(spark)
        got = [sorted(map(tuple, df.collect())) for df in (found.upserts, found.deletes, found.touched, found.page_gens, found.keys)]
    finally:
        spark.conf.set(name, was)
    assert got == [[(7,)], [(8, "vanished")], [(1,), (2,)], [(1, 2)], [(1, 7)]]
