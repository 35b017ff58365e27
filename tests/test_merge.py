import random
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from stratamend.operators import merge, versions
from stratamend.plans import table, tenants
from stratamend.plans.table import VersionedTable

T = "a int, b int, v string"


def test_order_of_deletes_and_upserts(spark):
    base = spark.createDataFrame([(1, 1, "x"), (2, 1, "y"), (3, None, "z")], T)
    got = merge.apply_delta(base, spark.createDataFrame([(1, 1, "new"), (9, 9, "nine")], T), spark.createDataFrame([(1, 1, ""), (2, 1, ""), (3, None, "")], T), ["a", "b"])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([(1, 1, "new"), (9, 9, "nine"), (3, None, "z")], key=repr)  # a null never matches


def test_all_key_columns(spark):
    base = spark.createDataFrame([(1, 1), (2, 1)], "a int, b int")
    got = merge.upsert(base, spark.createDataFrame([(1, 1), (5, 5), (5, 5)], "a int, b int"), ["a", "b"])
    assert sorted(map(tuple, got.collect())) == [(1, 1), (2, 1), (5, 5)]


def test_winners(spark):
    df = spark.createDataFrame([(1, 5, "old"), (1, 9, "new"), (2, 1, None)], "k int, txn int, v string")
    assert sorted(map(tuple, versions.winners(df, ["k"], ["txn"]).collect()), key=repr) == sorted([(1, 9, "new"), (2, 1, None)], key=repr)


def test_histories(spark, tmp_path):
    """Many change sets, some applied twice, against a dictionary."""
    r, want = random.Random(1), {}
    t = VersionedTable(spark, str(tmp_path / "t"), ["k"], 4)
    t.swap(spark.createDataFrame([], "k int, v int"))
    for _ in range(6):
        ups = {r.randrange(30): r.randrange(100) for _ in range(r.randint(0, 8))}
        gone = {r.randrange(30) for _ in range(r.randint(0, 5))}
        u, d = spark.createDataFrame(list(ups.items()), "k int, v int"), spark.createDataFrame([(k,) for k in gone], "k int")
        for _ in range(r.randint(1, 2)):
            t.apply(u, d)
        for k in gone:
            want.pop(k, None)
        want.update(ups)
        assert dict(map(tuple, t.read().collect())) == want


def test_swap_is_atomic(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), ["k"], 2)
    t.swap(spark.range(10).select(F.col("id").alias("k")))
    before = t.read()
    # a writer that dies before the manifest is replaced leaves nothing visible
    t.staged_swap(spark.range(99).select(F.col("id").alias("k")))
    assert VersionedTable(spark, t.path, ["k"]).read().count() == 10
    t.swap(spark.range(5).select(F.col("id").alias("k")))
    assert before.count() == 10 and t.read().count() == 5 and t.version == 2  # readers of the old version are not disturbed
    t.vacuum()
    assert t.read().count() == 5 and len([n for n in t.files.children(t.path) if n.startswith("v-")]) == 1


def test_changes_cost_what_they_hold(spark, tmp_path):
    """A small set leaves the base where it is; many become one; large ones go into the base, with more buckets."""
    t = VersionedTable(spark, str(tmp_path / "t"), ["k"])
    t.swap(spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("v")))
    none, base = spark.createDataFrame([], "k long"), t.manifest()["paths"]
    for n in range(1, 20):
        t.apply(spark.createDataFrame([(3, n), (1000 + n, n)], "k long, v int"), spark.createDataFrame([(n * 7,)], "k long"))
        m = t.manifest()
        assert m["paths"] == base and 1 <= len(m["sets"]) < table.SETS and m["version"] == t.version == n + 1
    want = {k: 1 for k in range(1000)}
    for n in range(1, 20):
        want.pop(n * 7, None)
        want.update({3: n, 1000 + n: n})
    assert dict(map(tuple, t.read().collect())) == want
    assert t.apply(none.selectExpr("k", "1 AS v"), none) == 20
    assert dict(map(tuple, t.read(keys=spark.createDataFrame([(3,)], "k long")).where("k = 3").collect())) == {3: 19}
    t.vacuum()
    assert dict(map(tuple, t.read().collect())) == want


def test_growing_tables_get_more_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(table, "BUCKET_BYTES", 1000)
    monkeypatch.setattr(table, "LEAST_BYTES", 0)
    t = VersionedTable(spark, str(tmp_path / "t"), ["k"])
    t.swap(spark.createDataFrame([(1, 1)], "k long, v int").coalesce(1))
    before = t.manifest()["bytes"]
    t.apply(spark.range(2000).selectExpr("id AS k", "2 AS v"), spark.createDataFrame([], "k long"))
    m = t.manifest()
    assert m["sets"] == [] and m["buckets"] > 1 + before // 1000 and t.read().agg(F.sum("v")).first()[0] == 4000


def test_two_writers_lose_nothing(spark, tmp_path):
    first = VersionedTable(spark, str(tmp_path / "t"), ["k"])
    first.swap(spark.createDataFrame([], "k long, v int"))
    none = spark.createDataFrame([], "k long")

    def write(w):
        t = VersionedTable(spark, first.path, ["k"])
        for n in range(4):
            t.apply(spark.createDataFrame([(w * 10 + n, w)], "k long, v int"), none)

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(write, range(3)))
    assert {r.k for r in first.read().collect()} == {w * 10 + n for w in range(3) for n in range(4)} and first.version == 13
    assert not first.files.create(f"{first.path}/_versions/{13:020d}", "{}")


def test_tenants(spark):
    reg = tenants.registry(spark.createDataFrame([(1, "a", "one"), (2, "a", "two"), (3, "b", None), (4, "c=d", "x")], "seq int, tenant string, database string"))
    assert sorted(map(tuple, reg.collect())) == [("a", "two"), ("b", "replica_b")]
    rows = spark.createDataFrame([("a", 1), ("z", 2), (None, 3)], "cn string, v int")
    assert [tuple(r) for r in tenants.routed(rows, reg, "cn").collect()] == [("a", 1, "two")]
    assert sorted((r.v for r in tenants.rejected(rows, reg, "cn").collect())) == [2, 3]


def test_chains_of_many_rows(spark):
    """The walk has no bound on its rows; doubled nodes walk each way, a pointer to nothing is the walk's end, and a circle ends at the depth."""
    limit = "spark.sql.cteRecursionRowLimit"
    was, pairs = spark.conf.get(limit), [(k, k - 1 if k % 4 else None) for k in range(1, 400)] + [(6, 2), (1000, 1001), (1001, 1000), (None, 3)]
    spark.conf.set(limit, 100)
    try:
        got = versions.chain(spark.createDataFrame(pairs, "n int, b int"), "n IS NULL OR n % 2 = 0", "n", "b", 5).collect()
    finally:
        spark.conf.set(limit, was)
    want, step = [], [(n, n) for n, _ in pairs if n is None or n % 2 == 0]
    for depth in range(6):
        want += [(*s, depth) for s in step]
        step = [(root, b) for root, at in step for n, b in pairs if at is not None and n == at and b is not None]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_joined_rows_do_not_ask_for_buckets_of_all_pairs(spark, tmp_path):
    """The planner takes a join for the product of its sides; a new table has no more buckets than what is read fills."""
    a, b = (spark.range(100_000).select("id", F.rand(k).alias(f"v{k}")) for k in (1, 2))
    t = VersionedTable(spark, str(tmp_path / "t"), ["id"])
    t.swap(a.join(b, "id").where("id < 50"))
    assert t.manifest()["buckets"] == 1 and t.read().count() == 50
