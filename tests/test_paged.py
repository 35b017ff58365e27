import random
import struct

import pytest
from paged_fixture import INT_KEY, INT_VALUE, Builder, data_page, integer, live, record, row, simple, varying

from stratamend.functions import types as K
from stratamend.functions.types import Field
from stratamend.operators import changes
from stratamend.plans import load
from stratamend.plans.state import StateStore
from stratamend.plans.table import VersionedTable
from stratamend.sources import pagefile as P
from stratamend.sources.paged import changed_versions
from stratamend.streaming import feed as S


def found(spark, path, watermark=100, gens=None, keys=None):
    v = load.read_table(spark, path, "t", versions=True)
    gens = spark.createDataFrame(gens, "page long, gen long") if gens is not None else None
    keys = spark.createDataFrame(keys, "page long, id int") if keys is not None else None
    c = changes.scan(v, ["id"], watermark, gens, keys)
    return sorted(map(tuple, c.upserts.collect())), sorted(map(tuple, c.deletes.collect())), c.stats.first(), c


@pytest.mark.parametrize("version", [12, 13, 14])
def test_catalog(tmp_path, spark, version):
    b = Builder(tmp_path / "f", version)
    b.table(130, "Vendas", [("NROVENDA", INT_KEY), ("CLIENTE", Field(K.VARYING, 0, 22, offset=8)), ("TOTAL", Field(K.LONG, -2, 4, offset=32))], ["NROVENDA", "CLIENTE"], pages=[(1, [record(5, row([INT_KEY, Field(K.VARYING, 0, 22, offset=8), Field(K.LONG, -2, 4, offset=32)], [integer(3), varying("José €"), integer(1234)]), fmt=1)])], positions=[2, 0, None])
    b.table(131, "A_VIEW", [("X", INT_KEY)], view=True).table(1, "SYS$T", [("X", INT_KEY)], system=1).table(132, "EMPTY", [("X", INT_KEY)])
    path = b.write()
    with P.PageFile(path) as f:
        assert f.tables() == ["EMPTY", "Vendas"] and f.relation_id("vENDAS") == 130
        assert f.columns("vendas") == [(1, "CLIENTE"), (0, "NROVENDA"), (2, "TOTAL")] and f.key("VENDAS") == ["NROVENDA", "CLIENTE"]
        assert sorted(k for k, _ in f.constraints("vendas")) == ["NOT NULL", "PRIMARY KEY"]
        with pytest.raises(LookupError):
            f.relation_id("none")
        with pytest.raises(LookupError):
            f.key("empty")
    assert [tuple(r) for r in load.read_table(spark, path, "vendas").collect()] == [("José €", 3, 12.34)]
    assert str(load.read_table(spark, path, "vendas", decimals="exact").first().total) == "12.34"
    assert load.read_table(spark, path, "empty").collect() == []
    assert 'PRIMARY KEY ("nrovenda", "cliente")' in load.table_ddl(path, "vendas") and '"cliente"                                  VARCHAR(20)' in load.table_ddl(path, "vendas")
    tables = spark.read.format("paged_file").options(path=path, relation="tables").load()
    assert {r.name for r in tables.where("NOT is_view AND system = 0").collect()} == {"Vendas", "EMPTY"}


def test_bad_files(tmp_path):
    short = tmp_path / "short"
    short.write_bytes(b"x" * 100)
    with pytest.raises(P.FormatError):
        P.PageFile(str(short))
    for size, version in ((512, 13), (4096, 11), (4096, 200)):
        path = tmp_path / f"{size}-{version}"
        head = bytearray(4096)
        struct.pack_into("<HH", head, 16, size, version)
        path.write_bytes(head)
        with pytest.raises(P.FormatError):
            P.PageFile(str(path))


def test_fragments_and_formats(tmp_path, spark):
    wide = Field(K.TEXT, 0, 10, offset=8)
    text = row([INT_KEY, wide], [integer(1), b"HELLOWORLD"])
    b = Builder(tmp_path / "f", size=1024)
    # head on the first data page (3), the rest on the second (4)
    pages = [(1, [record(7, text[:13], fmt=2, link=(4, 0)), record(8, row([INT_KEY], [integer(2)]), fmt=1)]), (1, [record(7, text[13:], P.FRAGMENT, fmt=2), record(9, row([INT_KEY, wide], [integer(3), None]), fmt=2)])]
    path = b.table(130, "T", [("ID", INT_KEY), ("NAME", wide)], ["ID"], {1: [INT_KEY], 2: [INT_KEY, wide]}, pages).write()
    assert sorted(map(tuple, load.read_table(spark, path, "t").collect())) == [(1, "HELLOWORLD"), (2, None), (3, None)]
    assert sorted(r._slot for r in load.read_table(spark, path, "t", versions=True).collect()) == [0, 1, 1]
    pages_df = spark.read.format("paged_file").options(path=path, relation="pages", table="T").load()
    assert [tuple(r) for r in pages_df.orderBy("page").collect()] == [(3, 1, 2), (4, 1, 2)]


def test_wide_transactions_and_plain_records(tmp_path, spark):
    path = simple(tmp_path / "f", [(1, [live((5 << 32) + 9, 1, 10), live(3, 2, 20, packed=False)])])
    rows = load.read_table(spark, path, "t", versions=True).orderBy("id").collect()
    assert [(r._txn, r.id, r.valor) for r in rows] == [((5 << 32) + 9, 1, 10), (3, 2, 20)]


STUB = P.DELETED


def stub(txn, back):
    return record(txn, b"", STUB, 1, back)


class TestScan:
    """The page fixtures of the survey: pages 3 and on hold the table."""

    def test_delete_on_unchanged_page(self, tmp_path, spark):
        path = simple(tmp_path / "f", [(7, [stub(101, (3, 1)), live(50, 42, 1, P.CHAIN)])])
        assert found(spark, path, gens=[(3, 7)])[:2] == ([], [(42, "stub")])

    def test_upserts_need_a_changed_page(self, tmp_path, spark):
        path = simple(tmp_path / "f", [(5, [live(101, 42, 1)])])
        assert found(spark, path, gens=[(3, 5)])[:2] == ([], []) and found(spark, path, gens=[(3, 4)])[:2] == ([(42, 1)], [])

    def test_old_transactions(self, tmp_path, spark):
        path = simple(tmp_path / "f", [(5, [stub(50, (3, 1)), live(40, 1, 1, P.CHAIN)])])
        assert found(spark, path)[:2] == ([], [])

    def test_watermark(self, tmp_path, spark):
        path = simple(tmp_path / "f", [(5, [live(200, 1), live(150, 2)])])
        up, _, stats, _ = found(spark, path)
        assert len(up) == 2 and stats.max_txn == 200 and stats.pages == 1 and stats.pages_skipped == 0
        assert found(spark, path, watermark=500)[2].max_txn == 500

    def test_vanished_and_moved_keys(self, tmp_path, spark):
        path = simple(tmp_path / "f", [(8, [live(50, 10)]), (8, [])])
        assert found(spark, path, gens=[(3, 7), (4, 7)], keys=[(3, 10), (3, 20)])[1] == [(20, "vanished")]
        moved = simple(tmp_path / "g", [(8, [live(50, 10)]), (8, [live(50, 20)])])
        assert found(spark, moved, gens=[(3, 7), (4, 7)], keys=[(3, 10), (3, 20)])[1] == []

    def test_cold_start_has_no_vanished_keys(self, tmp_path, spark):
        assert found(spark, simple(tmp_path / "f", [(8, [live(50, 10)])]))[1] == []

    def test_page_that_left_the_table(self, tmp_path, spark):
        path = simple(tmp_path / "f", [(8, [live(50, 10)])])
        assert found(spark, path, gens=[(3, 8), (9, 1)], keys=[(3, 10), (9, 77)])[1] == [(77, "vanished")]

    def test_chains(self, tmp_path, spark):
        path = simple(tmp_path / "f", [(8, [stub(101, (3, 1)), record(90, b"", P.CHAIN | P.DELETED, 1, (3, 2)), live(80, 77, 1, P.CHAIN)])])
        assert found(spark, path)[1] == [(77, "stub")]
        blob = simple(tmp_path / "g", [(8, [stub(101, (3, 1)), record(90, b"x" * 30, P.BLOB)])])
        up, gone, _, c = found(spark, blob)
        assert gone == [] and c.unresolved.count() == 1
        none = simple(tmp_path / "h", [(8, [stub(101, (0, 0))])])
        assert found(spark, none)[1] == []

    def test_one_winner_and_no_old_versions(self, tmp_path, spark):
        path = simple(tmp_path / "f", [(8, [live(200, 1, 20, back=(3, 1)), live(150, 1, 10, P.CHAIN)])])
        assert found(spark, path)[0] == [(1, 20)]

    def test_delete_and_insert_of_a_key(self, tmp_path, spark):
        path = simple(tmp_path / "f", [(8, [stub(101, (3, 1)), live(50, 5, 1, P.CHAIN), live(102, 5, 2)])])
        assert found(spark, path)[:2] == ([(5, 2)], [])

    def test_one_delete_of_a_key(self, tmp_path, spark):
        path = simple(tmp_path / "f", [(8, [stub(101, (3, 1)), live(50, 5, 1, P.CHAIN)])])
        assert found(spark, path, gens=[(3, 7)], keys=[(3, 5)])[1] == [(5, "stub")]

    def test_committed_transactions_only(self, tmp_path, spark):
        path = simple(tmp_path / "f", [(8, [live(101, 1, 1), live(102, 2, 2)])])
        v = load.read_table(spark, path, "t", versions=True)
        got = changes.scan(v, ["id"], 100, committed=spark.createDataFrame([(102,)], "txn long"))
        assert [r.id for r in got.upserts.collect()] == [2]

    def test_missing_key_column(self, tmp_path, spark):
        path = simple(tmp_path / "f", [(8, [stub(101, (3, 1)), live(102, 1, 1)])])
        got = changes.scan(load.read_table(spark, path, "t", versions=True), ["nope"], 100)
        assert got.deletes.count() == 0 and got.upserts.count() == 1


def test_unchanged_pages_are_not_decoded(tmp_path, spark):
    """With what is known, a scan reads stubs of unchanged pages, filled from their back version, and all of the others."""
    path = simple(tmp_path / "f", [(7, [stub(101, (3, 1)), live(50, 42, 1, P.CHAIN), live(60, 1, 1)]), (9, [live(102, 2, 2), stub(103, (0, 0))])])
    v = changed_versions(spark, path, "t", spark.createDataFrame([(3, 7), (4, 8), (9000, 1)], "page long, gen long"))
    assert sorted((r._page, r._slot, r._whole, r.id) for r in v.collect()) == [(3, 0, True, 42), (4, 0, True, 2), (4, 1, False, None)]
    gens, keys = spark.createDataFrame([(3, 7), (4, 8), (5, 1)], "page long, gen long"), spark.createDataFrame([(3, 1), (3, 42), (4, 9), (5, 77)], "page long, id int")
    c = changes.scan(v, ["id"], 100, gens, keys, pages=load.read_pages(spark, path, "t"), resolved=True)
    assert [tuple(r) for r in c.upserts.collect()] == [(2, 2)]
    assert sorted(map(tuple, c.deletes.collect())) == [(9, "vanished"), (42, "stub"), (77, "vanished")]
    assert sorted(r.page for r in c.touched.collect()) == [4, 5] and [tuple(r) for r in c.keys.collect()] == [(4, 2)]
    assert c.stats.first().pages_skipped == 1 and c.unresolved.count() == 1


class World:
    """A table that changes by transactions, and its file."""

    def __init__(self, path, pages=4):
        self.path, self.pages, self.rows, self.txn, self.generation = path, pages, {}, 0, 0
        self.gens, self.stubs = {}, {}

    def commit(self, writes):
        self.txn += 1
        touched = set()
        for key, value in writes.items():
            page = key % self.pages
            touched.add(page)
            self.stubs.pop(key, None)
            if value is None:
                old = self.rows.pop(key, None)
                if old and key % 3:  # others are collected at once, and leave nothing behind
                    self.stubs[key] = (self.txn, old)
            else:
                self.rows[key] = (self.txn, value)
        for p in touched:
            self.gens[p] = self.gens.get(p, 0) + 1

    def write(self):
        self.generation += 1
        pages = []
        for p in range(self.pages):
            slots = [live(t, k, v) for k, (t, v) in sorted(self.rows.items()) if k % self.pages == p]
            for k, (t, (ot, ov)) in sorted(self.stubs.items()):
                if k % self.pages == p:
                    slots += [stub(t, (3 + p, len(slots) + 1)), live(ot, k, ov, P.CHAIN)]
            pages.append((self.gens.get(p, 0), slots))
        return simple(self.path, pages, self.generation)


def test_random_histories(tmp_path, spark):
    r = random.Random(3)
    w = World(tmp_path / "f")
    w.commit({k: k for k in range(20)})
    path = w.write()
    f = S.ChangeFeed(spark, path, S.TableSink(spark, str(tmp_path / "to")), StateStore(spark, str(tmp_path / "state")))
    target = VersionedTable(spark, str(tmp_path / "to/t"), ["id"])
    for cycle in range(7):
        f.poll()
        assert {x.id: x.valor for x in target.read().collect()} == {k: v for k, (_, v) in w.rows.items()}, cycle
        if cycle == 3:  # a restart
            f = S.ChangeFeed(spark, path, f.sink, f.state)
        for _ in range(r.randint(0, 3)):
            w.commit({r.randrange(40): r.choice([None, r.randrange(1000)]) for _ in range(r.randint(1, 6))})
        w.write()
    assert f.poll().keys() == {"T"} and f.poll() == {}


def test_load_then_feed(tmp_path, spark):
    w = World(tmp_path / "f")
    w.commit({k: k for k in range(12)})
    path, state = w.write(), StateStore(spark, str(tmp_path / "state"))
    got = load.load_tables(spark, path, ["T", "MISSING"], str(tmp_path / "to"), state).collect()
    assert {(x.table, x.status, x.rows) for x in got} == {("T", "OK", 12), ("MISSING", "FAILED", 0)}
    target = VersionedTable(spark, str(tmp_path / "to/t"), ["id"])
    before = target.version
    f = S.ChangeFeed(spark, path, S.TableSink(spark, str(tmp_path / "to")), state)
    assert f.poll() == {"T": {"upserts": 0, "deletes": 0}} and target.version == before  # nothing is sent again
    w.commit({3: None, 50: 5})
    w.write()
    S.stream(f, str(tmp_path / "check")).awaitTermination()
    assert {x.id for x in target.read().collect()} == set(w.rows)


def test_failures_stay_with_their_table(tmp_path, spark, caplog):
    b = Builder(tmp_path / "f")
    b.table(130, "T", [("ID", INT_KEY), ("VALOR", INT_VALUE)], ["ID"], pages=[(1, [live(5, 1, 1)])])
    b.table(131, "U", [("ID", INT_KEY), ("VALOR", INT_VALUE)], ["ID"], pages=[(1, [live(5, 2, 2)])])
    b.table(132, "NO_KEY", [("ID", INT_KEY)])
    path = b.write()

    class Broken(S.TableSink):
        broken, again = True, 0

        def apply(self, table, *rest):
            if table == "T" and self.broken:
                raise OSError("down")
            super().apply(table, *rest)

        def reconnect(self):
            self.again += 1

    sink = Broken(spark, str(tmp_path / "to"))
    f = S.ChangeFeed(spark, path, sink, StateStore(spark, str(tmp_path / "state")))
    assert set(f.poll()) == {"U"} and set(f.failed) == {"T"} and sink.again == 1
    sink.broken = False
    assert f.poll()["T"] == {"upserts": 1, "deletes": 0} and not f.failed
    assert [r.getMessage() for r in caplog.records if r.levelname == "WARNING" and r.name == "stratamend"] == ["table NO_KEY is not followed: no primary key of NO_KEY"]
    assert all(x["decode_s"] > 0 and x["sink_s"] > 0 for x in f.timings.values()) and set(f.timings) == {"T", "U"}


def test_pages_of_many_stretches(tmp_path, spark):
    """Partitions are stretches of pointer pages, however small."""
    path = simple(tmp_path / "f", [(1, [live(5, k, k)]) for k in range(30)])
    for each in (1, 3, 4096):
        rows = load.read_table(spark, path, "t", pages_per_task=each)
        assert sorted(r.id for r in rows.collect()) == list(range(30))


@pytest.mark.parametrize("version", [13, 14])
def test_blobs_of_many_pages(tmp_path, version):
    """Blobs inline, over pages and over pages of pages, whole or an error."""
    data = bytes(range(256)) * 40

    def blob_page(body, pointers=False):
        page = bytearray(1024)
        page[0], page[1] = P.BLOB_PAGE, int(pointers)
        struct.pack_into("<H", page, 24, len(body))
        page[28 : 28 + len(body)] = body
        return bytes(page)

    def head(size, numbers, level, segments=1, flags=P.STREAM_BLOB):
        h = bytearray(28)
        struct.pack_into("<I", h, 4, len(numbers))
        struct.pack_into("<H", h, 10, P.BLOB | flags)
        struct.pack_into("<IQ" if version >= 14 else "<II", h, 12 if version >= 14 else 16, segments, size)
        h[27 if version >= 14 else 12] = level
        return bytes(h) + struct.pack(f"<{len(numbers)}I", *numbers)

    b = Builder(tmp_path / "f", version, size=1024)
    leaves = [b.place(blob_page(data[k : k + 996])) for k in range(0, len(data), 996)]
    half = len(leaves) // 2
    nodes = [b.place(blob_page(struct.pack(f"<{len(x)}I", *x), True)) for x in (leaves[:half], leaves[half:])]
    parts = [data[k : k + 700] for k in range(0, len(data), 700)]
    cut = b"".join(struct.pack("<H", len(x)) + x for x in parts)
    pieces = [b.place(blob_page(cut[k : k + 996])) for k in range(0, len(cut), 996)]
    slots = [head(len(data), leaves, 1), head(len(data), nodes, 2), head(len(data), pieces, 1, len(parts), 0), head(len(data), leaves[:-1], 1)]
    path = b.table(130, "T", [("ID", INT_KEY)], pages=[(1, slots)]).write()
    with P.PageFile(path) as f:
        bid = lambda slot: struct.pack("<HBBI", 130, 0, 0, slot)
        assert [f.blob(bid(k)) for k in range(3)] == [data] * 3
        with pytest.raises(P.FormatError):
            f.blob(bid(3))
        with pytest.raises(LookupError):
            f.blob(bid(9))
    with P.PageFile(f"file://{path}") as f:
        assert f.blob(bid(0)) == data


def test_state_that_cannot_be_read(tmp_path, spark):
    s = StateStore(spark, str(tmp_path / "s"))
    assert s.load("t").watermark == 0 and s.load("t").page_gens is None
    s.save("T", 7, 3, spark.createDataFrame([(1, 2)], "page long, gen long"), None)
    got = s.load("t")
    assert (got.watermark, got.generation, got.keys) == (7, 3, None) and [tuple(r) for r in got.page_gens.collect()] == [(1, 2)]
    s.files.replace(f"{tmp_path}/s/t/_STATE", "{not json")
    assert s.load("t").watermark == 0


def test_landing_and_gateway(tmp_path, spark):
    path = simple(tmp_path / "f", [(1, [live(5, 1, 1), live(5, 2, 2)])])
    sink = S.LandingSink(spark, str(tmp_path / "land"), "acme")
    sink.full("T", ["id"], spark.createDataFrame([(2, 0), (9, 9)], "id int, valor int"))
    S.ChangeFeed(spark, path, sink, StateStore(spark, str(tmp_path / "state"))).poll()
    sink.apply("T", ["id"], spark.createDataFrame([], "id int, valor int"), spark.createDataFrame([(1,)], "id int"))
    S.LandingSink(spark, str(tmp_path / "land"), "stranger").full("T", ["id"], spark.createDataFrame([(1, 1)], "id int, valor int"))
    (tmp_path / "land/tenant=acme/t/99999999999999999999/upserts").mkdir(parents=True)  # a set that isn't complete
    g = S.Gateway(spark, str(tmp_path / "land"), {"acme": "replica_acme"}, str(tmp_path / "db"))
    assert not spark.catalog.databaseExists("replica_acme")
    assert g.poll() == (3, ["stranger"]) and g.poll() == (0, ["stranger"])
    got = VersionedTable(spark, str(tmp_path / "db/replica_acme/t"), ["id"]).read()
    assert sorted(map(tuple, got.collect())) == [(2, 2), (9, 9)]
    assert spark.catalog.databaseExists("replica_acme")
    spark.sql("DROP DATABASE replica_acme")


def test_command_line(tmp_path, spark, capsys):
    from stratamend.__main__ import main

    path = simple(tmp_path / "f", [(1, [live(5, 1, 1), live(6, 2, None)])])
    assert main(["list", path]) == 0 and capsys.readouterr().out == "T\n"
    assert main(["ddl", path]) == 0 and "CREATE TABLE" in capsys.readouterr().out
    assert main(["load", path, "--to", str(tmp_path / "to")]) == 0
    assert main(["export", path, "--table", "t", "--to", str(tmp_path / "x")]) == 0
    assert main(["watch", path, "--to", str(tmp_path / "w"), "--cycles", "1", "--interval", "1"]) == 0
    assert sorted(map(tuple, VersionedTable(spark, str(tmp_path / "w/t"), ["id"]).read().collect())) == [(1, 1), (2, None)]


def test_inspect_and_export_are_whole(tmp_path, spark, capsys):
    """Every slot of every table: more than a hundred, fragments, blobs and slots without a record too."""
    from stratamend.__main__ import main

    odd = [record(7, b"x", P.FRAGMENT), record(7, b"x", P.BLOB), b"", b"short"]
    page = [live(5, k, k) for k in range(70)]
    path = simple(tmp_path / "f", [(1, page), (2, [*page, *odd])])
    assert main(["inspect", path]) == 0
    lines = [x.split("\t") for x in capsys.readouterr().out.splitlines()]
    head, rows = lines[0], [dict(zip(lines[0], x)) for x in lines[1:]]
    assert head[0] == "table T" and len(rows) == 144
    assert [r["state"] for r in rows[-4:]] == ["record", "record", "empty", "short"]
    assert [(r["fragment"], r["blob"]) for r in rows[-4:-2]] == [("True", "False"), ("False", "True")]
    assert main(["export", path, "--to", str(tmp_path / "x")]) == 0
    assert (tmp_path / "x" / "t").exists()


def test_pointer_pages_of_many_pages(tmp_path):
    """A chain of pointer pages as long as it takes, for pages that are given and for room that is filled later."""
    from stratamend.sources import pagewriter as W

    page = lambda k: data_page(1024, [live(1, k, k)])
    path = simple(tmp_path / "f", [(1, [live(1, k, k)]) for k in range(800)], size=1024)
    with P.PageFile(path) as f:
        assert len(f.data_pages(f.first_pointer(f.relation_id("T")))) == 800 and sum(1 for _ in f.rows(f.relation_id("T"))) == 800
    for n in (0, 1, 2, 247, 248, 495, 496, 1500):
        path = Builder(tmp_path / f"r{n}", size=1024).table(130, "T", [("ID", INT_KEY), ("VALOR", INT_VALUE)], ["ID"], room=n).write()
        assert W.put_pages(path, ((3 + k, page(k)) for k in range(n))) == n
        W.put_generation(path, 7)
        with P.PageFile(path) as f:
            assert f.generation() == 7 and len(list(f.rows(f.relation_id("T")))) == n
            assert f.data_pages(f.first_pointer(f.relation_id("T"))) == list(range(3, 3 + n))
