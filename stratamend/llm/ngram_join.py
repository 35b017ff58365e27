"""N-gram Jaccard join with count vectors.

A document is the set of its distinct word n-grams.  Hashing the n-grams into
groups gives a point of group counts, and the sum over the groups of the lesser
counts bounds the overlap of two sets.  An R-tree over such points finds the
partners that can reach the threshold; those are verified on the sets.

So that linked documents meet without a search of all against all, sets also
leave marks: two sets whose Jaccard similarity reaches the threshold differ in
at most T n-grams, so if n-grams are dealt into T + 1 + e groups, e + 1 groups
are the same in both.  The hash of a group's n-grams is a mark, and linked sets
share one (T follows from the size; a set marks its own size class and the
one below).  A group empty in both says nothing: marks of empty groups are left
only by sets with more than e of them, and e is chosen so that these are rare.
A set that has fewer marks in common with others than e + 1, less its empty
groups, links with none and is out.

Equal sets are one node.  A node joins a block for each node that is the least
of one of its marks, so marks that the same nodes share are one block, and a
node is sent once a block.  A block is searched in tiles of bounded size: each
tile's R-tree finds the pairs that the bound allows, and a finer count vector
(one count for each 32-bit hash, so the bound is the overlap but for clashes)
decides.  A tile yields a spanning forest of those pairs, never the pairs: as
many rows as it has nodes at most.  The forest is verified on the 64-bit sets;
tiles in which a pair fails there, if any, are searched again for every pair
that is still across components.

A block of several tiles has its least node in each, which ties what is alike;
what is then still in other components than the block's largest meets that, and
itself, tile by tile, and yields a forest again.  So every pair that shares a
mark is in one component, or ruled out by the bound or the sets.

Rows: every row is a document of its own, those that repeat an id included.
Null text, and text without words, has an empty set and no links; fewer words
than n are one n-gram.  Rows without id link like others but name no component:
theirs is the least real id, or null.  A very long text is one set, held by one
task.  An empty table gives an empty result.  Extra columns are ignored.  Sets
are compared by 64-bit hashes of their n-grams.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from . import kernels as K
from .components import components

#: Groups of a point of the R-tree: so many that n-grams of one set alone seldom meet those of the other in a group.
GROUPS = 256
#: Points of a leaf of the R-tree, and children of an inner node.
FANOUT = 16
#: Rows of one block that meet in one search, on either side, and the bytes of their finer vectors.
TILE, TILE_BYTES = 512, 4 << 20
#: Bits of the hashes of the finer vectors.
BITS = 32
#: Pairs of sets that travel to Python at once.
WIDE = 256
_CAND = "node long, n int, marks array<long>, vector binary, grams binary"
_CELL = ["head", "a", "b"]


def _sets(t: pa.Table, n: int):
    """(row, sorted distinct n-gram hashes) of each row that has words."""
    buf, offs = K.text_column(t.column("text"))
    for i, j in K.row_slices(offs):
        low = K.lower(buf[offs[i] : offs[j]])
        starts, ends, first = K.word_spans(low, offs[i : j + 1] - offs[i], K.PLAIN_WORD)
        h = K.span_hashes(low, starts, ends)
        grams = K.word_windows(h, n)
        for r in range(j - i):
            x, y = int(first[r]), int(first[r + 1])
            if y - x >= n:
                yield i + r, np.unique(grams[x : y - n + 1])
            elif y > x:
                yield i + r, K.word_windows(h[x:y], y - x) + np.uint64(y - x)


class Levels:
    """Size classes whose neighbours hold all partners of a set, and the groups of each."""

    def __init__(self, percent: int):
        self.percent, self.low, self.groups = percent, [1], []  # class limits; (groups, spare) of each class

    def of(self, n: int) -> int:
        while self.low[-1] <= n:
            self.low.append(self.low[-1] * 100 // self.percent + 1)
        return int(np.searchsorted(self.low, n, "right")) - 1

    def count(self, level: int) -> tuple[int, int]:
        """(groups, spare) for pairs whose smaller set is in this class; no groups where only equal sets link.

        Linked sets differ in at most T n-grams, so T + 1 + spare groups leave
        spare + 1 the same in both.  ``spare`` is more than a set of this size
        has empty groups, but for rare ones.
        """
        while len(self.low) < level + 2:
            self.of(self.low[-1])
        while len(self.groups) <= level:
            least, small = self.low[len(self.groups)], self.low[len(self.groups) + 1] - 1
            most, spare = (small + small * 100 // self.percent) * (100 - self.percent) // (100 + self.percent), 1
            while True:
                empty = (most + 1 + spare) * np.exp(-least / (most + 1 + spare))
                if spare >= empty + 4 * empty**0.5 or spare > most + 8:
                    break
                spare += 1
            self.groups.append((most + 1 + spare if most else 0, spare))
        return self.groups[level]


def marks_by_level(grams: np.ndarray, levels: Levels) -> list[tuple[np.ndarray, int]]:
    """The marks of a set in its own size class and the one below, each with how many of them a linked set has too, at least."""
    own, out = levels.of(len(grams)), []
    for level in (own, own - 1):
        g, spare = levels.count(level) if level >= 0 else (0, 0)
        if not g:
            continue
        h = K.mix(grams + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64)))
        group = (((h >> np.uint64(32)) * np.uint64(g)) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        group, h = group[order], K.mix(h[order])
        at = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        names, held = np.zeros(g, np.uint64), np.zeros(g, bool)
        names[group[at]], held[group[at]] = np.add.reduceat(h, at), True
        names = K.mix(names + K.mix(np.arange(g, dtype=np.uint64) + np.uint64(level << 32)))
        empty = int((~held).sum())
        # a partner may leave no marks of empty groups, so they don't count here
        out.append((names, 1) if empty > spare else (names[held], spare + 1 - empty))
    return out


def marks_of(grams: np.ndarray, levels: Levels) -> np.ndarray:
    found = [names for names, _ in marks_by_level(grams, levels)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def vector_of(grams: np.ndarray, bits: int) -> np.ndarray:
    """The finer count vector: the sorted hashes, one that counts twice twice."""
    return np.sort((K.mix(grams) >> np.uint64(64 - bits)).astype(np.uint32))


def enough(a, b, percent: int):
    """The least overlap with which sets of these sizes link."""
    return -(-(a + b) * percent // (100 + percent))


class RTree:
    """A packed R-tree over count vectors: points are sorted by size and their largest coordinates, and packed in runs."""

    def __init__(self, points: np.ndarray):
        total = points.sum(1)
        order = np.lexsort((points[:, 1 % points.shape[1]], points[:, 0], total))
        self.order, self.points = order, points[order]
        self.levels = []  # of (coordinate maxima, least total), leaves first
        top, least = self.points, total[order]
        while True:
            at = np.arange(0, len(top), FANOUT)
            top, least = np.maximum.reduceat(top, at), np.minimum.reduceat(least, at)
            self.levels.append((top, least))
            if len(top) <= 1:
                break

    def search(self, point: np.ndarray, percent: int) -> np.ndarray:
        """Indexes of all points whose bound on the overlap lets them link."""
        size, nodes = int(point.sum()), np.zeros(1, np.int64)
        for top, least in reversed(self.levels):
            nodes = nodes[nodes < len(top)]
            bound = np.minimum(top[nodes], point).sum(1)
            nodes = nodes[bound >= enough(size, least[nodes], percent)]
            nodes = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
        nodes = nodes[nodes < len(self.points)]
        p = self.points[nodes]
        return self.order[nodes[np.minimum(p, point).sum(1) >= enough(size, p.sum(1), percent)]]


class _Vectors:
    """Finer count vectors of the rows of a table."""

    def __init__(self, column: pa.ChunkedArray):
        buf, offs = K.text_column(column)
        self.values, self.at = np.frombuffer(buf.tobytes(), np.uint32), offs // 4

    def cell(self, rows: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Of some rows: the numbers of their (hash, how often so far), and their points."""
        parts = [self.values[self.at[r] : self.at[r + 1]] for r in rows.tolist()]
        size = np.array([len(x) for x in parts], np.int64)
        v, ends = np.concatenate(parts), np.cumsum(size)
        names = v.astype(np.uint64) << np.uint64(32)
        again = np.zeros(len(v), bool)
        again[1:] = v[1:] == v[:-1]
        again[(ends - size)[size > 0]] = False
        for k in np.flatnonzero(again).tolist():
            names[k] = names[k - 1] + np.uint64(1)
        _, ids = np.unique(names, return_inverse=True)
        owner = np.repeat(np.arange(len(rows)), size)
        points = np.bincount(owner * GROUPS + (v % GROUPS).astype(np.int64), minlength=len(rows) * GROUPS).reshape(-1, GROUPS).astype(np.int32)
        return np.split(ids, ends[:-1]), points


def _search(percent: int, forest: bool):
    """For the cells of a bucket: pairs (u, v) of different components that reach the threshold by the finer vectors.

    All of them, or a spanning forest of them.
    """

    def one(vectors: _Vectors, rows: np.ndarray, nodes: np.ndarray, comps: np.ndarray, main: np.ndarray, first: bool):
        ids, points = vectors.cell(rows)
        rest = np.flatnonzero(~main)
        place = np.arange(len(rows)) if first else np.flatnonzero(main)
        if not len(rest) or not len(place):
            return
        tree, size, mark = RTree(points[place]), np.array([len(x) for x in ids]), np.zeros(max(int(x.max(initial=-1)) for x in ids) + 1, bool)
        for k in rest.tolist():
            hit = place[tree.search(points[k], percent)]
            hit = hit[(comps[hit] != comps[k]) & (main[hit] | (nodes[hit] > nodes[k]))]
            if not len(hit):
                continue
            mark[ids[k]] = True
            at = np.cumsum(size[hit]) - size[hit]
            both = np.add.reduceat(mark[np.concatenate([ids[h] for h in hit.tolist()])].astype(np.int64), at)
            mark[ids[k]] = False
            for h in hit[both >= enough(size[k], size[hit], percent)].tolist():
                if comps[h] != comps[k]:
                    yield int(nodes[k]), int(nodes[h])
                    if forest:
                        comps[comps == comps[h]] = comps[k]

    def f(t: pa.Table) -> pa.Table:
        head, a, b, node, comp = (t.column(c).to_numpy() for c in ("head", "a", "b", "node", "component"))
        main, vectors = np.asarray(t.column("main")).astype(bool), _Vectors(t.column("vector"))
        order = np.lexsort((node, b, a, head))
        new = np.ones(len(order), bool)
        for x in (head, a, b):
            new[1:] &= x[order[1:]] == x[order[:-1]]
        new[1:] = ~new[1:]
        out = {k: [] for k in ("u", "v", "head", "a", "b")}
        for rows in np.split(order, np.flatnonzero(new)[1:]):
            r = int(rows[0])
            for u, v in one(vectors, rows, node[rows], comp[rows].copy(), main[rows], a[r] <= 0):
                for k, x in zip(out, (min(u, v), max(u, v), int(head[r]), int(a[r]), int(b[r]))):
                    out[k].append(x)
        return pa.table({k: pa.array(x, pa.int32() if k in "ab" else pa.int64()) for k, x in out.items()})

    return f


def _verified(percent: int):
    def f(batches):
        for batch in batches:
            u, v, a, b, x, y = batch.columns
            ok = []
            for p, q, s, t in zip(a.to_pylist(), b.to_pylist(), x, y):
                s, t = np.frombuffer(s.as_py(), np.uint64), np.frombuffer(t.as_py(), np.uint64)
                ok.append(int(K.member(s, t).sum()) >= enough(p, q, percent))
            ok = pa.array(ok, pa.bool_())
            yield pa.record_batch({"u": u.filter(ok), "v": v.filter(ok)})

    return f


def _linked(pairs: DataFrame, cand: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that reach the threshold on the sets."""
    one = cand.select(F.col("node").alias("u"), F.col("n").alias("a"), F.col("grams").alias("x"))
    two = cand.select(F.col("node").alias("v"), F.col("n").alias("b"), F.col("grams").alias("y"))
    met = pairs.join(one, "u").join(two, "v").select("u", "v", "a", "b", "x", "y")
    return met.mapInArrow(_verified(percent), "u long, v long")


def _searched(cells: DataFrame, cand: DataFrame, known: DataFrame | None, percent: int, buckets: int) -> DataFrame:
    """The links of a spanning forest of all cells; ``known`` has links found before."""

    def found(cells: DataFrame, forest: bool) -> DataFrame:
        dealt = cells.join(cand.select("node", "vector"), "node").withColumn("bucket", F.pmod(F.xxhash64(*_CELL), F.lit(buckets)).cast("int"))
        return dealt.groupBy("bucket").applyInArrow(_search(percent, forest), "u long, v long, head long, a int, b int")

    edges = X.stored(found(cells, True), "forest", narrow=True)
    pairs = edges.select("u", "v").distinct()
    links = X.stored(_linked(pairs, cand, percent), "links", WIDE, narrow=True)
    if pairs.count() == links.count():
        return links
    # a clash of hashes: the cells where it was are searched for every pair that is still apart
    failed = edges.join(links, ["u", "v"], "left_anti")
    comp = components(links if known is None else links.unionByName(known)).withColumnRenamed("component", "now")
    again = cells.join(failed.select(*_CELL).distinct(), _CELL, "left_semi").join(comp, "node", "left")
    again = again.withColumn("component", F.coalesce("now", "component")).drop("now")
    more = found(again, False).select("u", "v").distinct().join(failed.select("u", "v").distinct(), ["u", "v"], "left_anti")
    return links.unionByName(X.stored(_linked(more, cand, percent), "links", WIDE, narrow=True))


def _tiles(rows, grams):
    return F.greatest(F.lit(1), F.ceil(rows / TILE), F.ceil(grams * 4 / TILE_BYTES)).cast("int")


def _in_order(t: pa.Table) -> pa.Table:
    """A chunk's rows in the one order by which they are numbered."""
    return t.take(pc.sort_indices(t, [("key", "ascending"), ("text", "ascending")])).combine_chunks()


def jaccard_components(docs: DataFrame, percent: int = 90, n: int = 3, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, key, tag, stays): documents linked at a Jaccard similarity of ``percent`` per cent or more.

    A row is its key (the id, or a negative number) and tag (a hash of its
    text); ``stays`` says that it is its component's first.
    """
    spark, total = docs.sparkSession, X.text_bytes(docs, text)
    chunks, buckets, bits = X.chunked(docs, total, id_col, text), X.buckets_for(spark, total / 3), BITS
    levels = Levels(percent)
    # rows without id get a negative key from their text
    chunks = chunks.select("chunk", F.coalesce("id", _text_key(F.col("text"))).alias("key"), F.col("id").isNull().alias("nameless"), "text")

    def prints(t: pa.Table) -> pa.Table:
        t = _in_order(t)
        size, a, b = np.zeros(t.num_rows, np.int64), [None] * t.num_rows, [None] * t.num_rows
        for r, grams in _sets(t, n):
            size[r] = len(grams)
            d = hashlib.blake2b(grams.tobytes(), digest_size=16).digest()
            a[r], b[r] = (int.from_bytes(x, "little", signed=True) for x in (d[:8], d[8:]))
        node = (t.column("chunk").to_numpy().astype(np.int64) << 32) + np.arange(t.num_rows)
        return pa.table({"node": node, "key": t.column("key"), "nameless": t.column("nameless"), "tag": t.column("tag"), "n": pa.array(size, pa.int32()), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    # the tag goes along for one look only: the others read the same exchange
    chunks = chunks.withColumn("tag", F.xxhash64("text"))
    every = X.stored(chunks.groupBy("chunk").applyInArrow(prints, "node long, key long, nameless boolean, tag long, n int, a long, b long"), "sets", narrow=True)
    # equal sets: the least node stands for all
    leads = every.where("n > 0").groupBy("a", "b").agg(F.min("node").alias("node"))
    reps = leads.select(F.shiftright("node", 32).cast("int").alias("chunk"), "node")

    def marked(t: pa.Table, told: pa.Table) -> pa.Table:
        own, got = set((told.column("node").to_numpy() & 0xFFFFFFFF).tolist()), []
        if not own:
            return X.pack(-1, np.zeros(0, np.uint64), buckets)
        for r, grams in _sets(_in_order(t), n):
            if r in own:
                got.append(X.clipped(marks_of(grams, levels)))
        names, many = np.unique(np.concatenate([np.zeros(0, np.uint64), *got]), return_counts=True)
        return X.pack(t.column("chunk")[0].as_py(), X.flagged(names, many > 1), buckets)

    marks = chunks.groupBy("chunk").cogroup(reps.groupBy("chunk")).applyInArrow(marked, X.NAMES)
    shared = marks.groupBy("bucket").applyInArrow(X.shared_names(1), X.REPLY)

    def candidates(t: pa.Table, told: pa.Table) -> pa.Table:
        names, out = X.told_names(told, 1), {k: [] for k in ("node", "n", "marks", "vector", "grams")}
        own = set((X.gathered(told, 0) & np.uint64(0xFFFFFFFF)).tolist())
        chunk = t.column("chunk")[0].as_py() if t.num_rows else -1
        for r, grams in _sets(_in_order(t), n) if len(names) else ():
            if r not in own:
                continue
            found = [(m[X.is_told(m, names)], least) for m, least in marks_by_level(grams, levels)]
            m = [m for m, least in found if len(m) >= least]
            if m:
                for k, v in zip(out, (chunk << 32 | r, len(grams), np.unique(np.concatenate(m)).view(np.int64), vector_of(grams, bits).tobytes(), grams.tobytes())):
                    out[k].append(v)
        kinds = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary())
        return pa.table({k: pa.array(v, kind) for (k, v), kind in zip(out.items(), kinds)})

    def nodes_packed(t: pa.Table) -> pa.Table:
        return X.reply([(t.column("chunk")[0].as_py(), 0, t.column("node").to_numpy().astype(np.int64).tobytes(), None)])

    told = shared.unionByName(reps.groupBy("chunk").applyInArrow(nodes_packed, X.REPLY))
    cand = X.stored(chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(candidates, _CAND), "candidates")

    # a block holds the nodes of all marks that have one least node
    rows = cand.select("node", "n", F.explode("marks").alias("mark"))
    heads = rows.groupBy("mark").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("size")).where("size > 1").select("mark", "head")
    blocks = X.stored(rows.join(heads, "mark").select("head", "node", "n").distinct(), "blocks", narrow=True)
    sizes = blocks.groupBy("head").agg(_tiles(F.count(F.lit(1)), F.sum("n")).alias("x"))
    tile = F.pmod(F.xxhash64("node", "head"), F.col("x")).cast("int")
    cells = blocks.join(sizes, "head").select("head", "node", F.explode(F.when(F.col("node") == F.col("head"), F.sequence(F.lit(0), F.col("x") - 1)).otherwise(F.array(tile))).alias("b"))
    cells = cells.select("head", F.lit(0).alias("a"), "b", "node", F.col("node").alias("component"), F.lit(False).alias("main"))
    wide = X.buckets_for(spark, total)
    links = _searched(cells, cand, None, percent, wide)
    comp = components(links)

    # what is still apart within a block of several tiles
    large = sizes.where("x > 1").select("head")
    if not large.isEmpty():
        label = blocks.join(large, "head").join(comp, "node", "left").select("head", "node", "n", F.coalesce("component", "node").alias("component"))
        within = label.groupBy("head", "component").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("n"))
        mixed = within.groupBy("head").agg(F.max(F.struct("size", "n", "component")).alias("top"), F.sum("size").alias("size"), F.sum("n").alias("n")).where("size > top.size")
        mixed = mixed.select("head", F.col("top.component").alias("most"), _tiles(F.col("top.size"), F.col("top.n")).alias("x"), _tiles(F.col("size") - F.col("top.size"), F.col("n") - F.col("top.n")).alias("y"))
        # A cell (a, b) is tile a of the block's largest component and tile b of the rest.  The rest meets itself in cells (0, b) and, across tiles, (-1 - b, c).
        apart = label.join(mixed, "head").withColumn("main", F.col("component") == F.col("most")).withColumn("tile", F.pmod(F.xxhash64("node", "head"), F.when(F.col("main"), F.col("x")).otherwise(F.col("y"))).cast("int"))
        met = F.when(F.col("main"), F.expr("transform(sequence(0, y - 1), b -> struct(tile AS a, b AS b))")).otherwise(
            F.expr("concat(transform(sequence(0, x - 1), a -> struct(a AS a, tile AS b)), transform(filter(sequence(0, y - 1), c -> c <> tile), c -> struct(-1 - least(c, tile) AS a, greatest(c, tile) AS b)))")
        )
        apart = apart.select("head", "node", "component", "main", F.explode(met).alias("cell")).select("head", "cell.a", "cell.b", "node", "component", "main")
        late = _searched(apart, cand, links, percent, wide)
        if not late.isEmpty():
            comp = components(links.unionByName(late))

    # of the nodes back to the documents: a set's component is the least real id of all its documents
    sets = leads.join(comp, "node", "left").select(F.concat_ws(":", "a", "b").alias("set"), F.coalesce("component", "node").alias("component"))
    tagged = every.join(sets, F.concat_ws(":", every.a, every.b) == F.col("set"), "left")
    tagged = tagged.select("key", "nameless", "tag", "n", F.coalesce("component", "node").alias("component"))
    own = F.struct("nameless", "key", "tag")
    names = tagged.groupBy("component").agg(F.min(F.when(~F.col("nameless"), F.col("key"))).alias("component_id"), F.min(own).alias("first"))
    out = tagged.withColumn("k", F.col("component").cast("string")).join(names.select(F.col("component").cast("string").alias("k"), "component_id", "first"), "k")
    return out.select(F.when(~F.col("nameless"), F.col("key")).alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), "component_id", "key", "tag", (own == F.col("first")).alias("stays"))


def one_of_each(docs: DataFrame, percent: int = 80, n: int = 5, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, as they are, that stand for their component: that of the least real id, or else the least key.

    Rows that share an id and a text are one, and one of them stays; rows that
    share an id but not a text are judged one by one.
    """
    own, tag = ("key_" + "_".join(docs.columns), "tag_" + "_".join(docs.columns))  # names that no column has
    body = F.col(text).cast("string")
    rows = docs.withColumns({own: F.coalesce(F.col(id_col).cast("long"), _text_key(body)), tag: F.xxhash64(body)})
    stay = jaccard_components(docs, percent, n, id_col, text).where("stays").select(F.col("key").alias(own), F.col("tag").alias(tag))
    return rows.join(stay, [own, tag], "left_semi").dropDuplicates([own, tag]).drop(own, tag)


def _text_key(text):
    """The negative key of a row without id."""
    return -1 - F.xxhash64(text).bitwiseAND(F.lit((1 << 62) - 1))
