"""Record versions as DataFrames: visibility, fragments, schema versions, back-version chains."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DELETED, CHAIN, FRAGMENT, INCOMPLETE, BLOB = 1, 2, 4, 8, 16
#: A delete stub's key is looked for in no more back versions than this.
DEPTH = 8


def has(flags: Column, mask: int) -> Column:
    return flags.bitwiseAND(mask) != 0


def is_current(flags: Column) -> Column:
    """Current rows stored whole."""
    return ~has(flags, DELETED | CHAIN | FRAGMENT | INCOMPLETE | BLOB)


def is_metadata(flags: Column) -> Column:
    """What catalog scans read: chain records too, and the heads of fragmented ones."""
    return ~has(flags, DELETED | FRAGMENT | BLOB)


def flag_columns(flags: Column) -> list[Column]:
    names = {"deleted": DELETED, "chain": CHAIN, "fragment": FRAGMENT, "incomplete": INCOMPLETE, "blob": BLOB}
    return [has(flags, mask).alias(name) for name, mask in names.items()]


def slot_valid(offset: Column, length: Column, page_size: int) -> Column:
    return (offset != 0) & (length >= 13) & (offset + length <= page_size)


def winners(versions: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row for each key: that of the greatest ``order``.  A map-side aggregate, so a hot key is no burden."""
    rest = [c for c in versions.columns if c not in key]
    top = F.max(F.struct(*order, *[c for c in rest if c not in order])).alias("top")
    return versions.groupBy(*key).agg(top).select(*[F.col(k) if k in key else F.col(f"top.`{k}`").alias(k) for k in versions.columns])


def reassembled(pieces: DataFrame, key: list[str], seq: str, piece: str, out: str) -> DataFrame:
    """Pieces of a value put together in the order of ``seq``; one value's pieces meet in a task, as its length bounds them."""
    parts = F.array_sort(F.collect_list(F.struct(seq, piece)))
    return pieces.groupBy(*key).agg(F.array_join(F.transform(parts, lambda p: p[piece]), "").alias(out))


def unify(by_format: dict[int, DataFrame], columns: list[str]) -> DataFrame:
    """Rows of several schema versions as one table; a column that a version lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), by_format.values()).select(*columns)


def resolve_stubs(stubs: DataFrame, versions: DataFrame, key: list[str], depth: int = DEPTH) -> tuple[DataFrame, DataFrame]:
    """(deletes with their key, stubs without one).

    ``stubs`` has _back_page, _back_line, _txn; ``versions`` has _page, _slot, _back_page, _back_line, _flags, _whole and the key.  Each step is a join of the
    stubs still open, which are few beside the table; a stub whose back version is neither whole nor part of a chain stays open for good.
    """
    back = versions.select(F.col("_page").alias("p"), F.col("_slot").alias("s"), F.col("_back_page").alias("bp"), F.col("_back_line").alias("bl"), F.col("_flags").alias("f"), F.col("_whole").alias("w"), *[F.col(k).alias(f"b_{k}") for k in key])
    empty = [F.lit(None).cast(versions.schema[k].dataType).alias(f"k_{k}") for k in key]
    at = stubs.select("_txn", F.col("_back_page").alias("page"), F.col("_back_line").alias("line"), F.lit(False).alias("found"), (F.col("_back_page") != 0).alias("walk"), *empty)
    for _ in range(depth):
        # a stub that walks no further has no partner
        step = at.withColumns({"to": F.when(F.col("walk"), F.col("page")), "at": F.when(F.col("walk"), F.col("line"))}).join(back, F.expr("to = p AND at = s"), "left")
        whole = F.coalesce(F.col("w"), F.lit(False))
        more = ~whole & F.coalesce(has(F.col("f"), CHAIN | DELETED), F.lit(False)) & (F.coalesce("bp", F.lit(0)) != 0)
        at = step.select(
            "_txn",
            F.coalesce("bp", "page").alias("page"),
            F.coalesce("bl", "line").alias("line"),
            (F.col("found") | whole).alias("found"),
            (F.col("walk") & more).alias("walk"),
            *[F.when(whole, F.col(f"b_{k}")).otherwise(F.col(f"k_{k}")).alias(f"k_{k}") for k in key],
        )
    found = at.where("found").select("_txn", *[F.col(f"k_{k}").alias(k) for k in key])
    return found, at.where("NOT found").select("_txn")


def chain(versions: DataFrame, start: str, node: str, back: str, depth: int = DEPTH) -> DataFrame:
    """(root, node, depth): each start's walk along back pointers, however many rows that makes.  A step is a join of the last one's rows with the pointers."""
    links = versions.where(F.col(back).isNotNull()).select(F.col(node).alias("at"), F.col(back).alias("to"))
    step = versions.where(start).select(F.col(node).alias("root"), F.col(node).alias("node"))
    steps = [step.withColumn("depth", F.lit(0))]
    for k in range(1, depth + 1):
        step = step.join(links, F.expr("node = at")).select("root", F.col("to").alias("node"))
        steps.append(step.withColumn("depth", F.lit(k)))
    return reduce(DataFrame.unionByName, steps)
