"""Incremental change detection over record versions.

A scan sees versions with their page, page generation, transaction, flags and
back pointer, and compares them with the state of the last scan: the
transaction watermark, the generation of every page, and the keys that each
page held.  Upserts come from current versions newer than the watermark on
pages that changed; deletes come from delete stubs (their key is in a back
version) and from keys that vanished.

Departures from the reference's behaviour, each for a fault that it would
otherwise have: one winner per key; old versions in a chain are never upserts;
fragmented rows count; a key is deleted once, with its reason; pages that left
the table count as changed and empty; keys may have any type.

Pages, keys and versions all grow with the table, so joins of them are merge
joins: the planner would broadcast a side whose compressed bytes look small.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import versions as V


def page_changes(pages: DataFrame, known: DataFrame | None) -> DataFrame:
    """(page, gen, changed) of ``pages`` (page, gen); a page is unchanged if ``known`` has it with this generation."""
    if known is None:
        return pages.select("page", "gen", F.lit(True).alias("changed"))
    was = known.select("page", F.col("gen").alias("was"))
    return pages.join(was.hint("merge"), "page", "left").select("page", "gen", (~F.col("gen").eqNullSafe(F.col("was"))).alias("changed"))


def alive_keys(now: DataFrame, before: DataFrame, changed: DataFrame, key: list[str]) -> DataFrame:
    """Keys that exist: those now on changed pages, and those before on the others."""
    kept = before.join(changed.select("page").hint("merge"), "page", "left_anti")
    return now.select(*key).unionByName(kept.select(*key)).distinct()


def express_deletes(now: DataFrame, before: DataFrame, changed: DataFrame, key: list[str]) -> DataFrame:
    """Keys that changed pages held before and that exist nowhere now."""
    suspects = before.join(changed.select("page").hint("merge"), "page", "left_semi").select(*key).distinct()
    return suspects.join(alive_keys(now, before, changed, key).hint("merge"), key, "left_anti")


def retained(state: DataFrame, live: DataFrame) -> DataFrame:
    """State of the pages that the table still has."""
    return state.join(live.select("page").distinct().hint("merge"), "page", "left_semi")


@dataclass
class Changes:
    """A change set, and the state after it: rows of the pages in ``touched`` take the place of what they had."""

    upserts: DataFrame
    deletes: DataFrame
    unresolved: DataFrame
    touched: DataFrame
    page_gens: DataFrame
    keys: DataFrame | None
    stats: DataFrame


def scan(versions: DataFrame, key: list[str], watermark: int, page_gens: DataFrame | None = None, keys: DataFrame | None = None, committed: DataFrame | None = None, pages: DataFrame | None = None, resolved: bool = False) -> Changes:
    """The changes since a state.

    ``versions`` has the metadata columns of the paged source and the table's
    columns; ``page_gens`` (page, gen) and ``keys`` (page, key columns) are the
    state, None at a cold start, which emits no vanished keys; ``committed``
    (txn) restricts the scan to those transactions.  With ``pages`` (page, gen)
    and a state, ``versions`` need not hold the rows of unchanged pages but for
    their delete stubs; ``resolved`` says that stubs carry their key already.
    """
    columns = [c for c in versions.columns if not c.startswith("_")]
    tracked = bool(key) and all(k in columns for k in key)
    if pages is None:
        pages = versions.select(F.col("_page").alias("page"), F.col("_gen").alias("gen")).distinct()
    seen = versions if committed is None else versions.join(committed.select(F.col("txn").alias("_txn")), "_txn", "left_semi")
    state = page_changes(pages, page_gens)
    touched = state.where("changed").select("page")
    if page_gens is not None:
        # pages that have left the table changed too, and hold nothing now; an outer join, as joins with a union of these two fail in Spark 4.1
        both = pages.select("page", F.col("gen").alias("now"), F.lit(True).alias("here")).join(page_gens.select("page", F.col("gen").alias("was")).hint("merge"), "page", "full")
        touched = both.where(F.col("here").isNull() | ~F.col("now").eqNullSafe(F.col("was"))).select("page")
    if keys is None:
        now_pages = state.select("page")
    else:
        now_pages = touched
    flagged = state.select(F.col("page").alias("_page"), "changed")
    seen = seen.join(flagged.hint("merge"), "_page")
    current = seen.where(~V.has(F.col("_flags"), V.DELETED | V.CHAIN | V.FRAGMENT | V.BLOB) & F.col("_whole"))
    fresh = current.where((F.col("_txn") > watermark) & F.col("changed"))
    upserts = (V.winners(fresh.select("_txn", "_page", "_slot", *columns), key, ["_txn", "_page", "_slot"]) if tracked else fresh).select(*columns)
    stubs = seen.where(V.has(F.col("_flags"), V.DELETED) & (F.col("_txn") > watermark))
    now = None
    if tracked:
        now = current.select(F.col("_page").alias("page"), *key).join(now_pages.hint("merge"), "page", "left_semi").distinct()
        if resolved:
            found, unresolved = stubs.where("_whole").select(*key), stubs.where("NOT _whole").select("_txn")
        else:
            found, unresolved = V.resolve_stubs(stubs, versions, key)
        # a key that was deleted and stored again, or has moved, is no delete
        gone = found.distinct().join(now.select(*key).distinct().hint("merge"), key, "left_anti").select(*key, F.lit("stub").alias("reason"))
        if keys is not None:
            suspects = keys.join(touched.hint("merge"), "page", "left_semi").select(*key).distinct().join(alive_keys(now, keys, touched, key).hint("merge"), key, "left_anti")
            vanished = suspects.select(*key, F.lit("vanished").alias("vanished"))
            gone = gone.join(vanished.hint("merge"), key, "full").select(*key, F.coalesce("reason", "vanished").alias("reason"))
        deletes = gone.groupBy(*key).agg(F.min("reason").alias("reason")).select(*key, "reason")
    else:
        deletes = versions.sparkSession.createDataFrame([], "reason string")
        unresolved = stubs.select("_txn")
    gens = state.where("changed").select("page", "gen")
    return Changes(upserts, deletes, unresolved, touched, gens, now, _stats(seen, state, watermark))


def _stats(seen: DataFrame, state: DataFrame, watermark: int) -> DataFrame:
    """One row of counters: the greatest transaction, pages seen and skipped, records checked."""
    pages = state.agg(F.count(F.lit(1)).alias("pages"), F.count_if(~F.col("changed")).alias("pages_skipped"))
    records = seen.where(F.col("changed") | V.has(F.col("_flags"), V.DELETED))
    records = records.agg(F.greatest(F.coalesce(F.max("_txn"), F.lit(watermark)), F.lit(watermark)).alias("max_txn"), F.count(F.lit(1)).alias("records_checked"))
    return pages.join(records, F.lit(True))
