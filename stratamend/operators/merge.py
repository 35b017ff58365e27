"""Merging a change set: deletes, then upserts, as plans of joins.

Keys compare by =, so a null key never matches a delete; and an upsert whose
key has a null is an insert.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def delete_using(base: DataFrame, deletes: DataFrame, key: list[str]) -> DataFrame:
    """``base`` without the rows whose key is deleted."""
    return base.join(deletes.select(*key), key, "left_anti").select(*base.columns)


def upsert(base: DataFrame, upserts: DataFrame, key: list[str]) -> DataFrame:
    """``base`` with rows replaced or added by key; where all columns are key, rows are only added."""
    if set(base.columns) <= set(key):
        return insert_new(base, upserts, key)
    return delete_using(base, upserts, key).unionByName(upserts.select(*base.columns))


def insert_new(base: DataFrame, upserts: DataFrame, key: list[str]) -> DataFrame:
    return base.unionByName(upserts.select(*base.columns).join(base.select(*key), key, "left_anti").select(*base.columns).distinct())


def apply_delta(base: DataFrame, upserts: DataFrame, deletes: DataFrame, key: list[str]) -> DataFrame:
    """Deletes, then upserts; a key in both ends with the upsert's row.

    As the upserts replace what they touch anyway, both take one anti-join:
    the base is shuffled once, or not at all where the keys are few enough to
    be broadcast.
    """
    if set(base.columns) <= set(key):
        return insert_new(delete_using(base, deletes, key), upserts, key)
    touched = deletes.select(*key).unionByName(upserts.select(*key)).distinct()
    return delete_using(base, touched, key).unionByName(upserts.select(*base.columns))
