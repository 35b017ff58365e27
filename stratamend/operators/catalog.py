"""Catalog look-ups over catalog relations as DataFrames.

``relations`` (id, name, is_view, system), ``fields`` (relation, id, name,
position), ``formats`` (relation, version, descriptor), ``constraints``
(relation, type, index), ``segments`` (index, column, position).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def relation(relations: DataFrame, name: str) -> DataFrame:
    """The relation of a name, whatever its case."""
    return relations.where(F.upper("name") == name.upper())


def tables(relations: DataFrame) -> DataFrame:
    """Names of user tables, sorted."""
    return relations.where("name IS NOT NULL AND NOT is_view AND system = 0").select("name").orderBy("name")


def columns(fields: DataFrame, table: str) -> DataFrame:
    """Columns in the order of their positions; without a position the id counts."""
    place = F.coalesce("position", "id")
    return fields.where(F.upper("relation") == table.upper()).select(place.alias("place"), "id", "name").orderBy("place", "id")


def latest_format(formats: DataFrame) -> DataFrame:
    return formats.groupBy("relation").agg(F.max("version").alias("version"), F.max_by("descriptor", "version").alias("descriptor"))


def constraint_types(constraints: DataFrame, table: str) -> DataFrame:
    return constraints.where(F.upper("relation") == table.upper()).select("type")


def key_columns(constraints: DataFrame, segments: DataFrame) -> DataFrame:
    """(relation, column, position) of all primary keys."""
    keys = constraints.where(F.upper("type") == "PRIMARY KEY").select("relation", "index")
    return keys.join(segments, "index").select("relation", "column", "position")
