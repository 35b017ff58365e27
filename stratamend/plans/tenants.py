"""Tenants: a registry of names and databases, routing, and rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import Files


def registry(entries: DataFrame) -> DataFrame:
    """(tenant, database) of entries (seq, tenant, database): the last entry of a tenant counts; without a database it gets ``replica_<tenant>``."""
    named = entries.where(~F.col("tenant").contains("=")).withColumn("database", F.coalesce("database", F.concat(F.lit("replica_"), F.col("tenant"))))
    return named.groupBy("tenant").agg(F.max_by("database", "seq").alias("database"))


def routed(rows: DataFrame, reg: DataFrame, tenant: str) -> DataFrame:
    """``rows`` with the database of their tenant."""
    return rows.join(reg.withColumnRenamed("tenant", tenant), tenant)


def rejected(rows: DataFrame, reg: DataFrame, tenant: str) -> DataFrame:
    """Rows of tenants that nobody registered."""
    return rows.join(reg.select(F.col("tenant").alias(tenant)), tenant, "left_anti")


def ensure_database(spark: SparkSession, database: str, target: str) -> bool:
    """Makes a tenant's database under ``target``, in the catalog too, if there is none; says whether it did."""
    files, at = Files(spark), f"{target.rstrip('/')}/{database}"
    there = files.exists(at) and spark.catalog.databaseExists(database)
    if not there:
        files.folder(at)
        name, place = database.replace("`", "``"), at.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{place}'")
    return not there
