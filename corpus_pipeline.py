"""A corpus from raw documents: five stages, each over all that the one before it kept.

Rows: null texts count as empty, and empty texts are judged like others: the
classifier scores them, equal ones are one document, they link with no near
copy and hold no benchmark words.  Rows without id are judged by their text,
and rows that share an id but not a text one by one.  Of ties, the id named by
the stage decides.  A very long text is held whole by one task.  Empty tables
give empty results.  Extra columns go along up to the last stage, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratamend.llm import blocknames, exchange, lattice, mil, ngram_join, winnow
from stratamend.llm.queries import PIECES
from stratamend.ship import ship


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learnt from ``labels``, doesn't reject."""
    ship(spark)
    model = mil.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality")
    return mil.keep(docs, model, threshold=0.3)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal but for the case of A-Z, that with the largest id."""
    ship(spark)
    return blocknames.one_of_each(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8 or more, that with the least id."""
    ship(spark)
    return ngram_join.one_of_each(docs, percent=80, n=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in 13-word windows of the benchmark."""
    ship(spark)
    return winnow.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=13)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of each document."""
    ship(spark)
    return lattice.encode(docs, lattice.Vocabulary.load(PIECES), k=2, seed=1, slice_bytes=1 << 20)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("decontaminate", decontaminate), ("encode", encode)]
#: SQL expresses neither the classifier nor the sampling: tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = exchange.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
