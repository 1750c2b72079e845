"""From raw documents to packed sequences: four stages, each one of the operators.

Each stage takes all that its predecessor kept.  ``run`` writes every stage's
rows as Parquet in the shared folder and gives the next stage what it reads
from there, so that a lost executor costs one stage at most; what the stage
before has written goes once its successor is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexiflow.llm import quality, simhash
from lexiflow.llm.common import table
from lexiflow.llm.line_dedup import dedup_lines
from lexiflow.llm.queries import packed
from lexiflow.session import remove, scratch_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn from the labelled documents; those that the classifier rejects go."""
    return quality.accept(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go; the documents stay, with their new lengths."""
    return dedup_lines(docs, removed=None)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.keep_one(docs, shingle=4, tau=4)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, packed into sequences."""
    return packed(docs)


STAGES = [("quality_filter", quality_filter), ("line_dedup", line_dedup), ("simhash_dedup", simhash_dedup),
          ("best_fit_packing", best_fit_packing)]

# Hashes by XXH64, a learned classifier and a tokenizer: not for SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
