"""Vocabulary sizes by mergeable sketches (A04, approximate form).

A sketch of a group's words is a few kilobytes whatever the group's size; stored
sketches are united later, by any grouping, without reading the texts again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12                          # 2^12 registers: 1.6 % standard error


def error_bound(lg_k: int = LG_K, deviations: float = 4) -> float:
    """The relative error that an estimate stays within, at so many standard deviations."""
    return deviations * 1.04 / 2 ** (lg_k / 2)


def vocab_sketches(tokens: DataFrame, by: Sequence[str], word: str = "word", lg_k: int = LG_K) -> DataFrame:
    """``by + (sketch binary, n_tokens long)``: one sketch of the distinct words of
    each group, merged from partial ones of every task.  Null words count as no
    word; a null group is a group."""
    rows = tokens.where(F.col(word).isNotNull())
    return rows.groupBy(*by).agg(F.hll_sketch_agg(word, lg_k).alias("sketch"), F.count(F.lit(1)).alias("n_tokens"))


def united(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of coarser groups (of all, by default) from stored ones."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("sketch", True).alias("sketch"), F.sum("n_tokens").alias("n_tokens"))


def estimated(sketches: DataFrame) -> DataFrame:
    """The sketch replaced by ``vocab_size long``, the estimated number of distinct words."""
    return sketches.withColumn("vocab_size", F.hll_sketch_estimate("sketch")).drop("sketch")
