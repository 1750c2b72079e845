"""Vocabulary: counts, dense frequency-ranked ids and lookups.

A01-A04, W01, W06, J01-J03.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

_ROW_BITS = (1 << 33) - 1   # low bits of monotonically_increasing_id = row in partition


def word_counts(tokens: DataFrame, word: str = "word") -> DataFrame:
    """``(word, freq long)``; partial + final hash aggregation."""
    return tokens.groupBy(word).agg(F.count(F.lit(1)).alias("freq"))


def min_count(counts: DataFrame, n: int = 1, freq: str = "freq") -> DataFrame:
    """Keep words seen at least ``n`` times."""
    return counts if n <= 1 else counts.where(F.col(freq) >= n)


def token_total(tokens: DataFrame) -> DataFrame:
    """Number of token occurrences, one row ``(token_total long)``."""
    return tokens.agg(F.count(F.lit(1)).alias("token_total"))


def vocab_size(tokens: DataFrame, word: str = "word") -> DataFrame:
    """Number of distinct words, one row ``(vocab_size long)``.

    Counted as a grouped aggregate then a global count, so the distinct step
    is a partitioned shuffle, not one task.
    """
    return tokens.select(word).distinct().agg(F.count(F.lit(1)).alias("vocab_size"))


def vocab_index(counts: DataFrame, word: str = "word", freq: str = "freq",
                partitions: int | None = None) -> DataFrame:
    """Dense ids 0..V-1 by descending ``freq``, ties by ``word``.

    No single-partition window: rows are range-partitioned on the sort key,
    sorted inside each partition and stored with their row numbers there (which
    fixes the layout and survives executor loss).  Each row then gets that
    number plus the number of rows in all earlier partitions; that offset
    table has one row per partition, so broadcasting it is bounded by the
    partition count, never by the data.
    """
    spark = counts.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(freq).desc(), F.col(word).asc()]
    ranked = (counts.select(word, freq)
                    .repartitionByRange(n, *order)
                    .sortWithinPartitions(*order))
    local = stored(ranked.select(word, freq,
                                 F.spark_partition_id().alias("_pid"),
                                 F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)).alias("_row")), "ranked")
    sizes = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (local.join(F.broadcast(offsets), "_pid")
                 .select(word, freq, (F.col("_off") + F.col("_row")).cast("long").alias("idx")))


def build_vocab(tokens: DataFrame, min_n: int = 1, word: str = "word") -> DataFrame:
    """A01 -> A02 -> W01: the ``vocab`` table ``(word, freq, idx)``."""
    return vocab_index(min_count(word_counts(tokens, word), min_n), word=word)


def lookup(tokens: DataFrame, vocab: DataFrame, word: str = "word") -> DataFrame:
    """Inner equi join on the word; AQE picks its form by run-time bytes."""
    return tokens.join(vocab.select(F.col("word").alias(word), "idx"), word)


def lookup_or_default(tokens: DataFrame, vocab: DataFrame, unknown_id: int = 0,
                      word: str = "word") -> DataFrame:
    """Left join; unknown words get ``unknown_id`` and ``known`` = 0."""
    v = vocab.select(F.col("word").alias(word), F.col("idx").alias("_idx"))
    return (tokens.join(v, word, "left")
                  .withColumn("known", F.col("_idx").isNotNull().cast("int"))
                  .withColumn("idx", F.coalesce(F.col("_idx"), F.lit(unknown_id).cast("long")))
                  .drop("_idx"))


def unknown_words(tokens: DataFrame, vocab: DataFrame, word: str = "word") -> DataFrame:
    """Words absent from the vocabulary with their counts."""
    v = vocab.select(F.col("word").alias(word))
    return (tokens.join(v, word, "left_anti")
                  .groupBy(word).agg(F.count(F.lit(1)).alias("n")))


def first_match(items: DataFrame, word: str = "word", index: str = "index",
                order: tuple[str, ...] = ("line_no", "item_no")) -> DataFrame:
    """Per word, the index of its first occurrence in ``order``.

    A whole number and an ``int`` are put in order as one number (null first), which
    a hash aggregate can hold; for a struct Spark sorts all items of a task.
    """
    kinds = [items.schema[c].dataType.simpleString() for c in order]
    place = F.struct(*order)
    if len(kinds) == 2 and kinds[0] in ("int", "bigint") and kinds[1] == "int":
        late, early = (F.coalesce(F.col(c).cast("decimal(20,0)"), F.lit(str(-(1 << bits) - 1)).cast("decimal(20,0)"))
                       for c, bits in zip(order, (63, 31), strict=True))
        place = (late * F.lit(1 << 33).cast("decimal(10,0)")).cast("decimal(38,0)") + early
    return items.groupBy(word).agg(F.min_by(F.col(index), place).alias(index))
