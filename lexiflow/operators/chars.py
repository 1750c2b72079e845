"""Character-level preparation.

texts -> chunks and characters; texts -> next-character pairs -> transition counts.  All of it
is per-row array work (no shuffle) until the counts; the only join is with the
77-row character table, which is a fixed-size broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..conf import CHUNK_LEN
from ..functions.charset import char_id, charset_table, chars_of, keep_charset


def filter_charset(df: DataFrame, text: str = "text", out: str = "text") -> DataFrame:
    """Keep only characters of the fixed set."""
    return df.withColumn(out, keep_charset(text))


def chunk_text(df: DataFrame, length: int = CHUNK_LEN, key: str = "doc_id",
               text: str = "text", keep_tail: bool = True) -> DataFrame:
    """Consecutive ``length``-character chunks ``(key, chunk, text)``.

    The last chunk of a text is as long as what is left, so the chunks of a
    text add up to it; empty texts have none.  Without ``keep_tail`` the bounds
    are those of the loop ``start + length < len``, which is meant for one long
    text: ``floor((len-1)/length)`` chunks of full length.  The substrings are
    cut inside the row before exploding.
    """
    n = F.length(text)
    count = (F.ceil(n / length) if keep_tail else F.floor((n - 1) / length)).cast("int")
    idx = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    t = F.col(text)
    pieces = F.transform(idx, lambda c: F.struct(c.alias("chunk"), t.substr(c * length + 1, F.lit(length)).alias("text")))
    return df.select(key, F.inline(pieces))


def explode_chars(chunks: DataFrame, keys: tuple[str, ...] = ("doc_id", "chunk"),
                  text: str = "text") -> DataFrame:
    """Characters with their position: ``keys + (pos, ch)``."""
    return (chunks.select(*keys, F.posexplode(chars_of(text)).alias("pos", "ch"))
                  .withColumn("pos", F.col("pos").cast("int")))


def encode_chars(chars: DataFrame, ch: str = "ch") -> DataFrame:
    """P17 + J04: add ``char_id`` by a broadcast join with the 77-row table."""
    table = charset_table(chars.sparkSession).withColumnRenamed("ch", ch)
    return chars.join(F.broadcast(table), ch)


def char_pairs(texts: DataFrame, keys: tuple[str, ...] = ("doc_id",),
               text: str = "text", keep_tail: bool = True) -> DataFrame:
    """``keys + (pos, ch, next_ch)`` for consecutive characters.

    ``n - 1`` pairs for ``n`` characters; taken over whole texts, so no pair is
    lost at a chunk's edge.  Without ``keep_tail`` pairs stop one short, as the
    loop over chunks does.  Zipped inside the row (no window, no shuffle).
    """
    arr = texts.select(*keys, chars_of(text).alias("_a"))
    a = F.col("_a")
    k = F.greatest(F.lit(0), F.size(a) - (1 if keep_tail else 2))
    zipped = F.arrays_zip(F.slice(a, 1, k).alias("ch"), F.slice(a, 2, k).alias("next_ch"))
    return (arr.select(*keys, F.posexplode(zipped).alias("pos", "_p"))
                  .select(*keys, F.col("pos").cast("int").alias("pos"),
                          F.col("_p.ch").alias("ch"), F.col("_p.next_ch").alias("next_ch")))


def one_hot_chars(pairs: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Sparse one-hot cells ``keys + (tensor, char_id, pos, value)``.

    ``features`` marks the input character at each step, ``labels`` the
    target character; zeros are not stored.  The ids are looked up in the row;
    a pair with a character outside the set has no cells.
    """
    j = pairs.withColumns({"in_id": char_id("ch"), "out_id": char_id("next_ch")}).where("in_id is not null and out_id is not null")
    cells = F.array(
        F.struct(F.lit("features").alias("tensor"), F.col("in_id").alias("char_id")),
        F.struct(F.lit("labels").alias("tensor"), F.col("out_id").alias("char_id")))
    return (j.select(*keys, "pos", F.inline(cells))
             .select(*keys, "tensor", "char_id", "pos", F.lit(1.0).alias("value")))


def transitions(pairs: DataFrame, ch: str = "ch", next_ch: str = "next_ch") -> DataFrame:
    """A10: ``(ch, next_ch, n)`` counts; partial aggregation map-side."""
    return pairs.groupBy(ch, next_ch).agg(F.count(F.lit(1)).alias("n"))


def count_pairs(texts: DataFrame, text: str = "text", keep_tail: bool = True) -> DataFrame:
    """P18 + A10: ``(ch, next_ch, n)`` as ``transitions(char_pairs(...))`` gives them.

    Pairs are counted where the texts are read, so a batch has one row for each
    different pair and no row for a single one."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, counts = [], []
            for t in batch.column(0).to_pylist():
                code = np.frombuffer((t or "").encode("utf-32-le"), np.uint32).astype(np.int64)
                code = code if keep_tail else code[:-1]
                if len(code) < 2:
                    continue
                if code.max() < 128:
                    n = np.bincount((code[:-1] << 7) | code[1:])
                    key = np.flatnonzero(n)
                    keys.append((key >> 7 << 21) | (key & 127))
                    counts.append(n[key])
                else:
                    key, n = np.unique((code[:-1] << 21) | code[1:], return_counts=True)
                    keys.append(key)
                    counts.append(n)
            if keys:
                key, place = np.unique(np.concatenate(keys), return_inverse=True)
                n = np.bincount(place, np.concatenate(counts)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([chr(k >> 21) for k in key.tolist()], pa.string()),
                                                  pa.array([chr(k & 0x1FFFFF) for k in key.tolist()], pa.string()),
                                                  pa.array(n)], names=["ch", "next_ch", "n"])

    found = texts.select(text).mapInArrow(run, "ch string, next_ch string, n bigint")
    return found.groupBy("ch", "next_ch").agg(F.sum("n").alias("n"))
