"""Quality classifier: hashed word n-grams and FTRL logistic regression."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, map_texts, numbered

# Slots of the hashed n-grams (a power of two), and labelled rows learned from at most.
SLOTS, ROWS = 1 << 18, 8192
# Length of a feature vector: the shares of a text's n-grams times this.
SCALE = 24.0
# Letters, digits and marks in a row are a word, other visible characters too.
WORD = r"[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\s]+"
MULT = np.uint32(0x9E3779B1)


def _shape(word: str) -> int:
    """1 lower, 2 capitalised, 3 upper, 4 mixed, 5 with digits; others by their characters."""
    if word.isalpha():
        return 1 if word.islower() else 3 if word.isupper() and len(word) > 1 else 2 if word[1:].islower() or len(word) == 1 else 4
    if word[:1].isalnum() or word[:1] == "_":
        return 5
    return 6 + zlib.crc32(word.encode("utf-8")) % 1000


def ngrams(texts: pa.Array, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all n-grams of all texts in a row, and their number in each text.

    Words, pairs of words, and triples of words' shapes, in which a word that
    repeats the one before has a shape of its own.  No word of a text is left out.
    """
    marked = pc.replace_substring_regex(pc.replace_substring(texts, "\x02", " "), WORD, "\\0\x02")
    parts = pc.split_pattern(marked, "\x02")
    coded = parts.flatten().dictionary_encode()
    words = [w.strip() for w in coded.dictionary.to_pylist()]
    word = np.array([zlib.crc32(w.encode("utf-8")) for w in words], np.uint32)
    shape = np.array([_shape(w) if w else 0 for w in words], np.uint32)
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.repeat(np.arange(len(texts), dtype=np.int32), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    there = shape[code] > 0 if len(code) else np.zeros(0, bool)
    code, text = code[there], text[there]
    w, s = word[code], shape[code].copy()
    if not len(code):
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    pair = text[1:] == text[:-1]
    s[1:][pair & (w[1:] == w[:-1])] += np.uint32(5000)
    triple = pair[1:] & pair[:-1]
    with np.errstate(over="ignore"):
        two = (w[:-1] * MULT ^ w[1:] + np.uint32(1))[pair]
        three = ((s[:-2] * MULT + s[1:-1]) * MULT + s[2:] + np.uint32(2))[triple]
        grams = np.concatenate((w * MULT, two * MULT, three * MULT)) >> np.uint32(32 - slots.bit_length() + 1)
    of = np.concatenate((text, text[1:][pair], text[2:][triple]))
    order = np.argsort(of, kind="stable")
    return grams[order].astype(np.int64), np.bincount(of, minlength=len(texts))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def ftrl(rows: list[tuple[int, np.ndarray, np.ndarray]], slots: int = SLOTS, epochs: int = 4, alpha: float = 0.3,
         beta: float = 1.0, l1: float = 0.02, l2: float = 0.1) -> np.ndarray:
    """Weights (the last is the bias) learned from rows of (label, slots, values),
    in their order, with follow-the-regularised-leader updates per coordinate."""
    z, n = np.zeros(slots + 1), np.zeros(slots + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        pull = z[at]
        w = -(pull - np.sign(pull) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(pull) <= l1, 0.0, w)

    for _ in range(epochs):
        for label, at, value in rows:
            at, value = np.append(at, slots), np.append(value, 1.0)
            w = weights(at)
            g = (sigmoid(w @ value) - label) * value
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
    return weights(np.arange(slots + 1))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          rows: int = ROWS, slots: int = SLOTS) -> np.ndarray:
    """Weights from a bounded sample of the labelled rows that are not held out.

    The sample is chosen by the keys' hashes, so it does not depend on how the
    tables are dealt.  Rows with a null key, and labels other
    than 0 and 1, are left out; of labels that contradict each other for a key,
    the smaller counts; of several texts of a key, the one of the smallest hash.  Without labelled rows all weights are zero.
    """
    spark = docs.sparkSession
    some = (labels.select(F.col(f"`{key}`").alias("k"), F.col(f"`{label}`").cast("int").alias("y"))
            .where(F.col("k").isNotNull() & F.col("y").isin(0, 1) & ~held_out("k"))
            .groupBy("k").agg(F.min("y").alias("y")))
    some = bounded_sample(some, rows, "k")
    given = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("string").alias("t"))
    given = given.join(F.broadcast(some), "k")               # at most ``rows`` keys
    given = given.groupBy("k", "y").agg(F.min(F.struct(F.xxhash64("t").alias("h"), "t")).alias("one")).select("k", "y", "one.t")

    def make(texts: pa.Array) -> dict[str, object]:
        grams, counts = ngrams(texts, slots)
        at, values = [], []
        stop = np.cumsum(counts)
        for a, b in zip(stop - counts, stop, strict=True):
            slot, n = np.unique(grams[a:b], return_counts=True)
            at.append(slot.astype("<i4").tobytes())
            values.append((n * (SCALE / max(1, b - a))).astype("<f4").tobytes())
        return {"slots": pa.array(at, pa.binary()), "shares": pa.array(values, pa.binary())}

    features = map_texts(given, ["k", "y"], "t", f"k {docs.schema[key].dataType.simpleString()}, y int, "
                         "slots binary, shares binary", make)

    def learn(batches):
        found = []
        for batch in batches:
            for y, s, v in zip(*(batch.column(c).to_pylist() for c in ("y", "slots", "shares")), strict=True):
                found.append((y, np.frombuffer(s, "<i4"), np.frombuffer(v, "<f4").astype(float)))
        w = ftrl(found, slots) if found else np.zeros(slots + 1)
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], names=["slot", "w"])

    # One task learns, from the bounded sample; its rows are in the order of their hashes.
    one = features.repartition(1).sortWithinPartitions(F.xxhash64("k"), "k", F.xxhash64("slots"))
    weights = np.zeros(slots + 1)
    for r in one.select("y", "slots", "shares").mapInArrow(learn, "slot bigint, w double").collect():
        weights[r.slot] = r.w
    return weights


def held_out(key: str):
    """Rows that no label is learned from: crc32 of the key as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score(docs: DataFrame, weights: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, held_out, score, predicted)`` of each row, from its whole text.

    The score is a sparse dot product: the mean weight of the text's n-grams.
    Null and empty texts score as the bias alone.  Repeated rows and null keys
    stay rows of their own (a null key is not held out); an empty table gives an
    empty result; further columns are not read.
    """
    out = _scored(docs.select(f"`{key}`", f"`{text}`"), weights, [key], text)
    return out.select(f"`{key}`", held_out(key).alias("held_out"), F.col("__score").alias("score"),
                      (F.col("__score") >= 0.5).cast("int").alias("predicted"))


def accept(docs: DataFrame, weights: np.ndarray, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, with all their columns.
    Nulls, empty tables and repeated rows: as in ``score``."""
    given = numbered(docs)
    scored = _scored(given, weights, given.columns, f"c{docs.columns.index(text)}")
    return scored.where(F.col("__score") >= least).drop("__score").toDF(*docs.columns)


def _scored(docs: DataFrame, weights: np.ndarray, keep: list[str], text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(weights)   # of a fixed size
    fields = [f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep]

    def make(texts: pa.Array) -> dict[str, object]:
        w = shared.value
        grams, counts = ngrams(texts, len(w) - 1)
        total = np.concatenate(([0.0], np.cumsum(w[grams])))
        stop = np.cumsum(counts)
        mean = (total[stop] - total[stop - counts]) / np.maximum(counts, 1)
        return {"__score": pa.array(sigmoid(mean * SCALE + w[-1]))}

    return map_texts(docs, keep, text, ", ".join([*fields, "__score double"]), make)
