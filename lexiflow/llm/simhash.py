"""SimHash near-duplicate documents, linked by pigeonring filtering.

The 64 bits are a ring of m = tau + 1 segments.  If two fingerprints differ in
at most tau bits, some segment starts a chain in which the first l segments
together differ in at most l * tau / m bits, for every l.  The first two
segments of the chain give equality keys; in a bucket the chains of three and
more are checked one after another, and the whole distance only of what is left.
"""

from __future__ import annotations

import functools
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .buckets import Links, compare_buckets
from .common import cut_lineage, map_texts, numbered
from .components import components

# Rows of a bucket that one task compares with each other at most, twice.
BLOCK = 2048
_hash = functools.partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(text: str, shingle: int = 4) -> int:
    """Lower-cased A-Z, words between ASCII white space, shingles joined by a
    blank and hashed by XXH64; a bit is 1 if it is in over half the hashes."""
    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    stop = np.cumsum(size + 1) - 1
    if len(words) <= shingle:
        hashes = [_hash(joined)]
    else:
        begin = (stop - size)[: len(words) - shingle + 1].tolist()
        hashes = [_hash(joined[a:b]) for a, b in zip(begin, stop[shingle - 1:].tolist(), strict=True)]
    h, ones = np.array(hashes, np.uint64), np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 14):
        ones += np.unpackbits(h[i:i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = 4, text: str = "text") -> DataFrame:
    """``(*keep, fp)``: fingerprints as signed longs; null texts have no words."""
    fields = [f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep]

    def make(texts: pa.Array) -> dict[str, object]:
        fp = np.array([fingerprint(t, shingle) for t in texts.to_pylist()], np.uint64)
        return {"fp": pa.array(fp.view(np.int64))}

    return map_texts(docs, keep, text, ", ".join([*fields, "fp bigint"]), make)


def ring(tau: int) -> list[tuple[int, int]]:
    """First bit and width of each of tau + 1 segments."""
    m = tau + 1
    edges = [round(64 * i / m) for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]  # noqa: B905


def _mask(segment: tuple[int, int]) -> int:
    return ((1 << segment[1]) - 1) << segment[0]


def chain_keys(tau: int) -> list[tuple[int, int]]:
    """``(start, mask)``: where a chain may begin, and the bits that then agree.

    The first segment is within 0 bits, and the second within 1.  In quarters of
    the three segments' rest (two halves of the second, two of the third, which
    together differ in at most 2 bits, the second in at most 1) at least two
    quarters agree, one of them of the second segment.
    """
    segments, m, keys = ring(tau), tau + 1, []
    if m < 3:                                        # too short a ring for chains of three
        return [(i, _mask(s)) for i, s in enumerate(segments)]
    for i, first in enumerate(segments):
        quarters = []
        for k in (1, 2):
            a, w = segments[(i + k) % m]
            quarters += [(a, w // 2), (a + w // 2, w - w // 2)]
        for x, y in combinations(range(4), 2):
            if x < 2:
                keys.append((i, _mask(first) | _mask(quarters[x]) | _mask(quarters[y])))
    return keys


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, tau: int = 4) -> DataFrame:
    """``(a, b)``: a forest over distinct ``fp`` values whose components are
    those of all links of at most ``tau`` bits."""
    keys, segments, m = chain_keys(tau), ring(tau), tau + 1
    chain = [[np.uint64(sum(_mask(segments[(i + k) % m]) for k in range(n))) for n in range(2, m)] for i in range(m)]
    start = np.array([i for i, _ in keys])
    slots = F.array(*[F.struct(F.lit(s).alias("slot"), F.lit(_signed(k)).cast("long").alias("mask"))
                      for s, (_, k) in enumerate(keys)])
    rows = (fps.select("fp", F.explode(slots).alias("s"))
            .select(F.col("s.slot").alias("slot"), F.col("fp").bitwiseAND(F.col("s.mask")).alias("value"), "fp"))

    def compare(columns, pairs):
        fp, begin = columns["fp"].view(np.uint64), start[columns["slot"]]
        found = Links(len(fp))
        for a, b in pairs():
            x = fp[a] ^ fp[b]
            for n in range(2, m):                    # chains of 2, 3 ... segments
                mask = np.array([c[n - 2] for c in chain], np.uint64)[begin[a]]
                ok = np.bitwise_count(x & mask) <= n * tau // m
                a, b, x = a[ok], b[ok], x[ok]
                if not len(a):
                    break
            if len(a):
                ok = np.bitwise_count(x) <= tau
                found.add(a[ok], b[ok])
        found.fold()
        at = np.flatnonzero(found.label != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(fp[at].view(np.int64)),
                                           pa.array(fp[found.label[at]].view(np.int64))], names=["a", "b"])

    return compare_buckets(rows, ["slot", "value"], "fp", BLOCK, "a bigint, b bigint", compare)


def near_duplicates(docs: DataFrame, shingle: int = 4, tau: int = 4, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """``(key, fingerprint, component_id)`` of each row of ``docs``.

    ``component_id`` is the smallest key of all rows reachable by links of at
    most ``tau`` bits.  Equal fingerprints are one node, however many rows have
    them.  Null and empty texts have fingerprint zero, linked like any other;
    null keys are rows too, but never a component's name unless it has no other
    (then null); repeated rows stay; an empty table gives an empty result;
    further columns are not read.
    """
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    found = cut_lineage(fingerprints(rows, ["k"], shingle, "t"))
    named = _components(found, tau, F.col("k")).withColumnRenamed("low", "component_id")
    return found.join(named, "fp").select(
        F.col("k").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _components(found: DataFrame, tau: int, smallest: Column) -> DataFrame:
    """``(fp, low)``: the minimum of ``smallest`` over each fingerprint's component."""
    nodes = cut_lineage(found.groupBy("fp").agg(F.min(smallest).alias("low")))
    roots = components(links(nodes.select("fp"), tau))
    named = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    low = named.groupBy("root").agg(F.min("low").alias("low"))
    # The small side is dealt out anew: then AQE can split the partition of a large component.
    return named.select("fp", "root").join(low.hint("rebalance"), "root").select("fp", "low")


def keep_one(docs: DataFrame, shingle: int = 4, tau: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, with all its columns: that of the smallest
    (key, hash of the text), where null keys come first; of rows that repeat
    each other in key and text, one.  Otherwise as ``near_duplicates``."""
    given = numbered(docs)
    at_key, at_text = (f"c{docs.columns.index(c)}" for c in (key, text))
    rows = given.withColumn("__h", F.xxhash64(F.col(at_text).cast("string")))
    ids = rows.select(F.col(at_key).alias("k"), F.col("__h").alias("h"), F.col(at_text).alias("t"))
    found = cut_lineage(fingerprints(ids, ["k", "h"], shingle, "t"))
    first = _components(found, tau, F.struct("k", "h")).groupBy("low").agg(F.count(F.lit(1)).alias("n"))
    first = first.select(F.col("low.k").alias("__k"), F.col("low.h").alias("__g"))
    return (rows.dropDuplicates([at_key, "__h"])
            .join(first, F.col(at_key).eqNullSafe(F.col("__k")) & (F.col("__h") == F.col("__g")), "left_semi")
            .drop("__h").toDF(*docs.columns))
