"""Audit of how the sources of a language differ in the words they use.

Terms are counted batch by batch in numpy: terms of up to 8 and up to 16 bytes
become one or two uint64 words, are sorted by radix passes over 16-bit digits
and counted as runs; longer terms are sorted as bytes, in buckets of like
length.  Spark sums the batches' counts, and compares sources in tiles.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import regrouped, small_batches

# Text that is sorted at a time; a single longer text is taken whole.
BATCH_BYTES = 8 << 20
# Terms and sources of one side of a tile: what one task compares.
TERM_BLOCK, SOURCE_TILE = 8192, 256
SCALE = 1_000_000_000

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Keeps the first n bytes of a big-endian word.
_KEEP = np.array([0] + [(1 << 64) - (1 << (64 - 8 * n)) for n in range(1, 9)], np.uint64)


def find_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(bytes, start, length, row)`` of the terms of all texts: longest runs of
    ASCII letters and of characters beyond ASCII; A-Z in the bytes are lowered."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), *(np.zeros(0, np.int64) for _ in range(3))
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    inside = _LETTER[data]
    cut = np.zeros(len(data) + 1, bool)          # a text begins here, or all end
    cut[offsets] = True
    start = np.flatnonzero(inside & (cut[:-1] | ~np.concatenate(([False], inside[:-1]))))
    stop = np.flatnonzero(inside & (cut[1:] | ~np.concatenate((inside[1:], [False])))) + 1
    return _LOWER[data], start, stop - start, np.searchsorted(offsets, start, "right") - 1


def radix_order(words: list[np.ndarray], order: np.ndarray | None = None) -> np.ndarray:
    """The stable order of rows of unsigned words, most significant word first."""
    order = np.arange(len(words[0])) if order is None else order
    for word in reversed(words):
        for shift in range(0, word.dtype.itemsize * 8, 16):
            digit = (word >> word.dtype.type(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _runs(same: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows in order, where ``same`` says that a row equals the one before:
    the first of each run, its rows, and its distinct ``row`` numbers."""
    first = np.flatnonzero(~same)
    fresh = ~same | np.concatenate(([True], row[1:] != row[:-1]))
    return first, np.diff(np.append(first, len(same))), np.add.reduceat(fresh.astype(np.int64), first)


def count_runs(data: np.ndarray, start: np.ndarray, length: np.ndarray, row: np.ndarray,
               group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(which, count, rows)`` of the distinct (group, term)s: the index of one
    occurrence, how many there are and in how many rows.

    ``row`` must not fall within a group.  Each bucket of lengths is sorted and
    counted by itself: up to 8 bytes, up to 16, then up to each power of two.
    """
    padded = np.concatenate((data, np.zeros(16, np.uint8)))
    bucket = np.maximum(np.ceil(np.log2(np.maximum(length, 1))).astype(np.int64), 3)
    for b in np.unique(bucket).tolist():
        at = np.flatnonzero(bucket == b)
        g = group[at].astype(np.uint32)
        if b <= 4:
            words = []
            for k in range(b - 2):
                raw = padded[start[at, None] + np.arange(8 * k, 8 * k + 8)].view(">u8")[:, 0].astype(np.uint64)
                words.append(raw & _KEEP[np.clip(length[at] - 8 * k, 0, 8)])
            order = radix_order([g, *words])
            same = np.ones(len(at), bool)
            for word in [g, *words]:
                word = word[order]
                same[1:] &= word[1:] == word[:-1]
        else:
            width = 1 << b
            cell = np.zeros((len(at), width), np.uint8)
            mask = np.arange(width) < length[at, None]
            cell[mask] = data[np.repeat(start[at] - np.cumsum(length[at]) + length[at], length[at])
                              + np.arange(length[at].sum())]
            names = cell.view(f"S{width}")[:, 0]
            order = radix_order([g], np.argsort(names, kind="stable"))
            names, sorted_g = names[order], g[order]
            same = np.ones(len(at), bool)
            same[1:] = (names[1:] == names[:-1]) & (sorted_g[1:] == sorted_g[:-1])
        same[0] = False
        at = at[order]
        first, count, rows = _runs(same, row[at])
        yield at[first], count, rows


def _strings(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.Array:
    stop = np.cumsum(length)
    flat = data[np.arange(stop[-1] if len(stop) else 0) + np.repeat(start - stop + length, length)]
    offsets = np.concatenate(([0], stop)).astype(np.int32)
    return pa.StringArray.from_buffers(len(length), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat)))


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences and documents of each term.

    Nulls are read as ''; repeated rows are documents each; an empty table has
    no terms; further columns are not read.  A batch counts its terms before
    anything is shuffled, so a frequent term is one row for each batch and
    source.
    """
    small_batches(docs.sparkSession)
    whole = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = docs.select(whole(lang).alias("lang"), whole(source).alias("source"), whole(text).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in regrouped(batches, "text", BATCH_BYTES):
            data, start, length, row = find_terms(part.column("text"))
            if not len(start):
                continue
            lg, sc = (part.column(c).dictionary_encode() for c in ("lang", "source"))
            code = (lg.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(sc.dictionary)
                    + sc.indices.to_numpy(zero_copy_only=False))
            _, code = np.unique(code, return_inverse=True)
            for which, n, in_rows in count_runs(data, start, length, row, code[row]):
                at = pa.array(row[which])
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang").take(at), part.column("source").take(at),
                     _strings(data, start[which], length[which]), pa.array(n), pa.array(in_rows)],
                    names=["lang", "source", "term", "n", "docs"])

    found = rows.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: Column | str, total: Column | str, terms: Column | str) -> Column:
    """1 + floor(10^9 (n + 5) / (total + 5 terms)), in whole numbers of any size."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (F.col(n) if isinstance(n, str) else n).cast("decimal(19,0)")
    top = top + F.lit(5 * SCALE).cast("decimal(10,0)")
    whole = total + 5 * terms if isinstance(total, Column) else F.col(total) + 5 * F.col(terms)
    return F.lit(1).cast("long") + F.call_function("div", top, whole.cast("decimal(20,0)")).cast("long")


def _distances(key: tuple, cells: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """Sums of |p - q| over the terms of a block, for the pairs of sources of two
    tiles.  A term that neither tile has differs by the sources' own floors, and
    all such terms together by a multiple of it."""
    lang, _, ti, tj = key
    sides, floors = [], []
    names, code = np.unique(cells["term"].to_numpy(object).astype(str), return_inverse=True) if len(cells) else ([], [])
    for t in (ti, tj):
        own = groups[groups["tile"] == t].sort_values("source")
        table = np.repeat(own["floor"].to_numpy(np.int64)[None, :], len(names), axis=0)
        mine = (cells["tile"] == t).to_numpy() if len(cells) else []
        if len(cells):
            place = pd.Index(own["source"]).get_indexer(cells["source"][mine])
            table[code[mine], place] = cells["p"].to_numpy(np.int64)[mine]
        sides.append((own["source"].to_numpy(object), table))
        floors.append(own["floor"].to_numpy(np.int64))
    (a, left), (b, right) = sides
    rest = int(groups["terms"].iloc[0]) - len(names)
    total = np.abs(floors[0][:, None] - floors[1][None, :]) * rest
    for i in range(len(a)):
        total[i] += np.abs(right - left[:, i:i + 1]).sum(axis=0)
    x, y = np.repeat(a, len(b)), np.tile(b, len(a))
    value = total.ravel()
    if ti == tj:
        x, y, value = x[x != y], y[x != y], value[x != y]
    else:
        x, y, value = np.concatenate((x, y)), np.concatenate((y, x)), np.concatenate((value, value))
    return pd.DataFrame({"lang": lang, "source": x, "item": y, "value": value})


def audit(docs: DataFrame, min_docs: int = 30, top: int = 50, text: str = "text", lang: str = "lang",
          source: str = "source", term_block: int = TERM_BLOCK, source_tile: int = SOURCE_TILE) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how a source's words differ.

    Each language keeps the terms that at least ``min_docs`` of its documents
    have.  A source or language gives a kept term, seen n times among its N
    occurrences of the V kept terms, the share p = 1 + floor(10^9 (n + 5) /
    (N + 5 V)).  Part ``pair``: for each other source of the language the sum of
    |p - q| over all kept terms.  Part ``term``: a source's terms of larger share
    than in the language, by the difference, ``top`` ranks.  Ranks go by value
    descending, then by item in UTF-8 order.

    Nulls are read as ''.  A source without any kept term takes part with n = 0;
    a language without a kept term has distances of 0.  Repeated rows count
    each; an empty table gives an empty result; further columns are not read.

    A source that holds a third of all rows is one row for each term and batch
    before the shuffle and one for each kept term after it.  Sources of a
    language are compared in tiles of ``source_tile`` with blocks of
    ``term_block`` terms, so a task's tables have a fixed size.
    """
    counts = term_counts(docs, text, lang, source)
    in_docs = F.sum("docs").over(Window.partitionBy("lang", "term"))
    kept = stored(counts.withColumn("in_docs", in_docs).where(F.col("in_docs") >= min_docs)
                  .select("lang", "source", "term", "n"), "kept-terms")
    whole = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    of_lang = kept.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    sizes = of_lang.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    groups = docs.select(whole(lang).alias("lang"), whole(source).alias("source")).distinct()
    groups = (groups.join(kept.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
              .join(sizes, "lang", "left").fillna(0, ["total", "v", "lang_total"]))
    groups = stored(groups, "groups")
    cells = kept.join(groups, ["lang", "source"]).withColumn("p", _share("n", "total", "v"))

    # Part `term`.
    more = cells.join(of_lang, ["lang", "term"]).withColumn("value", F.col("p") - _share("lang_n", "lang_total", "v"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("term"))
    terms = (more.where("value > 0").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"))

    # Part `pair`.
    shape = groups.groupBy("lang").agg(
        F.ceil(F.max("v") / F.lit(term_block)).cast("int").alias("blocks"),
        F.ceil(F.count(F.lit(1)) / F.lit(source_tile)).cast("int").alias("tiles"))
    shape = shape.withColumn("blocks", F.greatest("blocks", F.lit(1)))
    shape = stored(shape, "shape")
    tile = F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")

    def paired(rows: DataFrame, *names: str) -> DataFrame:
        """Each row once for every tile that its own meets."""
        rows = rows.withColumn("tile", tile)
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        return rows.select("lang", "block", F.least("tile", "other").alias("ti"), F.greatest("tile", "other").alias("tj"),
                           "tile", *names)

    in_block = of_lang.join(shape, "lang").groupBy("lang", block.alias("block")).agg(F.count(F.lit(1)).alias("terms"))
    many = groups.join(shape, "lang").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    many = many.join(in_block, ["lang", "block"], "left").fillna(0, ["terms"])
    least = F.when(F.col("v") > 0, _share(F.lit(0), F.col("total"), F.col("v"))).otherwise(F.lit(0)).cast("long")
    many = paired(many.withColumn("floor", least), "source", "floor", "terms")
    some = paired(cells.join(shape, "lang").withColumn("block", block), "source", "term", "p")
    on = ["lang", "block", "ti", "tj"]
    sums = some.groupBy(*on).cogroup(many.groupBy(*on)).applyInPandas(
        _distances, "lang string, source string, item string, value bigint")
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    near = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value",
                         F.row_number().over(near).alias("rank"))
    return pairs.unionByName(terms)
