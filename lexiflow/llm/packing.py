"""Best-fit-decreasing packing of tokenized documents into sequences."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, map_texts, numbered
from .encode import as_binary, encoder

# Pieces that one task packs; the number of tasks grows with the pieces.
GROUP = 32_768


def token_pieces(docs: DataFrame, path: str, width: int = 2048, end_id: int = 0,
                 key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, piece, start, length, ids)``: each document's ids with ``end_id``
    behind them, cut every ``width`` ids; ids are little-endian uint32.

    A null or empty text is the end id alone.  Repeated rows and null keys are
    documents of their own; an empty table gives an empty result; further
    columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()

    def make(texts: pa.Array) -> dict[str, object]:
        ids, counts = encoder(path).encode(texts)
        stop = np.cumsum(counts)
        ids = np.insert(ids, stop, end_id)
        return {"ids": as_binary(ids, counts + 1)}

    rows = map_texts(docs, [key], text, f"`{key}` {kind}, ids binary", make)
    n = (F.length("ids") / 4).cast("int")
    cut = rows.withColumn("piece", F.explode(F.sequence(F.lit(0), F.floor((n - 1) / F.lit(width)).cast("int"))))
    part = F.expr(f"substring(ids, piece * {4 * width} + 1, {4 * width})")
    return cut.select(f"`{key}`", "piece", (F.col("piece").cast("long") * width).alias("start"),
                      (F.length(part) / 4).cast("long").alias("length"), part.alias("ids"))


class OpenBins:
    """A segment tree over remaining capacities 0..width: a node is true if a
    bin with a capacity of its range is open."""

    def __init__(self, width: int):
        self.leaves = 1 << width.bit_length()
        self.some = bytearray(2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(width + 1)]

    def add(self, room: int, number: int) -> None:
        self.bins[room].append(number)
        i = room + self.leaves
        while i and not self.some[i]:
            self.some[i] = 1
            i >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """Remove the bin of least room that still holds ``length``."""
        some, i = self.some, length + self.leaves
        if i >= 2 * self.leaves:
            return None
        if not some[i]:
            while i > 1 and (i & 1 or not some[i + 1]):     # up, until a range to the right is open
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:                          # down, to its smallest room
                i = 2 * i if some[2 * i] else 2 * i + 1
        room = i - self.leaves
        number = self.bins[room].pop()
        if not self.bins[room]:
            some[i] = 0
            i >>= 1
            while i and not (some[2 * i] or some[2 * i + 1]):
                some[i] = 0
                i >>= 1
        return room, number


def best_fit(lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each length (1..width), by best-fit decreasing."""
    bins, offsets, tree, n = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), OpenBins(width), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        room, number = tree.take(length) or (width, n)
        n += number == n
        bins[i], offsets[i] = number, width - room
        if room > length:
            tree.add(room - length, number)
    return bins, offsets


def pack(pieces: DataFrame, width: int = 2048, length: str = "length", group: int = GROUP) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` (gapless from 0) to rows of ``length``.

    Rows are dealt by a hash of their columns and their place in the checkpoint
    (so that repeated rows part) into ceil(rows / group) groups, each packed by one task; so the waste against one packing of all is
    about one sequence a group.  The input is checkpointed, since the number of
    groups is read from it.  Lengths must be 1..width (others fail the job); a
    null length is no piece: its row has null ids.  Repeated rows are packed
    each; an empty table gives an empty result; columns named like the new ones
    are replaced.
    """
    pieces = pieces.drop("sequence_id", "offset")
    names, length = pieces.columns, f"c{pieces.columns.index(length)}"
    rows = cut_lineage(numbered(pieces))
    groups = max(1, -(-rows.count() // group))
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id(), *rows.columns), F.lit(groups))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)

    def run(key: tuple[int], part: pd.DataFrame) -> pd.DataFrame:
        given = part[length].notna().to_numpy()
        size = part.loc[given, length].to_numpy(np.int64)
        if len(size) and not (size.min() >= 1 and size.max() <= width):
            raise ValueError(f"lengths must be from 1 to {width}")
        numbers, offsets = best_fit(size, width)
        part = part.drop(columns="__group")
        for name, values in (("sequence_id", numbers + (int(key[0]) << 40)), ("offset", offsets)):
            column = pd.array([pd.NA] * len(part), dtype="Int64")
            column[given] = values
            part[name] = column
        return part

    return rows.withColumn("__group", spread).groupBy("__group").applyInPandas(
        run, f"{schema}, sequence_id bigint, offset bigint").toDF(*names, "sequence_id", "offset")
