"""Comparing the rows of many buckets inside tasks, without emitting pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import blocks_of_hot_keys, small_batches


class Links:
    """Collects index pairs of one chunk; keeps a spanning forest, not the pairs."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.pairs.append((a, b))
            self.held += len(a)
            if self.held > 1 << 20:
                self.fold()

    def fold(self) -> None:
        if not self.pairs:
            return
        a, b = (np.concatenate(x) for x in zip(*self.pairs, strict=True))
        label = self.label
        while True:
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                break
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            low = np.minimum(x, y)
            np.minimum.at(label, np.maximum(x, y), low)
            while (label[label] != label).any():
                label = label[label]
        self.label, self.pairs, self.held = label, [], 0


def compare_buckets(rows: DataFrame, keys: Sequence[str], spread: str, size: int, schema: str,
                    compare: Callable[[dict[str, object], Callable], pa.RecordBatch | None]) -> DataFrame:
    """Bring rows of equal ``keys`` together and let ``compare`` look at pairs.

    ``compare(columns, pairs)`` gets the columns of a chunk of whole buckets as
    numpy arrays (binary columns as lists) and ``pairs()``, which yields index
    arrays ``(i, j)`` so that every pair of rows of a bucket comes exactly once,
    a bounded number at a time.  It returns one batch of ``schema`` or None.
    Buckets over ``size`` rows are dealt to several tasks as pairs of blocks.
    """
    small_batches(rows.sparkSession)
    group = [*keys, "bi", "bj"]
    dealt = blocks_of_hot_keys(rows, keys, spread, size).repartition(*group).sortWithinPartitions(*group)

    def chunk(table: pa.Table) -> Iterator[pa.RecordBatch]:
        columns = {n: (c.to_pylist() if pa.types.is_binary(c.type) else c.to_numpy())
                   for n, c in zip(table.column_names, table.columns, strict=True)}
        new = np.zeros(len(table), bool)
        new[:1] = True
        for k in group:
            new[1:] |= columns[k][1:] != columns[k][:-1]
        begin = np.flatnonzero(new)
        length = np.diff(np.append(begin, len(table)))
        left = np.repeat(begin + length, length) - np.arange(len(table))   # rows up to the bucket's end
        split, own = columns["bi"] != columns["bj"], columns["own"]

        def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            at = np.arange(len(table))
            for step in range(1, int(length.max(initial=0))):
                at = at[left[at] > step]
                a, b = at, at + step
                met = ~split[a] | (own[a] != own[b])
                yield a[met], b[met]

        out = compare(columns, pairs)
        if out is not None and out.num_rows:
            yield out

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < 8192:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            same = np.ones(n, bool)
            for k in group:
                c = table.column(k).to_numpy()
                same &= c == c[-1]
            cut = n - int(np.argmin(same[::-1])) if not same.all() else 0   # the last bucket may go on
            if cut:
                yield from chunk(table.slice(0, cut))
            held, n = table.slice(cut).to_batches(), n - cut
        if n:
            yield from chunk(pa.Table.from_batches(held).combine_chunks())

    return dealt.mapInArrow(run, schema)
