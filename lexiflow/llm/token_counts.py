"""Token counts of whole texts by rank-synchronous merging in numpy."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Bpe, load
from .common import map_texts

# Pre-tokens whose counts a worker remembers at most.
MEMO = 400_000


class Counter:
    """``count(texts)``: tokens of each text.

    The distinct pre-tokens of a batch that the bounded memo lacks are merged
    together as one ragged array (``Bpe.merge``) and their surviving symbols
    counted.
    """

    def __init__(self, bpe: Bpe, memo: int = MEMO):
        self.bpe, self.limit = bpe, memo
        self.memo: dict[str, int] = dict.fromkeys(bpe.special, 1) | {"": 0}

    def _count(self, words: list[str]) -> list[int]:
        return self.bpe.merge([w.encode("utf-8") for w in words])[1].tolist()

    def count(self, texts: pa.Array) -> np.ndarray:
        pieces, codes, counts = self.bpe.pieces(texts)
        found = list(map(self.memo.get, pieces))
        new = [i for i, n in enumerate(found) if n is None]
        if new:
            words = [pieces[i] for i in new]
            counted = self._count(words)
            for i, n in zip(new, counted, strict=True):
                found[i] = n
            if len(self.memo) + len(new) <= self.limit:
                self.memo.update(zip(words, counted, strict=True))
        n = np.array(found, np.int64)
        total = np.concatenate(([0], np.cumsum(n[codes])))
        stop = np.cumsum(counts)
        return total[stop] - total[stop - counts]


@functools.cache
def counter(path: str) -> Counter:
    return Counter(load(path))


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                 limit: int = 512) -> DataFrame:
    """``(key, n_bytes, n_tokens, over_limit)`` of every row of ``docs``.

    ``path`` is a tokenizers file with byte-level BPE, readable on executors.
    Counts are the library's, special tokens' strings inside texts included.
    A null text counts as empty (0, 0, false); repeated rows and null keys stay
    rows of their own; an empty table gives an empty result; further columns,
    whatever their names, are not read.
    """
    kind = docs.schema[key].dataType.simpleString()

    def make(texts: pa.Array) -> dict[str, object]:
        return {"n_bytes": pc.binary_length(texts).cast("int64"), "n_tokens": counter(path).count(texts)}

    out = map_texts(docs, [key], text, f"`{key}` {kind}, n_bytes bigint, n_tokens bigint", make)
    return out.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
