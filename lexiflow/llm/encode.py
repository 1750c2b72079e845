"""Token ids of whole texts, each distinct pre-token once a batch.

``Encoder`` numbers the distinct pre-tokens of a batch (``Bpe.pieces``), merges
those that its bounded memo lacks all together (``Bpe.merge``) and writes each
text as a row of them.  The ids are the tokenizers library's; tests compare.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

from .bpe import Bpe, gather, load

# Pre-tokens that one worker's memo holds at most; beyond that, new ones are
# merged again when they come again.
MEMO = 300_000


class Encoder:
    """``encode(texts)``: the uint32 ids of all texts in a row, and their counts."""

    def __init__(self, path: str, memo: int = MEMO):
        self.bpe: Bpe = load(path)
        self.wide = np.dtype(np.uint16 if len(self.bpe.token_of) <= 1 << 16 else np.uint32)
        self.limit = memo
        self.memo = {t: self.wide.type(i).tobytes() for t, i in self.bpe.special.items()} | {"": b""}

    def _merge(self, words: list[str]) -> list[bytes]:
        ids, n = self.bpe.merge([w.encode("utf-8") for w in words])
        raw = ids.astype(self.wide).tobytes()
        stop = (np.cumsum(n) * self.wide.itemsize).tolist()
        return [raw[a:b] for a, b in zip([0, *stop], stop)]  # noqa: B905

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        pieces, codes, counts = self.bpe.pieces(texts)
        raw = list(map(self.memo.get, pieces))
        new = [i for i, ids in enumerate(raw) if ids is None]
        if new:
            words = [pieces[i] for i in new]
            merged = self._merge(words)
            for i, ids in zip(new, merged, strict=True):
                raw[i] = ids
            if len(self.memo) + len(new) <= self.limit:
                self.memo.update(zip(words, merged, strict=True))
        size = np.fromiter(map(len, raw), np.int64, len(raw)) // self.wide.itemsize
        total = np.concatenate(([0], np.cumsum(size[codes])))
        stop = np.cumsum(counts)
        ids = gather(np.frombuffer(b"".join(raw), self.wide), size, codes)
        return ids.astype(np.uint32), total[stop] - total[stop - counts]


def as_binary(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Rows of uint32 ids as Arrow binaries, little-endian."""
    offsets = np.concatenate(([0], np.cumsum(counts) * 4))
    raw = np.ascontiguousarray(ids, "<u4")
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw)]
    ).cast(pa.binary())


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder, with its memo, for each file and Python worker."""
    return Encoder(path)
