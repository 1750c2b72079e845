"""Lookups for the words of documents, block by block.

A block is some documents of one task.  Its different words are numbered, so a
table of words is joined with one row for each of them, however often they occur
there, and the documents are shuffled once, as numbers.  Blocks are written when
they are made: their numbers must not change when a lost task is run again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from ..session import stored

# A block has at most so many words (or one longer document) and documents.
BLOCK_WORDS = 1 << 18
BLOCK_DOCS = 1 << 14
# Rows of counted words that are encoded together, and how often before they make a block.
BLOCK_ROWS = 1 << 18
BLOCK_CHUNKS = 4


def in_blocks(docs: DataFrame, words: str, at: str | None = None, most: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with ``_block`` and, for the array ``words`` (none of them null), its
    words' numbers in the block ``_ids`` (``_short``); a further row a block has its
    ``_words`` in the order of their numbers, the most frequent first.  Documents without a word are left out.  They are
    written to ``at``, a new scratch path if not given; a block has ``most`` words."""
    cols = [c for c in docs.columns if c != words]
    fields = [ST.StructField(f.name, f.dataType) for f in docs.schema if f.name != words]
    kind = ST.StructType([ST.StructField("_block", ST.LongType()), *fields,
                          ST.StructField("_ids", ST.BinaryType()),
                          ST.StructField("_words", ST.ArrayType(ST.StringType()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        names = kind.names
        for batch in batches:
            held = batch.column(len(cols))
            sizes = held.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            batch = batch.take(pa.array(np.flatnonzero(sizes > 0)))
            ends, begin = np.cumsum(sizes[sizes > 0], dtype=np.int64), 0
            while begin < len(ends):
                last = (ends[begin - 1] if begin else 0) + most
                stop = min(max(begin + 1, int(np.searchsorted(ends, last, "right"))), begin + BLOCK_DOCS)
                part = batch.slice(begin, stop - begin)
                flat = part.column(len(cols)).flatten().dictionary_encode()
                offsets = np.append(0, ends[begin:stop] - (ends[begin - 1] if begin else 0))
                found, words = flat.indices.to_numpy(), flat.dictionary
                order = np.argsort(-np.bincount(found, minlength=len(words)), kind="stable")
                number = np.empty(len(words), np.int64)
                number[order] = np.arange(len(words))
                ids, words = _short(number[found], offsets), words.take(pa.array(order))
                numbers = pa.array(np.full(len(part), block, np.int64))
                own = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
                yield pa.RecordBatch.from_arrays([numbers, *part.columns[:-1], ids, pa.nulls(len(part), own.type)], names=names)
                yield pa.RecordBatch.from_arrays([numbers.slice(0, 1), *[pa.nulls(1, c.type) for c in part.columns[:-1]],
                                                  pa.nulls(1, ids.type), own], names=names)
                begin, block = stop, block + 1

    return stored(docs.select(*cols, words).mapInArrow(run, kind), "blocks", at)


def _short(numbers: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Numbers as bytes, those between two offsets as one value: seven bits a byte,
    the high bit set in all but the last byte of a number."""
    size = 1 + sum((numbers >> bits > 0).astype(np.int8) for bits in (7, 14, 21, 28))
    ends = np.append(0, np.cumsum(size, dtype=np.int64))
    out = np.zeros(ends[-1], np.uint8)
    for k in range(int(size.max(initial=0))):
        more = size > k
        out[ends[1:][more] - 1 - k] = (numbers[more] >> 7 * k & 127) | (128 if k else 0)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(ends[offsets].astype(np.int32)), pa.py_buffer(out)])


def _long(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of ``_short``, one behind the other, and where those of each value begin (and the last end)."""
    offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset:values.offset + len(values) + 1].astype(np.int64)
    raw = np.frombuffer(values.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    last = np.flatnonzero(raw < 128)
    first = np.append(0, last[:-1] + 1)[:len(last)]
    numbers, size = np.zeros(len(last), np.int64), last - first + 1
    for k in range(int(size.max(initial=0))):
        more = size > k
        numbers[more] = numbers[more] << 7 | (raw[first[more] + k] & 127)
    return numbers, np.searchsorted(last, offsets - offsets[0])


def counted_blocks(rows: DataFrame, key: str, word: str, times: str | None = None, at: str | None = None) -> DataFrame:
    """Rows of a key and a word (``times`` times, if that column is given) in blocks, one
    row each: its keys ``_keys``, its different words ``_words``, and ``_counts``, the
    numbers of the words that each key has there and how often (``_packed``).  A key may
    be null and may be in several blocks; a word that is null has a number as well."""
    kind = ST.StructType([ST.StructField("_block", ST.LongType()), ST.StructField("_keys", ST.ArrayType(rows.schema[key].dataType)),
                          ST.StructField("_counts", ST.BinaryType()), ST.StructField("_words", ST.ArrayType(ST.StringType()))])

    def encoded(held: list[pa.RecordBatch]) -> tuple[pa.Array, pa.Array, np.ndarray]:
        keys, words, n = (c.combine_chunks() for c in pa.Table.from_batches(held).columns)
        if not pa.types.is_nested(keys.type):              # others cannot be told apart here
            keys = keys.dictionary_encode()
        return keys, words.dictionary_encode(), n.fill_null(0).to_numpy()

    def numbered(values: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
        """Different values, the last one null if there is any, and the number of each."""
        whole = values.unify_dictionaries().combine_chunks()
        code, own = whole.indices.cast(pa.int64()), whole.dictionary
        if code.null_count:
            code, own = code.fill_null(len(own)), pa.concat_arrays([own, pa.nulls(1, own.type)])
        return own, code.to_numpy()

    def cut(chunks: list[tuple[pa.Array, pa.Array, np.ndarray]], block: int) -> pa.RecordBatch:
        keys, words = (pa.chunked_array([c[i] for c in chunks]) for i in (0, 1))
        (words, ids), n = numbered(words), np.concatenate([c[2] for c in chunks])
        keys, code = (keys.combine_chunks(), np.arange(len(n))) if pa.types.is_nested(keys.type) else numbered(keys)
        both = code * len(words) + ids
        order = np.argsort(both, kind="stable")
        both, n = both[order], n[order]
        first = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
        both, n = both[first], np.add.reduceat(n, first)
        whole = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), whole(keys), pa.array([_packed(np.diff(both, prepend=0), n)], pa.binary()),
                                           whole(words)], names=kind.names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, chunks, held, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= BLOCK_ROWS:
                chunks.append(encoded(held))
                held, size = [], 0
                if len(chunks) == BLOCK_CHUNKS:
                    yield cut(chunks, block)
                    block, chunks = block + 1, []
        if size:
            chunks.append(encoded(held))
        if chunks:
            yield cut(chunks, block)

    n = F.col(times).cast("long") if times else F.lit(1).cast("long")
    return stored(rows.select(key, word, n.alias("_n")).mapInArrow(run, kind), "blocks", at)


def _packed(*columns: np.ndarray) -> bytes:
    """Whole numbers, as many in each column, their bytes laid out by weight and compressed."""
    raw = b"".join(np.ascontiguousarray(c, np.int64).view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpacked(data: bytes, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd"), np.uint8)
    return [np.ascontiguousarray(x.T).view(np.int64).ravel() for x in raw.reshape(columns, 8, -1)]


def counted_means(blocks: DataFrame, looked: DataFrame, key: str, value: str, default: Sequence[float]) -> DataFrame:
    """``(key, value, _n)``: for each key of each of the ``counted_blocks`` the mean of the
    arrays ``value`` that were looked up for its words (``block_words`` with that column),
    ``default`` for words without, and how many words it is the mean of."""
    kind = ST.StructType([ST.StructField(key, blocks.schema["_keys"].dataType.elementType),
                          ST.StructField(value, ST.ArrayType(ST.DoubleType())), ST.StructField("_n", ST.LongType())])

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.Table.from_arrays([pa.array([], f.type) for f in target], schema=target)
        gaps, n = _unpacked(docs.column("_counts")[0].as_py(), 2)
        code, ids = np.divmod(np.cumsum(gaps), docs.column("_size")[0].as_py())
        each = np.tile(np.array(default, float), (int(ids.max()) + 1, 1))
        places = found.column("_place").to_numpy()
        each[places] = found.column(value).combine_chunks().flatten().to_numpy().reshape(-1, len(default))
        keys = docs.column("_keys").combine_chunks().flatten()
        count = np.bincount(code, n, len(keys))
        means = np.stack([np.bincount(code, each[ids, c] * n, len(keys)) / count for c in range(len(default))], axis=1)
        return pa.Table.from_arrays([keys, lists_of(means.ravel(), np.arange(len(keys) + 1) * len(default)),
                                     pa.array(count.astype(np.int64))], names=kind.names)

    from pyspark.sql.pandas.types import to_arrow_schema
    target = to_arrow_schema(kind)
    docs = blocks.select(F.col("_block").alias("_of"), "_keys", "_counts", F.size("_words").cast("long").alias("_size"))
    looked = looked.select(F.col("_block").alias("_in"), "_place", value)
    return docs.groupBy("_of").cogroup(looked.groupBy("_in")).applyInArrow(run, kind)


def block_words(blocks: DataFrame) -> DataFrame:
    """``(_block, _place, word)``: each different word of a block, for a lookup."""
    words = blocks.where("_words is not null").select("_block", F.posexplode_outer("_words").alias("_place", "word"))
    return words.where("word is not null")


def with_looked(blocks: DataFrame, looked: DataFrame, fill: Callable[[pa.Table, np.ndarray, np.ndarray, pa.Table, np.ndarray], list],
                added: Sequence[ST.StructField]) -> DataFrame:
    """The documents of the blocks with the columns ``added``, which ``fill`` makes of
    what was looked up for their words (``block_words`` with further columns).

    ``fill`` is given a block's documents, where the words of each begin (and the
    last end), its words' numbers one behind the other, the rows of ``looked`` for the
    block and the row of each number there (-1: none)."""
    cols = [c for c in blocks.columns if c not in ("_block", "_ids", "_words")]
    kind = ST.StructType([*[blocks.schema[c] for c in cols], *added])
    return of_blocks(blocks, looked, lambda docs, *rest: [*[docs.column(c) for c in cols], *fill(docs, *rest)], kind)


def of_blocks(blocks: DataFrame, looked: DataFrame, make: Callable[[pa.Table, np.ndarray, np.ndarray, pa.Table, np.ndarray], list],
              kind: ST.StructType) -> DataFrame:
    """The rows ``kind`` whose columns ``make`` makes of each block; see ``with_looked``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    target = to_arrow_schema(kind)

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        docs, found = docs.combine_chunks(), found.combine_chunks()
        if not docs.num_rows:
            return pa.Table.from_arrays([pa.array([], f.type) for f in target], schema=target)
        ids, begin = _long(docs.column("_ids").combine_chunks())
        places = found.column("_place").to_numpy()
        row = np.full(int(max(ids.max(initial=0), places.max(initial=0))) + 1, -1, np.int64)
        row[places] = np.arange(len(places))
        return pa.Table.from_arrays(make(docs, begin, ids, found, row), names=kind.names)

    cols = [c for c in blocks.columns if c not in ("_block", "_words")]
    docs = blocks.where("_ids is not null").select(F.col("_block").alias("_of"), *cols)
    looked = looked.withColumnRenamed("_block", "_in")
    return docs.groupBy("_of").cogroup(looked.groupBy("_in")).applyInArrow(run, kind)


def lists_of(values: np.ndarray, begin: np.ndarray) -> pa.ListArray:
    """A list of values for each document."""
    return pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(values))
