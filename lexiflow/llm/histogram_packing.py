"""Packing by non-negative least squares over the histogram of lengths.

Documents are cut where they fill whole windows; what is left of each is one
rest.  Only the histogram of lengths, of as many numbers as the window is wide,
is solved: all combinations of up to three lengths that fill a window exactly
are columns, the repeat counts that explain the histogram best, none negative,
are sought, rounded, and the rests they do not use are packed greedily, cut
where a window is full.  Rests are then dealt to their places by their rank in
a global order by length, so no task sees more than its share.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .bpe import load
from .common import map_texts, small_batches
from .encode import as_binary
from .records import ids_of

_ROW_BITS = (1 << 33) - 1        # low bits of monotonically_increasing_id


def combinations(lengths: np.ndarray, width: int) -> np.ndarray:
    """All ways to fill ``width`` with at most three of the ``lengths``, repeats
    allowed: rows of three, longest first, 0 where there are fewer."""
    have = np.zeros(width + 1, bool)
    have[lengths] = True
    rows = [np.array([[width, 0, 0]])] * bool(have[width])
    a = np.flatnonzero(have[:width])
    b = width - a
    two = have[b] & (a >= b)
    rows.append(np.stack((a[two], b[two], np.zeros(two.sum(), np.int64)), 1))
    for longest in a[a >= -(-width // 3)].tolist():
        rest = width - longest
        mid = a[(a <= longest) & (a >= -(-rest // 2)) & (a < rest)]
        mid = mid[have[rest - mid]]
        rows.append(np.stack((np.full(len(mid), longest), mid, rest - mid), 1))
    return np.concatenate(rows).astype(np.int64) if rows else np.zeros((0, 3), np.int64)


def least_squares(ways: np.ndarray, wanted: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that make the squares of (lengths used - ``wanted``) small.

    Projected gradient steps, scaled by each column's own bound on the curvature
    and speeded up by momentum, which starts anew where it points uphill.
    """
    if not len(ways):
        return np.zeros(0)
    size = len(wanted)

    def used(x: np.ndarray) -> np.ndarray:
        total = sum(np.bincount(ways[:, k], x, size) for k in range(3))
        total[0] = 0
        return total

    def along(v: np.ndarray) -> np.ndarray:
        v = v.copy()
        v[0] = 0
        return v[ways].sum(axis=1)

    curve = np.maximum(along(used(np.ones(len(ways)))), 1)
    x = y = np.zeros(len(ways))
    t = 1.0
    for _ in range(rounds):
        slope = along(used(y) - wanted)
        new = np.maximum(0, y - slope / curve)
        if slope @ (new - x) > 0:
            t, y = 1.0, x
            slope = along(used(y) - wanted)
            new = np.maximum(0, y - slope / curve)
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / t_new * (new - x), new, t_new
    return x


def rounded(ways: np.ndarray, x: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Whole counts near ``x`` that use no length more often than it is there.

    Sums of neighbouring counts are rounded rather than each by itself, so many
    small counts do not all vanish.
    """
    total = np.floor(np.cumsum(x) + 0.5).astype(np.int64)
    count = np.diff(total, prepend=0)
    left = wanted.astype(np.int64).copy()
    for j in np.flatnonzero(count):
        way, times = np.unique(ways[j][ways[j] > 0], return_counts=True)
        count[j] = max(0, min(count[j], int((left[way] // times).min())))
        left[way] -= times * count[j]
    return count


@dataclass(frozen=True)
class Plan:
    """Where the rests go, by their rank in the order of length: from ``begin`` on
    (until the next) a rest is the first of sequence ``base`` at ``offset``, the
    next of the next one; or, with ``offset`` -1, from position ``base`` on in the
    row of rests that are cut where a window is full."""

    begin: np.ndarray
    base: np.ndarray
    offset: np.ndarray
    length: np.ndarray
    sequences: int              # filled by combinations
    stream: int                 # tokens of the rests that are cut


def solve(wanted: np.ndarray, width: int) -> Plan:
    """``wanted``: how many rests there are of each length 0..width (none of 0)."""
    wanted = wanted.astype(np.int64)
    ways = combinations(np.flatnonzero(wanted), width)
    count = rounded(ways, least_squares(ways, wanted.astype(float)), wanted)
    first = np.concatenate(([0], np.cumsum(wanted)))[:-1]          # rank of the first rest of a length
    taken = np.zeros(width + 1, np.int64)
    spans, sequence = [], 0
    for way, n in zip(ways[count > 0].tolist(), count[count > 0].tolist(), strict=True):
        at = 0
        for length in filter(None, way):
            spans.append((first[length] + taken[length], sequence, at, length))
            taken[length] += n
            at += length
        sequence += n
    stream = 0
    for length in np.flatnonzero(wanted - taken)[::-1].tolist():   # longest first
        spans.append((first[length] + taken[length], stream, -1, length))
        stream += int(wanted[length] - taken[length]) * length
    columns = np.array(sorted(spans), np.int64).reshape(-1, 4).T
    return Plan(*columns, sequence, stream)


def places(plan: Plan, rank: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of the rests of the given ranks: ``(which rest, from, length, sequence, offset)``.

    The last window of cut rests, if not full, is cut into powers of two, each a
    sequence of its own: these need no padding.
    """
    span = np.searchsorted(plan.begin, rank, "right") - 1
    nth, offset, length = rank - plan.begin[span], plan.offset[span], plan.length[span]
    whole = np.flatnonzero(offset >= 0)
    out = [(whole, np.zeros(len(whole), np.int64), length[whole], plan.base[span[whole]] + nth[whole], offset[whole])]
    cut = np.flatnonzero(offset < 0)
    low = plan.base[span[cut]] + nth[cut] * length[cut]
    high = low + length[cut]
    # Ends of the windows that hold the cut rests.
    full = plan.stream // width * width
    ends, at = [], full
    for bit in range(width.bit_length(), -1, -1):
        if (plan.stream - full) >> bit & 1:
            at += 1 << bit
            ends.append(at)
    ends = np.array(ends, np.int64)

    def window(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and beginning of the window that has each position."""
        late = np.searchsorted(ends, at, "right")
        start = np.concatenate(([full], ends))[np.minimum(late, len(ends))]
        tail = at >= full
        return np.where(tail, full // width + late, at // width), np.where(tail, start, at // width * width)

    def end(at: np.ndarray) -> np.ndarray:
        late = np.minimum(np.searchsorted(ends, at, "right"), max(0, len(ends) - 1))
        stop = ends[late] if len(ends) else at
        return np.where(at >= full, stop, at // width * width + width)

    here, from_ = cut, low
    while len(here):
        number, start = window(from_)
        stop = np.minimum(high, end(from_))
        begin = plan.base[span[here]] + nth[here] * length[here]
        out.append((here, from_ - begin, stop - from_, plan.sequences + number, from_ - start))
        more = stop < high
        here, from_, high = here[more], stop[more], high[more]
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def tokenized(docs: DataFrame, path: str, end_id: int, width: int, key: str = "doc_id",
              text: str = "text") -> DataFrame:
    """``(key, start, length, doc_tokens, ids)``: each document's ids with ``end_id``
    behind them, cut into whole windows and the rest; ids are little-endian, of
    two bytes where all of the vocabulary fit, else of four.

    A null or empty text is the end id alone.  Repeated rows and null keys are
    documents of their own; an empty table gives an empty result; further
    columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    wide = _wide(path, end_id)

    def make(texts: pa.Array) -> dict[str, object]:
        step, tokens, parts = width * wide.itemsize, [], []
        for t in texts.to_pylist():
            raw = np.append(ids_of(t, path), end_id).astype(wide).tobytes()
            tokens.append(len(raw) // wide.itemsize)
            parts.append([raw[i:i + step] for i in range(0, len(raw), step)])
        return {"doc_tokens": pa.array(tokens, pa.int64()), "parts": pa.array(parts, pa.list_(pa.binary()))}

    rows = map_texts(docs, [key], text, f"`{key}` {kind}, doc_tokens bigint, parts array<binary>", make)
    rows = rows.toDF("key", "doc_tokens", "parts").select("key", "doc_tokens", F.posexplode("parts").alias("nth", "ids"))
    return rows.select("key", (F.col("nth") * F.lit(width)).cast("long").alias("start"),
                       (F.length("ids") / wide.itemsize).cast("long").alias("length"), "doc_tokens", "ids")


def _wide(path: str, end_id: int) -> np.dtype:
    return np.dtype("<u2" if max(len(load(path).token_of) - 1, end_id) < 1 << 16 else "<u4")


def pack(docs: DataFrame, path: str, end_id: int, width: int = 2048, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """Tokenize and place: ``(key, start, length, ids, doc_tokens, sequence_id,
    offset)``, each id in exactly one piece, gapless from offset 0 in each sequence.

    ``ids`` are little-endian uint32; see ``tokenized`` for rows of all kinds.
    Every sequence is full, but for at most one for each power of two below
    ``width``, of just that length; so nothing is padded.

    Ids are written once and shuffled once, to their places.  Only lengths are
    sorted: dealt out by length and a hash, so that a length that a third of all
    rests have fills no task.  The driver sees their histogram (at most ``width``
    numbers) and the sizes of partitions; tasks get the plan, of at most three
    spans for each combination and one for each length, whatever the number of
    documents.
    """
    wide, kind = _wide(path, end_id), docs.schema[key].dataType.simpleString()
    rows = cut_lineage(tokenized(docs, path, end_id, width, key, text))
    rows = rows.withColumn("id", F.monotonically_increasing_id())
    order = ["length", F.xxhash64("id")]
    light = cut_lineage(rows.select("id", "length").repartitionByRange(*order).sortWithinPartitions(*order))
    light = light.withColumn("part", F.spark_partition_id())
    by_part = {r.part: r.n for r in light.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = [by_part.get(i, 0) for i in range(max(by_part, default=-1) + 1)]
    wanted = np.zeros(width + 1, np.int64)
    for r in light.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():
        wanted[r.length] = r.n
    before = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((solve(wanted, width), before))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, first = shared.value
        for batch in batches:
            rank = first[batch.column("part").to_numpy()] + batch.column("row").to_numpy()
            which, *found = places(plan, rank, width)
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(which)), *map(pa.array, found)],
                                             names=["id", "from", "piece", "sequence_id", "offset"])

    row = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)).alias("row")
    placed = light.select("id", "part", row).mapInArrow(
        place, "id bigint, from bigint, piece bigint, sequence_id bigint, offset bigint")
    part = F.expr(f"substring(ids, int(from * {wide.itemsize} + 1), int(piece * {wide.itemsize}))")
    found = rows.join(placed, "id").select(
        "key", (F.col("start") + F.col("from")).alias("start"), F.col("piece").alias("length"), part.alias("ids"),
        "doc_tokens", "sequence_id", "offset")
    if wide.itemsize == 2:
        small_batches(docs.sparkSession)
        found = found.mapInArrow(_widened, f"key {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, "
                                           "sequence_id bigint, offset bigint")
    return found.withColumnRenamed("key", key)


def _widened(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of two bytes become ids of four."""
    for batch in batches:
        flat = np.frombuffer(b"".join(batch.column("ids").to_pylist()), "<u2").astype("<u4")
        at = batch.schema.get_field_index("ids")
        yield batch.set_column(at, "ids", as_binary(flat, batch.column("length").to_numpy()))
