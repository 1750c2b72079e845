"""Running totals and draws for contexts of any number of choices.

Rows are counted in runs: an array of contexts, one of their choices and the places
of these, in order.  Runs are dealt by ranges of context and choice and summed on
three levels: blocks of at most 64 choices, the blocks of one part, the parts of
one context.  No task holds a context; a draw finds its block by an equi join
before it compares anything.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from . import sampling as R

BLOCK = 64
# Rows that are counted at a time, those of a run and, about, those of a part.
COUNTED, RUN, PART = 1 << 20, 1 << 14, 1 << 19
# Rows of runs and blocks are long, so a group of them that is read at once has few.
SMALL_GROUPS = {"parquet.block.size": 16 << 20}
RUN_COLS = ["_ctxs", "_sizes", "_choices", "_at", "_counts"]


class _Pairs(NamedTuple):
    """Counts ``n`` of context and choice, as numbers in the order of the values (null: 0)."""

    ctx: np.ndarray
    choice: np.ndarray
    n: np.ndarray
    ctxs: pa.Array
    choices: pa.Array

    def summed(self) -> _Pairs:
        """The different pairs in order."""
        key = self.ctx * len(self.choices) + self.choice
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        n = np.add.reduceat(self.n[order], first) if len(first) else self.n
        return self._replace(ctx=key[first] // len(self.choices), choice=key[first] % len(self.choices), n=n)

    def rows(self, begin: np.ndarray) -> list[pa.Array]:
        """The pairs, which are in order, as runs that begin at the rows ``begin``."""
        run = np.zeros(len(self.ctx), np.int64)
        run[begin[1:]] = 1
        run = np.cumsum(run)
        first = np.flatnonzero(np.diff(self.ctx, prepend=-1) | np.diff(run, prepend=-1))
        used, at = np.unique(run * len(self.choices) + self.choice, return_inverse=True)
        each = np.arange(len(begin) + 1)
        start = np.searchsorted(used // len(self.choices), each)
        of = np.searchsorted(run[first], each)
        rows = np.append(begin, len(self.ctx))
        values = [(of, self.ctxs.take(pa.array(self.ctx[first]))),
                  (of, pa.array(np.diff(first, append=len(run)).astype(np.int32))),
                  (start, self.choices.take(pa.array(used % len(self.choices)))),
                  (rows, pa.array((at - start[run]).astype(np.int32))), (rows, pa.array(self.n))]
        return [pa.ListArray.from_arrays(pa.array(o.astype(np.int32)), v) for o, v in values]


def _coded(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The values as numbers in their order, and what the numbers stand for: 0 for null."""
    coded = values.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    number = np.zeros(len(order) + 1, np.int64)
    number[order] = np.arange(1, len(order) + 1)
    return (number[coded.indices.fill_null(len(order)).to_numpy()],
            pa.concat_arrays([pa.nulls(1, values.type), coded.dictionary.take(pa.array(order))]))


def _pairs(runs: pa.RecordBatch, bounds: list[pa.Array] | None = None) -> tuple[_Pairs, np.ndarray]:
    """The pairs of the runs, added up, and the rows where those from each of ``bounds`` on begin."""
    ctxs, sizes, choices, at, n = (runs.column(c) for c in RUN_COLS)
    own = np.repeat(np.append(0, np.cumsum(choices.value_lengths().to_numpy())[:-1]), at.value_lengths().to_numpy())
    after = bounds or [pa.nulls(0, ctxs.type.value_type), pa.nulls(0, choices.type.value_type)]
    ctx, ctxs = _coded(pa.concat_arrays([ctxs.flatten(), after[0]]))
    choice, choices = _coded(pa.concat_arrays([choices.flatten(), after[1]]))
    k, c = len(ctx) - len(after[0]), len(choice) - len(after[0])
    pairs = _Pairs(np.repeat(ctx[:k], sizes.flatten().to_numpy()), choice[own + at.flatten().to_numpy()],
                   n.flatten().to_numpy(), ctxs, choices).summed()
    return pairs, np.searchsorted(pairs.ctx * len(choices) + pairs.choice, ctx[k:] * len(choices) + choice[c:])


def _arrow_types(runs: DataFrame) -> list[pa.DataType]:
    """The types of the runs' contexts and choices."""
    from pyspark.sql.pandas.types import to_arrow_type
    return [to_arrow_type(runs.schema[c].dataType.elementType) for c in ("_ctxs", "_choices")]


def _run_schema(ctx: str, choice: str) -> str:
    return f"_ctxs array<{ctx}>, _sizes array<int>, _choices array<{choice}>, _at array<int>, _counts array<bigint>"


def _run_batch(pairs: _Pairs) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(pairs.rows(np.arange(0, len(pairs.ctx), RUN)), names=RUN_COLS)


def _chunks(batches: Iterable[list[pa.Array]]) -> Iterator[list[pa.Array]]:
    """The columns of all batches, ``COUNTED`` rows at a time."""
    held: list[list[pa.Array]] = []
    for batch in batches:
        held.append(batch)
        if sum(len(b[0]) for b in held) >= COUNTED:
            whole = [pa.concat_arrays(c) for c in zip(*held, strict=True)]
            end = len(whole[0]) // COUNTED * COUNTED
            for begin in range(0, end, COUNTED):
                yield [c.slice(begin, COUNTED) for c in whole]
            held = [[c.slice(end) for c in whole]]
    if sum(len(b[0]) for b in held):
        yield [pa.concat_arrays(c) for c in zip(*held, strict=True)]


def count_followers(df: DataFrame, items: str) -> DataFrame:
    """A10 over the arrays ``items``: how often one item follows another, as
    ``chars.transitions`` counts the pairs, in runs that the functions below take as
    ``transitions``; they add up the runs.  Pairs are counted where the arrays are
    read, so that there is no row for a single one."""
    kind = df.schema[items].dataType.elementType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def columns() -> Iterator[list[pa.Array]]:
            for batch in batches:
                sizes = batch.column(0).value_lengths().fill_null(0).to_numpy()
                values = batch.column(0).flatten()
                ends = np.zeros(len(values), bool)
                ends[np.cumsum(sizes)[sizes > 0] - 1] = True
                yield [values, pa.array(ends)]

        before: list[pa.Array] = []                  # the last item of the rows before
        for values, ends in _chunks(columns()):
            if before:
                values, ends = pa.concat_arrays([before[0], values]), pa.concat_arrays([before[1], ends])
            before = [values.slice(len(values) - 1), ends.slice(len(ends) - 1)]
            code, names = _coded(values)
            on = np.flatnonzero(~ends.to_numpy(zero_copy_only=False)[:-1])
            if len(on):
                yield _run_batch(_Pairs(code[on], code[on + 1], np.ones(len(on), np.int64), names, names).summed())

    return df.select(items).mapInArrow(run, _run_schema(kind, kind))


def _counted(transitions: DataFrame, ctx: str, choice: str, n: str) -> DataFrame:
    """The runs of rows ``(ctx, choice, n)``; runs are left as they are."""
    if transitions.columns == RUN_COLS:
        return transitions
    rows = transitions.where(F.col(n) > 0).select(ctx, choice, F.col(n).cast("long").alias("n"))
    kinds = [rows.schema[i].dataType.simpleString() for i in range(2)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ctxs, choices, counts in _chunks(b.columns for b in batches):
            coded, choice_coded = _coded(ctxs), _coded(choices)
            yield _run_batch(_Pairs(coded[0], choice_coded[0], counts.to_numpy(), coded[1], choice_coded[1]).summed())

    return rows.mapInArrow(run, _run_schema(*kinds))


def _bounds(runs: DataFrame) -> list[tuple[object, object]]:
    """The first context and choice of each part but the first.  Every run's first pair
    stands for the run, so that parts are about alike whatever the pairs."""
    parts = -(-runs.count() * RUN // PART)
    if parts < 2:
        return []
    dealt = runs.select("ctx", "choice").repartitionByRange(parts, "ctx", "choice").groupBy(F.spark_partition_id().alias("_part"))
    first = dealt.agg(F.min(F.struct("ctx", "choice")).alias("b")).orderBy("_part").collect()
    return [(r.b.ctx, r.b.choice) for r in first[1:]]


def _dealer(bounds: list[pa.Array]):
    """A function that cuts runs where the parts begin, with the number of the part."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), COUNTED // RUN):
                pairs, begin = _pairs(batch.slice(i, COUNTED // RUN), bounds)
                begin = np.append(0, begin)
                part = np.flatnonzero(np.diff(begin, append=len(pairs.ctx)))
                yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), *pairs.rows(begin[part])],
                                                 names=["_part", *RUN_COLS])
    return run


def _in_blocks(runs: pa.Table) -> pa.Table:
    """Blocks of the runs of one part.

    ``inner`` is the sum of the context's counts before the block, in this part,
    ``psum`` that of all its counts there and ``pn`` its blocks; ``cums`` are the running
    totals after each choice, from the block's start.  ``edge``: the part's first or last context.
    """
    pairs, _ = _pairs(runs.combine_chunks().to_batches()[0])
    new = np.diff(pairs.ctx, prepend=-1) != 0
    begin, run = np.flatnonzero(new), np.cumsum(new) - 1
    cums = np.cumsum(pairs.n)
    cums -= (cums - pairs.n)[begin][run]
    first = np.flatnonzero((np.arange(len(run)) - begin[run]) % BLOCK == 0)
    stop = np.append(first[1:], len(run))
    inner, of = cums[first] - pairs.n[first], run[first]
    psum = cums[np.append(begin[1:], len(run)) - 1][of]
    cums -= np.repeat(inner, stop - first)
    edges = pa.array(np.append(first, len(run)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(edges, pa.array(v) if isinstance(v, np.ndarray) else v)
             for v in (pairs.choices.take(pa.array(pairs.choice)), pairs.n, cums)]
    return pa.Table.from_arrays(
        [pairs.ctxs.take(pa.array(pairs.ctx[first])), pa.array(np.full(len(first), runs.column(0)[0].as_py(), np.int32)),
         pa.array(inner), pa.array(cums[stop - 1]), pa.array(psum), pa.array(np.bincount(of)[of]),
         pa.array((of == 0) | (of == run[-1])), *lists],
        names=["ctx", "_part", "_inner", "_sum", "_psum", "_pn", "_edge", "_choices", "_counts", "_cums"])


def choice_blocks(transitions: DataFrame, ctx: str = "ch", choice: str = "next_ch", n: str = "n") -> DataFrame:
    """``(ctx, _before, _sum, total, _blocks, _choices, _counts, _cums)``: the choices
    of a context in order, 64 at most a row, with their running totals from the row's
    start, the sum of all before them, the context's total and how many rows it has.  Choices
    without a positive count are left out; a context may be null.

    Only the first and last context of a part can go on in others, so only theirs are
    looked up."""
    mark = F.get("_ctxs", F.lit(0)).alias("ctx"), F.get("_choices", F.get("_at", F.lit(0))).alias("choice")
    runs = stored(_counted(transitions, ctx, choice, n).select("*", *mark), "choice-runs", **SMALL_GROUPS)
    kind, one = (runs.schema[c].dataType.elementType.simpleString() for c in ("_ctxs", "_choices"))
    bounds = _bounds(runs)
    cuts = [pa.array([b[i] for b in bounds], t) for i, t in enumerate(_arrow_types(runs))]
    dealt = runs.select(RUN_COLS).mapInArrow(_dealer(cuts), f"_part int, {_run_schema(kind, one)}")
    blocks = stored(dealt.groupBy("_part").applyInArrow(
        _in_blocks, f"ctx {kind}, _part int, _inner bigint, _sum bigint, _psum bigint, _pn bigint, _edge boolean, "
        f"_choices array<{one}>, _counts array<bigint>, _cums array<bigint>"), "choice-blocks", **SMALL_GROUPS)
    whole = Window.partitionBy("_pctx")
    earlier = whole.orderBy("_ppart").rowsBetween(Window.unboundedPreceding, -1)
    edges = blocks.where("_edge and _inner = 0").select(F.col("ctx").alias("_pctx"), F.col("_part").alias("_ppart"), "_psum", "_pn")
    places = edges.select("_pctx", "_ppart", F.coalesce(F.sum("_psum").over(earlier), F.lit(0)).alias("_pbefore"),
                          F.sum("_psum").over(whole).alias("_ptotal"), F.sum("_pn").over(whole).alias("_pblocks"))
    met = blocks.join(F.broadcast(places), (F.col("_part") == F.col("_ppart")) & F.col("ctx").eqNullSafe(F.col("_pctx")), "left")
    return met.select("ctx", (F.coalesce("_pbefore", F.lit(0)) + F.col("_inner")).alias("_before"), "_sum",
                      F.coalesce("_ptotal", "_psum").alias("total"), F.coalesce("_pblocks", "_pn").alias("_blocks"),
                      "_choices", "_counts", "_cums")


def cumulate_wide(transitions: DataFrame, ctx: str = "ch", choice: str = "next_ch", n: str = "n") -> DataFrame:
    """``(ctx, choice, n, cum, total)`` as ``sampling.cumulate`` gives them,
    for contexts of any width (choices that come twice are added up)."""
    rows = choice_blocks(transitions, ctx, choice, n).withColumn("_c", F.arrays_zip("_choices", "_counts", "_cums"))
    rows = rows.select("ctx", "_before", "total", F.explode_outer("_c").alias("_c"))
    return rows.select(F.col("ctx").alias(ctx), F.col("_c._choices").alias(choice), F.col("_c._counts").alias(n),
                       (F.col("_before") + F.col("_c._cums")).alias("cum"), "total")


def draw_wide(requests: DataFrame, transitions: DataFrame, seed: int = 12345, key: str = "req_id",
              ctx: str = "ch", choice: str = "next_ch", n: str = "n") -> DataFrame:
    """R02 + J07: ``requests`` with ``(r, drawn)`` as ``sampling.draw`` gives them,
    for contexts of any width.

    A context's counts are laid in as many cells of equal mass as it has blocks.
    A draw ``r`` is joined by context and cell with the blocks that reach into the
    cell, at most one of which holds ``r``; its choice is then picked among the
    block's 64.  Requests of a context spread over its cells.  A request whose
    context is unknown or null-keyed keeps its row, with nulls.
    """
    blocks = choice_blocks(transitions, ctx, choice, n)
    size = F.ceil(F.col("total") / F.col("_blocks")).cast("long")
    first, last = F.floor(F.col("_before") / size), F.floor((F.col("_before") + F.col("_sum") - 1) / size)
    cells = blocks.select(
        F.col("ctx").alias("_bctx"), "_before", "_sum", "_choices", "_cums",
        F.explode(F.sequence(first, last)).alias("_bcell"))
    totals = blocks.where("_before = 0").select(F.col("ctx").alias("_tctx"), F.col("total").alias("_total"), F.col("_blocks").alias("_n"))
    asked = requests.join(totals, F.col(ctx) == F.col("_tctx"), "left")
    asked = asked.withColumn("r", R.draw_value(key, seed, "_total"))
    cell = F.floor(F.col("r") / F.ceil(F.col("_total") / F.col("_n")).cast("long"))
    asked = asked.withColumn("_cell", cell)
    holds = (F.col("_before") <= F.col("r")) & (F.col("r") < F.col("_before") + F.col("_sum"))
    found = asked.join(cells, (F.col(ctx) == F.col("_bctx")) & (F.col("_cell") == F.col("_bcell")) & holds, "left")
    at = F.size(F.filter("_cums", lambda c: c <= F.col("r") - F.col("_before")))
    drawn = F.when(F.col("r").isNotNull(), F.get(F.col("_choices"), at))
    return found.select(*[F.col(f"`{c}`") for c in requests.columns], "r", drawn.alias("drawn"))
