"""Splits, draws and text generation.

Every random choice is a hash of a key and a seed, so results do not depend on
partitioning, task order or retries.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from ..conf import GEN_STEPS, SPLIT_FRACTION, SPLIT_SEED
from ..functions import text as T
from ..functions.charset import CHARSET
from ..session import cut_lineage

SPLIT_BUCKETS = 100
# Characters that a task generates at a time.
GENERATED = 1 << 21


def split_flag(key: str | Column, fraction: float = SPLIT_FRACTION,
               seed: int = SPLIT_SEED) -> Column:
    """R01 as a column: true for the train side."""
    return T.hash_bucket(key, seed, SPLIT_BUCKETS) < int(round(fraction * SPLIT_BUCKETS))


def hash_split(df: DataFrame, fraction: float = SPLIT_FRACTION, seed: int = SPLIT_SEED,
               key: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(train, test)``; copies of one key never fall on both sides."""
    flagged = df.withColumn("_train", split_flag(key, fraction, seed))
    return (flagged.where("_train").drop("_train"),
            flagged.where(~F.col("_train")).drop("_train"))


def check_split(train: DataFrame, test: DataFrame, whole: DataFrame) -> DataFrame:
    """One row of counts; ``n_overlap``, ``n_missing`` and ``n_extra`` must be 0.

    Rows are tagged by origin and grouped by a digest of their full value
    (SHA-256, taken in the scan, so that no text is shuffled): ``n_overlap``
    counts distinct rows on both sides, ``n_missing`` rows of ``whole`` absent
    from train + test and ``n_extra`` the reverse (multiset differences).
    """
    cols = sorted(whole.columns)

    def digests(df: DataFrame, src: int) -> DataFrame:
        return df.select(F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256).alias("_row"),
                         F.lit(src).alias("_src"))

    tagged = digests(whole, 0).unionByName(digests(train, 1)).unionByName(digests(test, 2))
    per_row = tagged.groupBy("_row").agg(*[
        F.sum((F.col("_src") == s).cast("long")).alias(f"_c{s}") for s in range(3)])
    both = F.col("_c1") + F.col("_c2")
    return per_row.agg(
        F.sum("_c0").alias("n_all"), F.sum("_c1").alias("n_train"), F.sum("_c2").alias("n_test"),
        F.sum(((F.col("_c1") > 0) & (F.col("_c2") > 0)).cast("long")).alias("n_overlap"),
        F.sum(F.greatest(F.col("_c0") - both, F.lit(0))).alias("n_missing"),
        F.sum(F.greatest(both - F.col("_c0"), F.lit(0))).alias("n_extra"))


def cumulate(transitions: DataFrame, ctx: str = "ch", choice: str = "next_ch",
             n: str = "n") -> DataFrame:
    """Running total per context in choice order, plus the context total.

    The window is partitioned by the context, so each group holds at most one
    row per distinct choice.
    """
    w = Window.partitionBy(ctx).orderBy(choice)
    return transitions.select(
        ctx, choice, n,
        F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"),
        F.sum(n).over(Window.partitionBy(ctx)).alias("total"))


def cdf_table(transitions: DataFrame, ctx: str = "ch", choice: str = "next_ch",
              n: str = "n") -> DataFrame:
    """One row per context: ``(ctx, total, choices array<struct<next_ch, cum>>)``.

    The choice array is sorted by ``cum``; its length is bounded by the number
    of distinct choices (77 for the character set).
    """
    c = cumulate(transitions, ctx, choice, n)
    return (c.groupBy(ctx)
             .agg(F.max("total").alias("total"),
                  F.sort_array(F.collect_list(F.struct(F.col("cum"), F.col(choice).alias("next_ch"))))
                   .alias("choices")))


def draw_value(key: str | Column, seed: int | str, total: str | Column) -> Column:
    """Integer draw in ``[0, total)`` from a hash of key and seed."""
    t = F.col(total) if isinstance(total, str) else total
    k = F.col(key) if isinstance(key, str) else key
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string"))), 1, 8), 16, 10)
    return F.pmod(h.cast("long"), t)


def draw(requests: DataFrame, transitions: DataFrame, seed: int = 12345,
         key: str = "req_id", ctx: str = "ch") -> DataFrame:
    """R02 + J07: for each request, the first choice whose running total exceeds
    the draw ``r`` (``r < cum``), i.e. inverse-CDF sampling with integer counts.
    A request whose context has no transition keeps its row, with nulls.

    Equi join on the context, inequality inside the (bounded) choice array, so
    no per-request group or shuffle of the requests is needed beyond the join.
    """
    j = requests.join(cdf_table(transitions, ctx), ctx, "left")
    r = draw_value(key, seed, "total")
    return (j.withColumn("_r", r)
             .select(*requests.columns, F.col("_r").alias("r"),
                     pick_choice("choices", F.col("_r")).alias("drawn")))


def pick_choice(choices: str | Column, r: Column) -> Column:
    """First choice whose running total exceeds ``r`` (null if none)."""
    c = F.col(choices) if isinstance(choices, str) else choices
    return F.try_element_at(F.filter(c, lambda x: x["cum"] > r), F.lit(1))["next_ch"]


def seed_rows(df: DataFrame, key: str = "doc_id", seed: int = 12345) -> DataFrame:
    """A start character per row, chosen by hash from the character set."""
    chars = F.array(*[F.lit(c) for c in CHARSET])
    idx = T.hash_bucket(key, seed, len(CHARSET))
    return df.select(key, idx.cast("int").alias("char_id"),
                     F.try_element_at(chars, (idx + 1).cast("int")).alias("seed_ch"))


def sample_seeds(seeds: DataFrame, samples: int, key: str = "doc_id") -> DataFrame:
    """Each seed ``samples`` times, with ``sample`` 0, 1 ... beside it."""
    return seeds.withColumn("sample", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))))


def generate(seeds: DataFrame, transitions: DataFrame, steps: int = GEN_STEPS,
             seed: int = 12345, key: str | Column = "doc_id", start: str = "seed_ch") -> DataFrame:
    """Extend each seed text by ``steps`` characters (order-1 Markov chain);
    ``seeds`` with a column ``generated``.

    Step ``i`` draws ``md5('<seed>:<key>:<i>')`` modulo the total of the current
    character and takes the first next character whose running count exceeds
    it.  The text may be of any length: it goes on from its last character, and
    stops early at a character with no recorded successor.

    ``transitions`` must be over the fixed character set, else the job fails: their
    running totals, at most 77 x 77 rows whatever the data, go to the tasks.  There
    all rows of a batch take each step together.  A null text stays null, a null
    key is an empty one.
    """
    chars = F.array(*[F.lit(c) for c in CHARSET])
    known = transitions.where(F.assert_true(
        F.array_contains(chars, F.col("ch")) & F.array_contains(chars, F.col("next_ch")),
        F.lit("transitions must be over the character set")).isNull())
    place = {c: i for i, c in enumerate(CHARSET)}
    cums: list[list[tuple[int, int]]] = [[] for _ in CHARSET]
    for r in cumulate(known).collect():
        cums[place[r.ch]].append((r.cum, place[r.next_ch]))
    cums = [sorted(c) for c in cums]
    # The contexts' running totals one behind the other, as one.
    total = np.array([c[-1][0] if c else 0 for c in cums], np.int64)
    before = np.cumsum(total) - total
    ends = np.array([before[i] + cum for i, c in enumerate(cums) for cum, _ in c], np.int64)
    choice = np.array([n for c in cums for _, n in c], np.int64)
    letters = np.frombuffer("".join(CHARSET).encode("ascii"), np.uint8)
    at = seeds.columns.index(start)
    suffix = [str(i + 1).encode() for i in range(steps)]

    def extended(keys: list[str], texts: list[str | None]) -> list[str | None]:
        last = np.array([place.get(t[-1], -1) if t else -1 for t in texts], np.int64)
        grown = np.full((len(texts), steps), -1, np.int64)
        on = np.flatnonzero((last >= 0) & (total[last] > 0))
        last = last[on]
        raw = b"".join([hashlib.md5(b"%d:%s:%s" % (seed, k, i)).digest()[:4]
                        for k in [keys[i].encode() for i in on.tolist()] for i in suffix])
        drawn = np.frombuffer(raw, ">u4").reshape(len(on), steps).astype(np.int64)
        for i in range(steps):
            last = choice[np.searchsorted(ends, before[last] + drawn[:, i] % total[last], "right")]
            grown[on, i] = last
            more = total[last] > 0
            if not more.all():
                on, last, drawn = on[more], last[more], drawn[more]
        size = (grown >= 0).sum(axis=1).tolist()
        return [None if t is None else t + letters[g[:n]].tobytes().decode("ascii")
                for t, g, n in zip(texts, grown, size, strict=True)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = max(1, GENERATED // max(1, steps))
        for batch in batches:
            for begin in range(0, len(batch), rows):
                part = batch.slice(begin, rows)
                found = extended(part.column(len(part.columns) - 1).to_pylist(), part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found, pa.string())],
                                                 names=[*part.schema.names[:-1], "generated"])

    of = F.col(key) if isinstance(key, str) else key
    asked = seeds.withColumn("_key", F.coalesce(of.cast("string"), F.lit("")))
    return asked.mapInArrow(run, ST.StructType([*seeds.schema.fields, ST.StructField("generated", ST.StringType())]))
