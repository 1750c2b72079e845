"""Helpers shared by the training-data operators: tables, row batches, bucket blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage

__all__ = ["blocks_of_hot_keys", "bounded_sample", "by_bytes", "cut_lineage", "map_texts", "numbered", "small_batches", "table"]

# Rows of one Arrow batch and bytes of text that a task works on at a time.  A
# single longer text is still taken whole, by itself.
BATCH_ROWS = 512
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with columns named by their places, so that no name of its own meets
    an operator's; ``toDF`` gives the names back."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by rows, unless the session already says how many."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


def by_bytes(batch: pa.RecordBatch, column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` whose texts together stay near ``limit`` bytes."""
    start = size = 0
    sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
    for i, n in enumerate(sizes):
        if i > start and size + n > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if len(sizes) > start:
        yield batch.slice(start)


def regrouped(batches: Iterable[pa.RecordBatch], column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches joined, then cut by ``by_bytes``, to at most about ``limit`` bytes of text."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= limit:
            yield from by_bytes(pa.concat_batches(held), column, limit)
            held, size = [], 0
    if held:
        yield from by_bytes(pa.concat_batches(held), column, limit)


def map_texts(df: DataFrame, keep: Sequence[str], text: str, schema: str,
              make: Callable[[pa.Array], dict[str, object]]) -> DataFrame:
    """``make(texts)`` on bounded batches of a text column (null: empty).

    ``keep`` columns are passed through; ``make`` returns the new columns as
    Arrow arrays, numpy arrays or lists, one value a row, named as in ``schema``,
    which lists the kept columns first.
    """
    small_batches(df.sparkSession)
    names = [*keep, "__text"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in regrouped(batches, "__text"):
            new = make(pa.compute.fill_null(part.column("__text"), ""))
            cols = [part.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                cols + [v if isinstance(v, pa.Array) else pa.array(v) for v in new.values()],
                names=[*keep, *new])

    rows = df.select(*[F.col(f"`{k}`") for k in keep],
                     F.col(f"`{text}`").cast("string").alias("__text")).toDF(*names)
    return rows.mapInArrow(run, schema)


def bounded_sample(df: DataFrame, rows: int, *by: str) -> DataFrame:
    """At most ``rows`` rows, the same however the table is dealt: all if there
    are no more, else those whose hash of the columns ``by`` is below a share of
    its range, six standard deviations short of ``rows`` in the mean.  No task
    sees more than the sample."""
    total = df.count()
    share = 1.0 if total <= rows else max(1.0, rows - 6 * rows**0.5) / total
    low = F.pmod(F.xxhash64(*by), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))
    return df.where(low).limit(rows)


def blocks_of_hot_keys(rows: DataFrame, keys: Sequence[str], spread: str, size: int) -> DataFrame:
    """Split the rows of frequent keys into pairs of blocks of about ``size`` rows.

    Rows with ``keys`` in common are to be compared with each other.  A key of
    n > ``size`` rows is cut into ceil(n/size) blocks by a hash of ``spread``;
    the result has columns ``bi`` <= ``bj`` and, once for each pair of blocks
    that a row takes part in, the row with ``own`` (its block).  So any two
    rows of a key meet in exactly one (keys, bi, bj), except that two rows of
    one block also meet where that block is paired with another: compare rows
    of equal ``own`` only where ``bi = bj``.  Keys of one row are dropped.
    """
    n = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    nb = F.ceil(F.col("__n") / F.lit(size)).cast("int")
    own = F.pmod(F.xxhash64(spread), F.col("__nb")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("__nb") - 1))
    return (rows.join(n, list(keys))
            .withColumn("__nb", nb).withColumn("own", own).withColumn("__o", other)
            .withColumn("bi", F.least("own", "__o")).withColumn("bj", F.greatest("own", "__o"))
            .drop("__n", "__nb", "__o"))
