"""Exact top-k search by columnar branch-and-bound.

Vectors are held in vertical layout, a row for each dimension.  For a query,
scores are summed up block of dimensions by block; what the remaining
dimensions can still add is bounded by the product of the remaining masses
(Cauchy-Schwarz), candidates that cannot reach the k-th best any more go, and
the survivors are compacted.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage

# Rows of a block of queries and of a block of candidates.
QUERIES, CANDIDATES, STEP = 1024, 8192, 8


class Vertical:
    """Candidates (rows of ``x``) in vertical layout, with remaining masses."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, step: int = STEP):
        # Dimensions of most mass first: partial sums then say most.
        self.order = np.argsort(-(x.astype(np.float64) ** 2).sum(0), kind="stable")
        self.ids, self.step = ids, step
        self.columns = np.ascontiguousarray(x[:, self.order].T)
        mass = self.columns.astype(np.float64) ** 2
        tail = np.cumsum(mass[::-1], 0)[::-1]
        self.rest = [np.sqrt(tail[d]) for d in range(0, len(mass), step)] + [np.zeros(len(ids))]

    def top(self, query: np.ndarray, k: int, skip: int | None) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, scores)`` of the k best, ties to smaller ids, without ``skip``."""
        q = query[self.order]
        mass = np.cumsum((q.astype(np.float64) ** 2)[::-1])[::-1]
        alive = np.arange(len(self.ids)) if skip is None else np.flatnonzero(self.ids != skip)
        part = np.zeros(len(alive), self.columns.dtype)
        for i, d in enumerate(range(0, len(q), self.step)):
            block = self.columns[d:d + self.step]
            part = part + q[d:d + self.step] @ (block if len(alive) == block.shape[1] else block[:, alive])
            if d + self.step < len(q) and len(alive) > k:
                slack = self.rest[i + 1][alive] * np.sqrt(mass[d + self.step])
                slack = slack * (1 + 1e-9) + np.abs(part) * 1e-9         # rounding never prunes
                floor = np.partition(part - slack, len(alive) - k)[len(alive) - k]
                stay = part + slack >= floor
                alive, part = alive[stay], part[stay]
        best = np.lexsort((self.ids[alive], -part))[:k]
        return self.ids[alive[best]], part[best]


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding",
          queries_block: int = QUERIES, candidates_block: int = CANDIDATES) -> DataFrame:
    """``(query_id, rank, key, score)``: the k candidates of largest inner product.

    A candidate with the query's own key is not its answer; ties go to smaller
    keys.  Both vectors must have the same dimension to meet.  Integer vectors
    give exact long scores as long as these fit into a long; others doubles.
    Rows whose key is null, or whose vector is null, empty or holds null or
    non-finite components, take no part.  A candidate repeated whole is an answer
    as often as it is there; a query repeated whole is asked once; different
    vectors of one key are queries (and candidates) of their own, so such a query
    has its ranks more than once.  A query without candidates has no rows; empty
    tables give an empty result; further columns are not read.

    Every block of queries meets every block of candidates in one task, which
    keeps at most k rows a query; both numbers of blocks grow with the tables.
    """
    kind = candidates.schema[vector].dataType.elementType.simpleString()
    whole = kind in ("tinyint", "smallint", "int", "bigint")
    cast = "array<bigint>" if whole else "array<double>"

    def usable(df: DataFrame) -> DataFrame:
        out = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast(cast).alias("v"))
        fine = (lambda x: x.isNotNull()) if whole else (
            lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return out.where(F.col("id").isNotNull() & (F.size("v") > 0) & F.forall("v", fine))

    # No more than k copies of a candidate can be among the best.
    copies = F.explode(F.sequence(F.lit(1), F.least(F.col("n"), F.lit(k)))).alias("copy")
    c = usable(candidates).groupBy("id", "v").agg(F.count(F.lit(1)).alias("n")).select("id", "v", copies)
    q, c = cut_lineage(usable(queries).distinct()), cut_lineage(c)
    nq, nc = (max(1, -(-df.count() // size)) for df, size in ((q, queries_block), (c, candidates_block)))
    block = lambda n: F.pmod(F.xxhash64("id", "v"), F.lit(n)).cast("int")
    # The blocks' numbers are few; each side is copied to the other's blocks.
    q = (q.withColumn("uid", F.xxhash64("v")).withColumn("qb", block(nq))
         .withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(nc - 1)))))
    c = c.withColumn("cb", F.pmod(F.xxhash64("id", "v", "copy"), F.lit(nc)).cast("int")).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))))
    score = "bigint" if whole else "double"
    dtype = np.int64 if whole else np.float64

    def matrix(column) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        size = column.map(len).to_numpy()
        return {d: (at := np.flatnonzero(size == d), np.stack([np.asarray(column.iloc[i], dtype) for i in at]))
                for d in np.unique(size).tolist()}

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        if len(left) and len(right):
            theirs = matrix(right["v"])
            for dim, (at, x) in matrix(left["v"]).items():
                if dim not in theirs:
                    continue
                rows, y = theirs[dim]
                if whole and float(np.abs(x).max()) * float(np.abs(y).max()) * dim < 2.0**52:
                    x, y = x.astype(np.float64), y.astype(np.float64)     # sums stay exact, and are fast
                found = Vertical(right["id"].to_numpy()[rows], y)
                for i, query in zip(at.tolist(), x, strict=True):
                    me = left.iloc[i]
                    ids, scores = found.top(query, k, me["id"])
                    out.append(pd.DataFrame({"query_id": me["id"], "uid": me["uid"], "id": ids,
                                             "score": scores.astype(dtype)}))
        names = ["query_id", "uid", "id", "score"]
        return pd.concat(out) if out else pd.DataFrame({n: pd.Series(dtype=dtype if n == "score" else np.int64) for n in names})

    near = q.select("qb", "cb", "id", "uid", "v").groupBy("qb", "cb").cogroup(
        c.select("qb", "cb", "id", "v").groupBy("qb", "cb")).applyInPandas(
        meet, f"query_id bigint, uid bigint, id bigint, score {score}")
    order = Window.partitionBy("query_id", "uid").orderBy(F.desc("score"), "id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(key), "score")
