"""Embedding near-duplicates: iterative quantisation and multi-index Hamming tables.

A rotation learned on a bounded sample turns vectors into balanced 64-bit
codes.  Each of eight tables buckets the codes by one byte, so two codes that
differ in up to seven bits always meet, and mostly also those that differ in
more.  Vectors that meet are compared by their original components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .buckets import Links, compare_buckets
from .common import bounded_sample, cut_lineage, small_batches
from .components import components

# Distinct vectors that the rotation is learned on at most; rows of a bucket
# that one task compares with each other at most, twice.
SAMPLE, BLOCK = 16_384, 512
BITS = 64


def learn(x: np.ndarray, bits: int = BITS, rounds: int = 50, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """``(mean, projection)`` of unit vectors: principal directions, rotated so
    that the signs lose least.  Fewer dimensions than bits give several
    rotations side by side."""
    rng = np.random.default_rng(seed)
    mean, dim = x.mean(0), x.shape[1]
    _, _, axes = np.linalg.svd(np.cov(x - mean, rowvar=False).reshape(dim, dim) + 1e-12 * np.eye(dim))
    parts, have = [], 0
    while have < bits:
        width = min(dim, bits - have)
        base = axes[:width].T
        v = (x - mean) @ base
        turn = np.linalg.qr(rng.standard_normal((width, width)))[0]
        for _ in range(rounds):
            signs = np.where(v @ turn >= 0, 1.0, -1.0)
            u, _, w = np.linalg.svd(signs.T @ v)
            turn = (u @ w).T
        parts.append(base @ turn)
        have += width
    return mean, np.concatenate(parts, 1)


def codes(x: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    return np.packbits((x - mean) @ projection >= 0, axis=1, bitorder="little").view(np.int64).ravel()


def usable(vector: str) -> F.Column:
    """Not null or empty, without null or non-finite components, not zero."""
    c = F.col(vector)
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(c, fine) & F.exists(c, lambda x: x != 0), F.lit(False))


def near_duplicates(rows: DataFrame, threshold: float = 0.93, key: str = "vec_id", vector: str = "embedding",
                    label: str | None = "label", sample: int = SAMPLE) -> DataFrame:
    """``(key, n_links, component_id, kept)`` of each row.

    Rows of equal, non-null ``label`` and equal dimension link where their
    cosine, in double precision, is at least ``threshold``.  Equal vectors are
    one node with a count.  Rows with a null label, or with a vector that is
    null, empty, zero or holds null or non-finite components, link with
    nothing: 0 links, their own key, kept.  Repeated rows are rows each, so they
    link with each other; a null key is never a component's name unless it has
    no other.  An empty table gives an empty result; further columns are not
    read.  Links found are exact; the tables may miss links of codes that differ
    in eight bits or more.
    """
    spark = rows.sparkSession
    small_batches(spark)
    given = rows.select(F.col(f"`{key}`").alias("k"), F.col(f"`{vector}`").cast("array<double>").alias("v"),
                        (F.col(f"`{label}`") if label else F.lit(0)).alias("l"))
    given = given.withColumn("ok", usable("v") & F.col("l").isNotNull())
    nodes = cut_lineage(given.where("ok").groupBy("l", "v").agg(F.min("k").alias("low"), F.count(F.lit(1)).alias("m"))
                        .withColumn("node", F.monotonically_increasing_id()))
    drawn = bounded_sample(nodes.select("v"), sample, "v").sort("v").toPandas()["v"]
    by_dim: dict[int, list] = {}
    for v in drawn:
        by_dim.setdefault(len(v), []).append(np.asarray(v, np.float64))
    model = {}
    for dim, vs in by_dim.items():
        x = np.stack(vs)
        x /= np.abs(x).max(1, keepdims=True)
        model[dim] = learn(x / np.linalg.norm(x, axis=1, keepdims=True)) if len(x) > 1 else None

    def to_codes(batches):
        for batch in batches:
            v = batch.column("v")
            dims = pa.compute.list_value_length(v).to_numpy(zero_copy_only=False)
            code = np.zeros(len(dims), np.int64)
            raw: list[bytes] = [b""] * len(dims)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                x = v.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                x = x / np.abs(x).max(1, keepdims=True)
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                if model.get(dim) is None:           # a dimension that the sample lacks: signs of fixed directions
                    turn = np.random.default_rng(dim).standard_normal((dim, BITS))
                    code[at] = codes(x, np.zeros(dim), turn)
                else:
                    code[at] = codes(x, *model[dim])
                for i, row in zip(at.tolist(), x, strict=True):
                    raw[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("l"), batch.column("m"), pa.array(dims.astype(np.int32)),
                 pa.array(code), pa.array(raw, pa.binary())], names=["node", "l", "m", "dim", "code", "unit"])

    kind = nodes.schema["l"].dataType.simpleString()
    coded = nodes.select("node", "l", "m", "v").mapInArrow(
        to_codes, f"node bigint, l {kind}, m bigint, dim int, code bigint, unit binary")
    # Buckets of labels: a label only has to part rows, so its hash will do, and the label is compared too.
    slots = (coded.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(BITS // 8 - 1))))
             .withColumn("byte", F.expr("cast(shiftrightunsigned(code, 8 * t) & 255 as int)"))
             .withColumn("lh", F.xxhash64("l")).select("lh", "dim", "t", "byte", "node", "m", "code", "unit"))

    def compare(columns, pairs):
        n = len(columns["node"])
        links, count = Links(n), np.zeros(n, np.int64)
        code, table, m, dim = columns["code"], columns["t"], columns["m"], columns["dim"]
        flat = np.frombuffer(b"".join(columns["unit"]), np.float64)
        begin = np.cumsum(dim.astype(np.int64)) - dim
        same = len(np.unique(dim)) == 1
        x = flat.reshape(n, -1) if same else None
        for a, b in pairs():
            for i in range(0, len(a), 65_536):
                p, q = a[i:i + 65_536], b[i:i + 65_536]
                differ = (code[p] ^ code[q]).view(np.uint8).reshape(-1, 8)
                first = np.argmax(differ == 0, axis=1) == table[p]        # each pair in its first table only
                p, q = p[first], q[first]
                if same:
                    cos = np.einsum("ij,ij->i", x[p], x[q])
                else:
                    cos = np.array([flat[begin[u]:begin[u] + dim[u]] @ flat[begin[w]:begin[w] + dim[w]]
                                    for u, w in zip(p.tolist(), q.tolist(), strict=True)], np.float64)
                near = cos >= threshold
                p, q = p[near], q[near]
                np.add.at(count, p, m[q])
                np.add.at(count, q, m[p])
                links.add(p, q)
        links.fold()
        at = np.flatnonzero(count)
        node = columns["node"]
        return pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(node[links.label[at]]), pa.array(count[at])],
                                          names=["a", "b", "n"])

    found = cut_lineage(compare_buckets(slots, ["lh", "dim", "t", "byte"], "node", BLOCK,
                                        "a bigint, b bigint, n bigint", compare))
    roots = components(found.select("a", "b"))
    n = found.groupBy("a").agg(F.sum("n").alias("n"))
    named = (nodes.join(n, nodes.node == n.a, "left").join(roots.withColumnRenamed("node", "r"), F.col("node") == F.col("r"), "left")
             .select("l", "v", "low", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"),
                     F.coalesce("root", "node").alias("root")))
    low = named.groupBy("root").agg(F.min("low").alias("component_id"))
    # The small side is dealt out anew: then AQE can split the partition of a large component.
    named = named.join(low.hint("rebalance"), "root").select("l", "v", "n_links", "component_id")
    linked = given.where("ok").join(named, ["l", "v"]).select("k", "n_links", "component_id")
    alone = given.where(~F.col("ok")).select("k", F.lit(0).cast("long").alias("n_links"), F.col("k").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select(F.col("k").alias(key), "n_links", "component_id",
                      F.coalesce(F.col("k") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))
