"""The quality classifier: held-out accuracy, whole texts, and odd rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import functions as F

from lexiflow.llm import quality
from tests.conftest import SF01

from .conftest import EDGE


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.score(docs, quality.train(docs, labels)).collect()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    right = sum(r.predicted == truth[r.doc_id] for r in held)
    assert len(held) > 80 and right / len(held) >= 0.97


def test_held_out_labels_teach_nothing(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert (quality.train(docs, labels) == quality.train(docs, turned)).all()
    # the sample does not depend on how the tables are dealt
    assert (quality.train(docs.repartition(7), labels.repartition(3), rows=100) == quality.train(docs, labels, rows=100)).all()


def test_ngrams_of_a_text_do_not_reach_into_the_next():
    texts = ["a b c", "", "a", "x | y\n\n z!", "a b c"]
    grams, counts = quality.ngrams(pa.array(texts))
    parts = [sorted(x.tolist()) for x in np.split(grams, np.cumsum(counts)[:-1])]
    assert counts.tolist() == [6, 0, 1, 12, 6] and parts[0] == parts[4]
    for text, part in zip(texts, parts, strict=True):
        alone, _ = quality.ngrams(pa.array([text]))
        assert sorted(alone.tolist()) == part


def test_the_end_of_a_long_text_counts():
    w = np.zeros(quality.SLOTS + 1)
    grams, _ = quality.ngrams(pa.array(["needle"]))
    w[grams] = 1.0
    found, _ = quality.ngrams(pa.array(["hay " * 50_000 + "needle"]))
    assert (w[found] > 0).any()


def test_ftrl_learns_sparse_weights():
    rng = np.random.default_rng(0)
    rows = []
    for _ in range(600):
        y = int(rng.integers(0, 2))
        at = np.unique(np.append(rng.integers(10, 500, 8), y))       # slot 0 or 1 tells the label
        rows.append((y, at, np.ones(len(at))))
    w = quality.ftrl(rows, slots=512)
    assert w[1] > 0.5 and w[0] < -0.5 and np.abs(w[10:500]).max() < min(w[1], -w[0])


def test_edge_rows(spark, edge, nothing):
    labels = spark.createDataFrame(
        [(i, i % 2, "x") for i in range(1, 8)] + [(3, 0, "x"), (None, 1, "x"), (5, None, "x"), (6, 9, "x")],
        "doc_id long, quality int, text string")
    w = quality.train(edge, labels)
    rows = quality.score(edge, w).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in EDGE)
    bias = {r.score for r in rows if r.doc_id in (1, 2, 3)}
    assert len(bias) == 1 and abs(bias.pop() - quality.sigmoid(w[-1])) < 1e-12
    assert all(not r.held_out for r in rows if r.doc_id is None)
    kept = quality.accept(edge, w)
    assert kept.columns == edge.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in rows if r.predicted)
    none = quality.train(edge, labels.where("1 = 0"))
    assert not none.any() and {r.score for r in quality.score(edge, none).collect()} == {0.5}
    assert quality.score(nothing, w).count() == 0


def _plain_grams(text, slots):
    """Slots of a text's words, pairs and shapes of three, by loops."""
    words = regex.findall(r"[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\s]+", text)
    mult, full = 0x9E3779B1, (1 << 32) - 1
    code = [zlib.crc32(w.encode()) for w in words]
    shape = [quality._shape(w) + (5000 if i and words[i - 1] == w else 0) for i, w in enumerate(words)]
    out = [c * mult for c in code]
    out += [((a * mult & full) ^ (b + 1 & full)) * mult for a, b in zip(code, code[1:])]  # noqa: B905
    out += [((a * mult + b) * mult + c + 2) * mult for a, b, c in zip(shape, shape[1:], shape[2:])]  # noqa: B905
    return Counter((x & full) >> (33 - slots.bit_length()) for x in out)


def _plain_ftrl(rows, epochs=4, alpha=0.3, beta=1.0, l1=0.02, l2=0.1):
    """Follow-the-regularised-leader one coordinate at a time; rows of (label, {slot: value})."""
    z, n = Counter(), Counter()

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(epochs):
        for label, values in rows:
            w = {i: weight(i) for i in values}
            p = 1 / (1 + math.exp(-sum(w[i] * x for i, x in values.items())))
            for i, x in values.items():
                g = (p - label) * x
                step = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha
                z[i] += g - step * w[i]
                n[i] += g * g
    return {i: weight(i) for i in z}


def test_weights_and_scores_equal_a_plain_version(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    docs, slots = docs.where("length(text) < 1500 and doc_id < 300"), quality.SLOTS
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    ids = [i for i in texts if truth.get(i) in (0, 1) and zlib.crc32(str(i).encode()) % 3 != 1]
    order = {r.doc_id: r.h for r in docs.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    rows = []
    for i in sorted(ids, key=order.get):
        grams = _plain_grams(texts[i], slots)
        total = max(1, sum(grams.values()))
        rows.append((truth[i], {**{s: float(np.float32(c * (quality.SCALE / total))) for s, c in grams.items()}, slots: 1.0}))
    want = _plain_ftrl(rows)
    w = quality.train(docs, labels)
    assert len(rows) > 10 and set(np.flatnonzero(w)) == {i for i, x in want.items() if x}
    assert max(abs(w[i] - x) for i, x in want.items()) < 1e-9
    for r in quality.score(docs, w).collect():
        grams = _plain_grams(texts[r.doc_id], slots)
        mean = sum(w[s] * c for s, c in grams.items()) / max(1, sum(grams.values()))
        assert abs(r.score - 1 / (1 + math.exp(-(mean * quality.SCALE + w[slots])))) < 1e-9


def test_a_repeated_key_teaches_once(spark):
    docs = spark.createDataFrame([(0, "good words here"), (2, "bad ! ! !")], "doc_id long, text string")
    more = docs.union(spark.range(500).selectExpr("0L as doc_id", "'good words here' as text"))
    labels = spark.createDataFrame([(0, 1), (2, 0)], "doc_id long, quality int")
    once, often = quality.train(docs, labels), quality.train(more, labels)
    assert once.any() and (once == often).all()
