"""Scoring, reduction over steps, argmax and evaluation.

J05, J06, A06-A08, W02, W05, T05.

Per-class scores travel as one array column of K doubles (K is the length of
the class list, a plan-time literal), so a document needs a single
``groupBy(doc_id)`` and the argmax is a narrow projection.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from ..functions import text as T
from .blocks import block_words, counted_blocks, counted_means, in_blocks, lists_of, with_looked

DIGITS = 6   # scores are rounded before ranking or comparing


def attach_labels(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents joined with their label rows."""
    return docs.join(labels, key)


def _score_array(k: int) -> Column:
    """Counted-model score of each class: (n_c + 1) / (n_word + K)."""
    n_word = F.coalesce(F.col("n_word"), F.lit(0))
    return F.array(*[
        ((F.coalesce(F.col("n")[c], F.lit(0)) + 1) / (n_word + k)).cast("double")
        for c in range(k)])


def step_scores(tokens: DataFrame, model: DataFrame, num_classes: int,
                word: str = "word") -> DataFrame:
    """Per row, the K class scores of its word (uniform 1/K for unseen words)."""
    m = model.select(F.col("word").alias(word), "n_word", "n")
    return (tokens.join(m, word, "left")
                  .withColumn("scores", _score_array(num_classes))
                  .drop("n_word", "n"))


def reduce_steps(steps: DataFrame, num_classes: int, keys: Sequence[str], reduction: str = "mean",
                 times: str | None = None, copies: str | None = None) -> DataFrame:
    """Per document, one score per class -> ``keys + [scores]``.

    ``mean`` averages the steps, each counted ``times`` times (a column; once
    if not given); ``last_step`` keeps the step with the largest position (the
    one that carries the label in training).  With ``copies`` the sum of that
    column is kept beside the mean; documents without a step have none.
    """
    if reduction == "mean":
        n = F.col(times) if times else F.lit(1)
        sums = [F.sum(F.col("scores")[c] * n) for c in range(num_classes)]
        agg = steps.groupBy(*keys).agg(F.sum(n).alias("_n"), *[
            s.alias(f"_s{c}") for c, s in enumerate(sums)], *([F.sum(copies).alias(copies)] if copies else []))
        agg = agg.where("_n > 0") if copies else agg
        means = F.array(*[F.round(F.col(f"_s{c}") / F.col("_n"), DIGITS)
                          for c in range(num_classes)])
        return agg.select(*keys, means.alias("scores"), *([copies] if copies else []))
    if reduction == "last_step":
        agg = steps.groupBy(*keys).agg(F.max_by("scores", "pos").alias("_last"))
        return agg.select(*keys, F.transform("_last", lambda x: F.round(x, DIGITS)).alias("scores"))
    raise ValueError(f"unknown reduction {reduction!r}")


def mean_scores(reduced: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """A06 long form: ``keys + (class_id int, mean_score double)``."""
    return (reduced.select(*keys, F.posexplode("scores").alias("class_id", "mean_score"))
                   .withColumn("class_id", F.col("class_id").cast("int")))


def argmax_class(scores: str | Column) -> Column:
    """struct(class_id, score) of the best class, ties to the lowest id."""
    s = F.col(scores) if isinstance(scores, str) else scores
    best = F.array_max(F.transform(s, lambda x, i: F.struct(x.alias("score"), (-i).alias("neg_id"))))
    return F.struct((-best["neg_id"]).cast("int").alias("class_id"), best["score"].alias("score"))


def predict(reduced: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keys + (class_id, mean_score)`` of the winning class; narrow."""
    best = argmax_class("scores")
    return reduced.select(*keys, best["class_id"].alias("class_id"),
                          best["score"].alias("mean_score"))


def reduced_scores(docs: DataFrame, model: DataFrame, num_classes: int, key: str = "doc_id",
                   keep: Sequence[str] = ("label_id",), words: str | Column = "words",
                   reduction: str = "mean", at: str | None = None) -> DataFrame:
    """J06 + A06/W05 of an array of words: ``key + keep + [scores]``.

    One result a row, whatever its key.  For the mean, documents are looked up in
    blocks (``blocks.in_blocks``, written to ``at``), so the lookup sees one row per
    distinct word of a block; for the last step it sees one row per document.  Rows
    without a word have no result (see ``examples.rejects``).
    """
    keys = [key, *keep]
    words = F.col(words) if isinstance(words, str) else words
    if reduction == "last_step":
        steps = docs.select(*keys, F.size(words).alias("_n"), words.alias("_t")).where("_n > 0")
        steps = step_scores(steps.select(*keys, F.try_element_at("_t", F.lit(-1)).alias("word")), model, num_classes)
        return steps.select(*keys, F.transform("scores", lambda x: F.round(x, DIGITS)).alias("scores"))
    if reduction != "mean":
        raise ValueError(f"unknown reduction {reduction!r}")
    rows = in_blocks(docs.select(*keys, F.array_compact(words).alias("_w")), "_w", at)
    steps = step_scores(block_words(rows), model, num_classes).select("_block", "_place", "scores")

    def summed(docs, begin, ids, found, row):
        each = found.column("scores").combine_chunks().flatten().to_numpy().reshape(-1, num_classes)
        sums = np.add.reduceat(each[row[ids]], begin[:-1], axis=0)
        return [lists_of(sums.ravel(), np.arange(len(sums) + 1) * num_classes), pa.array(np.diff(begin))]

    found = with_looked(rows, steps, summed, [ST.StructField("_sums", ST.ArrayType(ST.DoubleType())), ST.StructField("_n", ST.LongType())])
    means = F.array(*[F.round(F.col("_sums")[c] / F.col("_n"), DIGITS) for c in range(num_classes)])
    return found.select(*keys, means.alias("scores"))


def score_words(docs: DataFrame, model: DataFrame, num_classes: int, key: str = "doc_id",
                keep: Sequence[str] = ("label_id",), words: str | Column = "words",
                reduction: str = "mean", classes: Sequence[str] | None = None, at: str | None = None) -> DataFrame:
    """T05 on an array of words: look up -> reduce over steps -> argmax.  With
    ``classes`` the winning class's label is added (P05)."""
    found = predict(reduced_scores(docs, model, num_classes, key, keep, words, reduction, at), [key, *keep])
    return found if classes is None else found.withColumn("label", T.id_label("class_id", classes))


def score(docs: DataFrame, model: DataFrame, num_classes: int, key: str = "doc_id",
          keep: Sequence[str] = ("label_id",), text: str = "text", normalize: bool = True,
          reduction: str = "mean", classes: Sequence[str] | None = None, at: str | None = None) -> DataFrame:
    """Every token of every text, as ``score_words``."""
    return score_words(docs, model, num_classes, key, keep, T.tokens_of(text, normalize), reduction, classes, at)


def accuracy(predictions: DataFrame, label: str = "label_id", pred: str = "class_id") -> DataFrame:
    """One row ``(n_test, n_correct, accuracy)``."""
    correct = (F.col(label) == F.col(pred)).cast("long")
    agg = predictions.agg(F.count(F.lit(1)).alias("n_test"), F.sum(correct).alias("n_correct"))
    return agg.select("n_test", F.coalesce("n_correct", F.lit(0)).cast("long").alias("n_correct"),
                      F.round(F.col("n_correct") / F.col("n_test"), DIGITS).alias("accuracy"))


def confusion(predictions: DataFrame, label: str = "label_id", pred: str = "class_id") -> DataFrame:
    """Long-form confusion counts ``(label_id, pred_id, n)``."""
    return (predictions.groupBy(F.col(label).alias("label_id"), F.col(pred).alias("pred_id"))
                       .agg(F.count(F.lit(1)).alias("n")))


def segment_words(segmented: DataFrame, segments: str = "segments", out: str = "words") -> DataFrame:
    """The chosen dictionary words of ``dictionary.segment``'s rows, for ``score_words``."""
    chosen = F.filter(segments, lambda s: s["known"] & ~s["inner"])
    return segmented.withColumn(out, F.transform(chosen, lambda s: s["word"]))


def score_segments(matches: DataFrame, model: DataFrame, num_classes: int,
                   key: str = "doc_id", reduction: str = "mean",
                   classes: Sequence[str] | None = None) -> DataFrame:
    """T05 for unspaced text: the dictionary matches of P20 ``(key, start,
    word)`` are the steps (in start order; of matches that start together, the
    longest is the last), then J06 -> A06 -> W02 (-> P05) as for blank-separated
    text.  Texts without any match get no prediction.  For the mean, counts of
    matches ``(key, word, n_here)`` (``dictionary.count_matches``) serve as well, and
    they are looked up in blocks: what is shuffled are a block's words and numbers."""
    if reduction == "mean":
        rows = counted_blocks(matches, key, "word", "n_here" if "n_here" in matches.columns else None)
        steps = step_scores(block_words(rows), model, num_classes)
        means = counted_means(rows, steps, key, "scores", [1 / num_classes] * num_classes)
        reduced = reduce_steps(means, num_classes, [key], reduction, "_n")
    else:
        steps = matches.select(key, F.struct("start", F.length("word").alias("n")).alias("pos"), "word")
        reduced = reduce_steps(step_scores(steps, model, num_classes), num_classes, [key], reduction)
    found = predict(reduced, [key])
    return found if classes is None else found.withColumn("label", T.id_label("class_id", classes))
