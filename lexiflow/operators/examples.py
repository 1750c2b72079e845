"""Training examples: encode, pad, mask, label step, tensor cells.

P09-P14, A05.  One ``examples`` row per document:

    doc_id, n_tokens int, truncated boolean, features array<long>,
    feature_mask array<int>, known array<int>, label_id int, label_step int

Tokens are cut to the first ``seq_len`` positions inside the row before they are
looked up in blocks of documents, so only ``seq_len`` numbers per document are
ever moved, whatever the document length.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from ..conf import SEQ_LEN, TextConf
from ..functions import text as T
from . import tokens as TK
from . import vocab as V
from .blocks import block_words, in_blocks, lists_of, with_looked


def gather(looked: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Per document, the ``fields`` of its tokens in ``pos`` order.

    ``collect_list`` order is not trusted; the structs are sorted on ``pos``.
    """
    seq = F.sort_array(F.collect_list(F.struct("pos", *fields)))
    return looked.groupBy(*keys).agg(seq.alias("_seq"))


def encode(tokens: DataFrame, vocab: DataFrame, keys: Sequence[str] = ("doc_id",),
           unknown_id: int = 0) -> DataFrame:
    """P09 (+J02): ``keys + (ids array<long>, known array<int>)`` in token order."""
    looked = V.lookup_or_default(tokens, vocab, unknown_id)
    g = gather(looked, keys, ("idx", "known"))
    return g.select(*keys,
                    F.transform("_seq", lambda x: x["idx"]).alias("ids"),
                    F.transform("_seq", lambda x: x["known"]).alias("known"))


def build_vocab(docs: DataFrame, conf: TextConf = TextConf(), text: str = "text") -> DataFrame:
    """W01 over the words that ``conf`` asks for, from its minimum count on."""
    words = TK.with_words(docs, conf, text, "_words").select(F.explode_outer("_words").alias("word"))
    return V.build_vocab(words.where("word is not null"), conf.min_count)


def build_examples(docs: DataFrame, vocab: DataFrame, conf: TextConf = TextConf(),
                   key: str = "doc_id", label: str | None = "label_id", text: str = "text") -> DataFrame:
    """P01/P02 -> J02 -> A05 -> P09-P12 in one select after one lookup by blocks.

    ``n_tokens`` counts the words before unknown ones are dropped (which they
    are with ``conf.use_unknown`` off).  Documents without a word, or whose first
    ``conf.seq_len`` words are all unknown and dropped, produce no example (see
    ``rejects``).  One example a row, whatever its key.
    """
    seq_len, unknown_id = conf.seq_len, conf.unknown_id
    # Token array and its size are computed once per document, in a projection of their own.
    lab = [F.col(label)] if label else []
    arr = TK.with_words(docs, conf, text, "_toks").select(F.col(key).alias("_key"), *lab, "_toks")
    arr = arr.select("_key", *lab, F.size("_toks").cast("int").alias("n_tokens"), F.slice("_toks", 1, seq_len).alias("_head"))
    rows = in_blocks(arr, "_head")
    looked = V.lookup_or_default(block_words(rows), vocab, unknown_id).select("_block", "_place", "idx", "known")

    def encoded(docs, begin, ids, found, row):
        idx, known = (found.column(c).to_numpy()[row[ids]] for c in ("idx", "known"))
        if not conf.use_unknown:
            begin = np.append(0, np.cumsum(known, dtype=np.int64))[begin]
            idx, known = idx[known > 0], known[known > 0]
        return [lists_of(idx, begin), lists_of(known, begin)]

    enc = with_looked(rows, looked, encoded, [ST.StructField("ids", ST.ArrayType(ST.LongType())),
                                              ST.StructField("known", ST.ArrayType(ST.IntegerType()))])
    if not conf.use_unknown:
        enc = enc.where(F.size("ids") > 0)
    n = F.col("n_tokens") if conf.use_unknown else F.size("ids")
    return enc.select(
        F.col("_key").alias(key), F.col("n_tokens"), (F.col("n_tokens") > seq_len).alias("truncated"),
        T.pad_ids("ids", seq_len, unknown_id).alias("features"),
        T.step_mask(n, seq_len).alias("feature_mask"),
        F.concat(F.col("known"), F.array_repeat(F.lit(0), F.lit(seq_len) - F.size("known"))).alias("known"),
        *([F.col(label)] if label else []),
        T.last_step(n, seq_len).alias("label_step"))


def rejects(docs: DataFrame, classes: Sequence[str] | None = None, key: str = "doc_id",
            label: str = "label", text: str = "text", normalize: bool = True) -> DataFrame:
    """Rows that cannot become examples: ``(key, reason)``.

    ``empty`` when no token survives tokenising (a null text has none);
    ``unknown_label`` when the label is null or not in ``classes``.
    """
    n = F.coalesce(F.size(T.tokens_of(text, normalize)), F.lit(0))
    reason = F.when(n <= 0, F.lit("empty"))
    if classes is not None:
        reason = reason.when(F.coalesce(T.label_id(label, classes), F.lit(-1)) < 0, F.lit("unknown_label"))
    return docs.select(key, reason.alias("reason")).where(F.col("reason").isNotNull())


def to_cells(examples: DataFrame, key: str = "doc_id", label: str = "label_id") -> DataFrame:
    """The four tensors of an example as sparse cells, zeros omitted.

    ``(doc_id, tensor, i, j, value)`` with tensors ``features`` (0, step, id),
    ``feature_mask`` (0, step, 1), ``labels`` (class, label step, 1) and
    ``label_mask`` (0, label step, 1).  Steps come from a native ``posexplode``
    of the feature array (each step yields its feature and mask cell, zeros
    dropped by a filter); the first step yields the two label cells too.
    """
    def cell(t, i, j, v):
        return F.struct(F.lit(t).alias("tensor"), F.lit(i).cast("int").alias("i") if isinstance(i, int)
                        else i.cast("int").alias("i"), j.cast("int").alias("j"),
                        v.cast("double").alias("value"))

    j, step, none = F.col("_j"), F.col("label_step"), F.lit(0.0)
    steps = examples.select(key, F.col(label).alias("_label"), "label_step",
                            F.posexplode_outer(F.arrays_zip("features", "feature_mask")).alias("_j", "_s"))
    once = F.when(F.coalesce(j, F.lit(0)) == 0, F.lit(1.0)).otherwise(none)
    return steps.select(key, F.inline(F.array(
        cell("features", 0, j, F.col("_s.features")), cell("feature_mask", 0, j, F.col("_s.feature_mask")),
        cell("labels", F.col("_label"), step, once), cell("label_mask", 0, step, once)))).where(F.col("value") != 0)


# ------------------------------------------------------- dense tensors (P13) ---

TENSORS = ("features", "labels", "feature_mask", "label_mask")


def to_tensors(examples: DataFrame, num_classes: int, key: str = "doc_id", label: str = "label_id",
               seq_len: int = SEQ_LEN) -> DataFrame:
    """An example's four tensors as dense ``array<array<double>>``.

    ``features`` (1 x steps) ids, ``labels`` (classes x steps) with a one for the
    class at the last step, ``feature_mask`` (1 x steps) and ``label_mask`` (1 x
    steps) with a one at the last step.  Built inside the row: one result a row,
    no shuffle.  A label outside the classes has an empty label matrix of zeros.
    """
    steps = F.sequence(F.lit(0), F.lit(seq_len - 1))
    at = F.transform(steps, lambda i: (i == F.col("label_step")).cast("double"))
    none = F.array_repeat(F.lit(0.0), seq_len)
    labels = F.transform(F.sequence(F.lit(0), F.lit(num_classes - 1)),
                         lambda c: F.when(c == F.col(label), at).otherwise(none))
    return examples.select(key, F.array(F.col("features").cast("array<double>")).alias("features"), labels.alias("labels"),
                           F.array(F.col("feature_mask").cast("array<double>")).alias("feature_mask"),
                           F.array(at).alias("label_mask"))


def tensor_cells(tensors: DataFrame, key: str = "doc_id") -> DataFrame:
    """The way back: ``(key, tensor, i, j, value)``, zeros omitted, as ``to_cells``."""
    each = F.array(*[F.struct(F.lit(t).alias("tensor"), F.col(t).alias("rows")) for t in TENSORS])
    rows = tensors.select(key, F.inline(each)).select(key, "tensor", F.posexplode("rows").alias("i", "row"))
    cells = rows.select(key, "tensor", F.col("i").cast("int").alias("i"), F.posexplode("row").alias("j", "value"))
    return cells.select(key, "tensor", "i", F.col("j").cast("int").alias("j"), "value").where("value <> 0")


def tensors_of_cells(cells: DataFrame, num_classes: int, key: str = "doc_id", seq_len: int = SEQ_LEN) -> DataFrame:
    """Dense tensors from sparse cells, as ``to_tensors``; cells of one place are
    added up, cells outside the tensors fail the job.  Cells are grouped by the
    key, at most (2 classes + 2) x steps of them are there for one."""
    height = F.when(F.col("tensor") == "labels", F.lit(num_classes)).otherwise(F.lit(1))
    inside = F.col("tensor").isin(*TENSORS) & F.col("i").between(0, height - 1) & F.col("j").between(0, seq_len - 1)
    ok = cells.where(F.assert_true(inside, F.lit("cell outside the tensors")).isNull())
    summed = ok.groupBy(key, "tensor", "i", "j").agg(F.sum("value").alias("value"))
    # A row's cells in order, each behind the zeros since the one before.
    rows = summed.groupBy(key, "tensor", "i").agg(F.sort_array(F.collect_list(F.struct("j", "value"))).alias("c"))
    js = F.transform("c", lambda x: x["j"])
    before = F.concat(F.array(F.lit(-1)), F.slice(js, F.lit(1), F.size("c") - 1))
    zeros = lambda n: F.array_repeat(F.lit(0.0), n)
    dense = F.flatten(F.zip_with("c", before, lambda x, p: F.concat(zeros(x["j"] - p - 1), F.array(x["value"]))))
    dense = F.concat(dense, zeros(F.lit(seq_len - 1) - F.element_at(js, -1)))
    place = F.concat_ws("/", "tensor", F.col("i").cast("string"))
    found = rows.select(key, place.alias("at"), dense.alias("row")).groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct("at", "row"))).alias("_rows"))

    def tensor(t: str, height: int):
        return F.array(*[F.coalesce(F.try_element_at("_rows", F.lit(f"{t}/{i}")), zeros(seq_len)) for i in range(height)]).alias(t)

    return found.select(key, *[tensor(t, num_classes if t == "labels" else 1) for t in TENSORS])


def tensor_vectors(tensors: DataFrame, key: str = "doc_id") -> DataFrame:
    """P13 for ``pyspark.ml``: ``(key, tensor, i, vector)``, each row of each tensor as a vector."""
    from pyspark.ml.functions import array_to_vector
    each = F.array(*[F.struct(F.lit(t).alias("tensor"), F.col(t).alias("rows")) for t in TENSORS])
    rows = tensors.select(key, F.inline(each)).select(key, "tensor", F.posexplode("rows").alias("i", "row"))
    return rows.select(key, "tensor", F.col("i").cast("int").alias("i"), array_to_vector("row").alias("vector"))
