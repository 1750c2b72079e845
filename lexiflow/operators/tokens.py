"""Tokenising and word-level projections (P01-P08, W04; P20 is in ``dictionary``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..conf import TextConf
from ..functions import text as T
from .dictionary import match_dictionary  # noqa: F401


def with_tokens(df: DataFrame, text: str = "text", out: str = "tokens",
                normalize: bool = True) -> DataFrame:
    """P01+P02 in array form: adds ``out`` (array<string>) next to the row."""
    return df.withColumn(out, T.tokens_of(text, normalize))


def with_words(df: DataFrame, conf: TextConf = TextConf(), text: str = "text", out: str = "words") -> DataFrame:
    """The array of words that the settings ask for.

    N-grams are a projection of their own, so that the tokens are not computed
    anew for each of them; explode the array with an ``_outer`` generator, since
    for the others Spark infers a filter that would compute it again.
    """
    df = df.withColumn(out, T.kept_tokens(text, conf))
    return df if conf.ngram <= 1 else df.withColumn(out, T.word_ngrams(out, conf.ngram))


def tokenize(df: DataFrame, text: str = "text", key: str = "doc_id",
             normalize: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Long form ``(key, pos int, word)``.

    The array is filtered before it is exploded so positions are dense.  It is exploded
    in the outer form: for the other, Spark infers a filter that computes it again.
    """
    toks = df.select(key, *keep, T.tokens_of(text, normalize).alias("_toks"))
    return (toks.select(key, *keep, F.posexplode_outer("_toks").alias("pos", "word")).where("word is not null")
                .withColumn("pos", F.col("pos").cast("int")))


def split_label(df: DataFrame, classes: Sequence[str], line: str = "line",
                key: str = "doc_id", normalize_text: bool = False) -> tuple[DataFrame, DataFrame]:
    """``<label> <word> <word> ...`` lines -> labelled rows + rejects.

    Returns ``(labelled, rejected)``: ``labelled`` is ``(key, label, label_id,
    text)``; ``rejected`` is ``(key, reason)`` with reason ``empty`` (no token),
    ``label_only`` (no text after the label) or ``unknown_label``.
    """
    words = T.split_words(line)
    parts = df.select(
        key,
        F.try_element_at(words, F.lit(1)).alias("label"),
        F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))).alias("rest"),
        F.size(words).alias("n"))
    parts = parts.withColumn("label_id", T.label_id("label", classes))
    reason = (F.when(F.col("n") == 0, F.lit("empty"))
               .when(F.col("label_id") < 0, F.lit("unknown_label"))
               .when(F.col("n") == 1, F.lit("label_only")))
    parts = parts.withColumn("reason", reason)
    rest = T.clean_words("rest") if normalize_text else F.col("rest")
    labelled = (parts.where(F.col("reason").isNull())
                     .select(key, "label", "label_id", T.join_words(rest).alias("text")))
    rejected = parts.where(F.col("reason").isNotNull()).select(key, "reason")
    return labelled, rejected


def remove_stop_words(tokens: DataFrame, stop: Sequence[str] | DataFrame,
                      word: str = "word") -> DataFrame:
    """P06 on long-form tokens: literal list -> filter; table -> left-anti join."""
    if isinstance(stop, DataFrame):
        return tokens.join(stop.select(F.col(stop.columns[0]).alias(word)), word, "left_anti")
    if not stop:
        return tokens
    return tokens.where(~F.col(word).isin(list(stop)))


def ngrams(df: DataFrame, n: int, tokens: str = "tokens", key: str = "doc_id") -> DataFrame:
    """``(key, pos, ngram)`` from a token-array column."""
    return (df.select(key, F.posexplode(T.word_ngrams(tokens, n)).alias("pos", "ngram"))
              .withColumn("pos", F.col("pos").cast("int")))


def join_tokens(df: DataFrame, tokens: str = "tokens", out: str = "joined") -> DataFrame:
    """Tokens joined with one blank."""
    return df.withColumn(out, T.join_words(tokens))
