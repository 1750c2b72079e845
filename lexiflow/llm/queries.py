"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import conversation_repair, divergence, histogram_packing, html_extract, itq, quality, simhash
from .common import table
from .line_dedup import dedup_lines
from .packing import pack, token_pieces
from .records import read_records, write_records
from .token_counts import count_tokens
from .topk import top_k
from .transducer import build_lexicon, encode


def packed(docs: DataFrame) -> DataFrame:
    """Each document's pieces of at most 2048 ids and where they are packed; the ids by their checksum."""
    pieces = token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), width=2048)
    return pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), width=2048)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"))


def op2_itq_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    # Not finite: no integer, so the row takes no part.
    part = lambda x: F.when(F.abs(x.cast("double")) < float("inf"), F.floor(x.cast("double") * 1024))
    whole = rows.select("vec_id", F.transform("embedding", part).alias("embedding"))
    return top_k(whole.where("vec_id % 100 = 0"), whole, k=10)


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, tau=4)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_quality_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op8_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = encode(docs, path, build_lexicon(docs, path), decoded=True)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op9_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "records")
    write_records(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_records(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_html_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.train(pages))


def op11_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = histogram_packing.pack(table(spark, sf_dir, "documents"), path, end_id=1, width=2048)
    return rows.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), min_docs=30, top=50)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut short, repeated or given to the user, by a checksum of where they stand."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"))
    case = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    rows = rows.withColumn("case", case.cast("int")).where(F.col("case") != 0)
    text = (F.when(F.col("case") == 1, F.lit("")).when(F.col("case") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    role = F.when(F.col("case") == 4, F.lit("user")).otherwise(F.col("role"))
    twice = F.explode(F.when(F.col("case") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), twice.alias("copy")).drop("copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    found = conversation_repair.summarise(conversation_repair.repair(damaged(rows)))
    every = rows.select(F.col("conv_id").alias("id")).distinct()
    found = every.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left").drop("conv_id")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(F.col("id").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_line_dedup, op2_itq_embedding_dedup, op3_best_fit_packing, op4_exact_top_k, op5_simhash_dedup,
        op6_token_counts, op7_quality_ftrl, op8_bpe_transducer, op9_binary_records,
        op10_html_trees, op11_nnls_packing, op12_source_divergence,
        op13_conversation_repair)}
