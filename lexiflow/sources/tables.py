"""Driver tables (Parquet) and the labelled views built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.score import attach_labels

LANGS = ("de", "en", "es", "fr")      # class list of documents.lang
BINARY = ("0", "1")                   # class list of labels.quality / labels.toxic


# Session setting: spread every scan over so many partitions by a shuffle.  Unset
# (the default) no scan is shuffled; it helps where a small table is one split.
SCAN_PARTITIONS = "spark.lexiflow.scan.partitions"


def table(spark: SparkSession, sf_dir: str, name: str, partitions: int | None = None) -> DataFrame:
    """A driver table.  ``partitions`` (or the session's setting) deals its rows
    out by a hash of all its columns, so that no key fills a task."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    n = partitions or int(spark.conf.get(SCAN_PARTITIONS, "0"))
    return df.repartition(n, F.xxhash64(*df.columns)) if n else df


def labelled_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text, label_id)`` with ``lang`` as the 4-class target; -1 for
    a language outside the class list."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", "text", T.label_id("lang", LANGS).alias("label_id"))


def labelled_flag(spark: SparkSession, sf_dir: str, flag: str = "quality") -> DataFrame:
    """Documents joined with ``labels``; ``flag`` (0/1) is the target."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = table(spark, sf_dir, "labels").select("doc_id", flag)
    return attach_labels(d, lab).select("doc_id", "text", T.label_id(flag, BINARY).alias("label_id"))


def classes_for(target: str) -> Sequence[str]:
    return LANGS if target == "lang" else BINARY
