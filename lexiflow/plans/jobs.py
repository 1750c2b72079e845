"""End-to-end jobs (T06): the main training flow as one function.

labelled rows -> rejects -> hash split -> counted or linear model -> held-out scoring ->
accuracy + confusion -> saved model and tables.  Only the one-row accuracy
result comes back to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..conf import TrainConf
from ..functions import text as T
from ..operators import sampling as R
from ..operators import score as S
from ..operators import tokens as TK
from ..operators import train as TR
from ..operators import vocab as V
from ..sources import files as FS


def fit(labelled: DataFrame, num_classes: int, conf: TrainConf = TrainConf(), text: str = "text"):
    """T01 (a model table) or T02 (a fitted pipeline), as ``conf.model`` says."""
    if conf.model == "counted":
        words = TK.with_words(labelled, conf.text, text, "_words").select("label_id", F.explode_outer("_words").alias("word"))
        words = words.where("word is not null")
        if conf.text.min_count > 1:
            words = words.join(V.min_count(V.word_counts(words), conf.text.min_count).select("word"), "word", "left_semi")
        return TR.fit_token_class(words, num_classes)
    if conf.model == "linear":
        return TR.train_linear(_as_words(labelled, conf, text), num_classes, conf)
    raise ValueError(f"unknown model {conf.model!r}")


def _as_words(rows: DataFrame, conf: TrainConf, text: str) -> DataFrame:
    """The text as the words that the settings ask for, an n-gram's joined by ``_``."""
    words = F.transform("_words", lambda w: F.replace(w, F.lit(" "), F.lit("_")))
    return TK.with_words(rows, conf.text, text, "_words").withColumn("text", T.join_words(words)).drop("_words")


def predict(docs: DataFrame, model, classes: Sequence[str], conf: TrainConf = TrainConf(),
            key: str = "doc_id", keep: Sequence[str] = ("label_id",), text: str = "text") -> DataFrame:
    """``key + keep + (class_id[, mean_score], label)`` by either model."""
    if conf.model == "linear":
        found = TR.predict_pipeline(model, _as_words(docs, conf, text), [key, *keep])
        return found.withColumn("label", T.id_label("class_id", classes))
    words = TK.with_words(docs, conf.text, text, "_words")
    return S.score_words(words, model, len(classes), key, keep, "_words", conf.reduction, classes)


def train_job(labelled: DataFrame, out_dir: str, classes: Sequence[str],
              conf: TrainConf = TrainConf(), key: str = "doc_id",
              label: str = "label", text: str = "text") -> dict:
    """Train, evaluate and save.  ``labelled`` is ``(key, label, text)``.

    Writes ``model`` (a table, or a pipeline for the linear model),
    ``predictions``, ``confusion`` and ``rejected`` under ``out_dir`` and returns
    the accuracy row as a dict.  Every row of ``labelled`` is in the training
    side, in ``predictions`` or in ``rejected``: reason ``empty`` (no word) or
    ``unknown_label``.
    """
    k, spark, out = len(classes), labelled.sparkSession, out_dir.rstrip("/")
    marked = labelled.withColumn("_n", T.word_count(text, conf.text)) \
        .withColumn("label_id", F.coalesce(T.label_id(label, classes), F.lit(-1)))
    reason = F.when(F.col("_n") <= 0, F.lit("empty")).when(F.col("label_id") < 0, F.lit("unknown_label"))
    marked = marked.withColumn("_reason", reason)
    marked.where("_reason is not null").select(key, F.col("_reason").alias("reason")) \
        .write.mode("overwrite").parquet(f"{out}/rejected")
    ok = marked.where("_reason is null").drop("_reason", "_n")
    train, test = R.hash_split(ok, conf.train_fraction, conf.seed, key=conf.split_key)
    FS.save_model(fit(train, k, conf, text), f"{out}/model")
    model = FS.load_model(spark, f"{out}/model", pipeline=conf.model == "linear")
    predict(test, model, classes, conf, key, ("label_id",), text) \
        .write.mode("overwrite").parquet(f"{out}/predictions")
    preds = spark.read.parquet(f"{out}/predictions")
    S.confusion(preds).write.mode("overwrite").parquet(f"{out}/confusion")
    return S.accuracy(preds).collect()[0].asDict()


def train_job_from_lines(spark, path: str, out_dir: str, classes: Sequence[str],
                         conf: TrainConf = TrainConf()) -> dict:
    """T06 from a labelled text file (``<label> <word> <word> ...`` per line).

    S01 -> P03/P04 (bad lines to ``rejected_lines``) -> ``train_job``.
    """
    lines = FS.read_lines(spark, path).withColumnRenamed("text", "line")
    labelled, rejected = TK.split_label(lines, classes)
    rejected.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/rejected_lines")
    return train_job(labelled.select("doc_id", "label", "text"), out_dir, classes, conf)
