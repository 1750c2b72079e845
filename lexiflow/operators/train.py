"""Training operators.

Table-level re-aims of a recurrent classifier: counted token x class
statistics (T01) and Spark ML pipelines (T02, T03).  None of them models word
order the way a recurrent net does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..conf import TrainConf
from ..functions import text as T
from ..sources.files import kept


def fit_token_class(tokens: DataFrame, num_classes: int, word: str = "word",
                    label: str = "label_id") -> DataFrame:
    """``(word, n_word long, n array<long>)`` with ``n[c]`` the count of
    the word in documents of class ``c``.

    One ``groupBy(word)`` with map-side partial aggregation, so a frequent
    word costs one row per map task, not one per occurrence.
    """
    per_class = [F.sum((F.col(label) == c).cast("long")) for c in range(num_classes)]
    return tokens.groupBy(word).agg(F.count(F.lit(1)).alias("n_word"),
                                    F.array(*per_class).alias("n"))


def model_long(model: DataFrame) -> DataFrame:
    """``token_class_model`` long form: ``(word, class_id, n, n_word)``."""
    return (model.select("word", "n_word", F.posexplode("n").alias("class_id", "n"))
                 .select("word", F.col("class_id").cast("int").alias("class_id"), "n", "n_word"))


def known_labels(labelled: DataFrame, num_classes: int, label: str = "label_id") -> DataFrame:
    """Rows whose label is in the class list; the others are rejects."""
    return labelled.where(F.col(label).between(0, num_classes - 1))


def train_counted(labelled: DataFrame, num_classes: int, text: str = "text",
                  label: str = "label_id", normalize: bool = True) -> DataFrame:
    """Counted model from every token of the rows with a known label."""
    words = known_labels(labelled, num_classes, label).select(F.col(label).alias("label_id"), T.tokens_of(text, normalize).alias("_w"))
    steps = words.select("label_id", F.explode_outer("_w").alias("word")).where("word is not null")
    return fit_token_class(steps, num_classes)


# --------------------------------------------------------------- T02, T03 ---

def _hashed_words(num_features: int, text: str = "text") -> list:
    """Tokens of the whole text and their counts in ``num_features`` slots, so
    that no vocabulary is gathered on the driver."""
    from pyspark.ml.feature import HashingTF, SQLTransformer
    return [SQLTransformer(statement=f"SELECT *, {T.tokens_sql(text)} AS tokens FROM __THIS__"),
            HashingTF(inputCol="tokens", outputCol="counts", numFeatures=num_features)]


def _fit_on_kept(labelled: DataFrame, num_classes: int, label: str, stages: list, solver, level: StorageLevel):
    """``stages`` (which learn nothing) and the fitted ``solver`` as one pipeline.

    Their output, without the text, is kept while the solver passes over it, so a
    text is tokenised once however many passes there are.
    """
    from pyspark.ml import PipelineModel
    rows = known_labels(labelled, num_classes, label)
    for stage in stages:
        rows = stage.transform(rows.withColumn(label, F.col(label).cast("double")))
    with kept(rows.select(label, solver.getFeaturesCol()), level) as prepared:
        return PipelineModel([*stages, solver.fit(prepared)])


def train_linear(labelled: DataFrame, num_classes: int, conf: TrainConf = TrainConf(), label: str = "label_id",
                 num_features: int = 2 ** 18, level: StorageLevel = StorageLevel.MEMORY_AND_DISK_2):
    """Hashed term counts -> multinomial logistic regression (L2 ``conf.l2``,
    ``conf.epochs`` iterations) over the rows with a known label.  Returns a
    ``PipelineModel``."""
    from pyspark.ml.classification import LogisticRegression
    solver = LogisticRegression(featuresCol="counts", labelCol=label, regParam=conf.l2,
                                maxIter=conf.epochs, family="multinomial")
    return _fit_on_kept(labelled, num_classes, label, _hashed_words(num_features), solver, level)


def train_embedded(labelled: DataFrame, num_classes: int, conf: TrainConf = TrainConf(),
                   label: str = "label_id", num_features: int | None = None,
                   level: StorageLevel = StorageLevel.MEMORY_AND_DISK_2):
    """A document vector -> one hidden layer -> softmax.

    The vector has a fixed number of hashed word slots (four times
    ``conf.hidden``), scaled to unit length, in place of learned word vectors:
    those would need the whole vocabulary on the driver.  Word order is lost.
    """
    from pyspark.ml.feature import Normalizer
    width = num_features or 4 * conf.hidden
    stages = [*_hashed_words(width), Normalizer(inputCol="counts", outputCol="vector")]
    return _fit_on_kept(labelled, num_classes, label, stages, _hidden_layer("vector", label, width, num_classes, conf), level)


def _hidden_layer(vector: str, label: str, width: int, num_classes: int, conf: TrainConf):
    from .hidden import HiddenLayer
    return HiddenLayer(featuresCol=vector, labelCol=label, layers=[width, conf.hidden, num_classes],
                       seed=conf.net_seed, maxIter=conf.epochs * conf.averaging, blockSize=conf.batch_size)


def predict_pipeline(model, docs: DataFrame, keep: Sequence[str] = ("doc_id", "label_id")) -> DataFrame:
    """Predictions of a fitted pipeline: ``keep + (class_id int)``."""
    return model.transform(docs).select(*keep, F.col("prediction").cast("int").alias("class_id"))
