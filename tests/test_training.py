"""Training beats the majority rate on held-out rows; scoring rules."""

import pytest
from pyspark.sql import functions as F

from lexiflow.conf import TextConf, TrainConf
from lexiflow.operators import sampling as R
from lexiflow.operators import score as S
from lexiflow.plans import jobs, queries as Q
from lexiflow.sources import tables as TB
from lexiflow.sources.files import rows

from .conftest import SF001, SF01


def _majority(preds):
    return preds.groupBy("label_id").count().agg(F.max("count")).collect()[0][0]


def _acc(preds):
    r = S.accuracy(preds).collect()[0]
    return r.n_correct, r.n_test


def test_counted_lang_beats_majority(spark):
    preds = Q.counted_predictions(spark, SF01, "lang").cache()
    correct, n = _acc(preds)
    assert correct > _majority(preds) and correct / n > 0.95


def test_counted_quality_beats_majority(spark):
    preds = Q.counted_predictions(spark, SF01, "quality").cache()
    correct, _ = _acc(preds)
    assert correct > _majority(preds)


@pytest.mark.parametrize("name", ["train_linear", "train_embedded"])
def test_pipelines_beat_majority(spark, name):
    r = Q.REGISTRY[name](spark, SF01).collect()[0]
    assert r.beats_majority and 0 < r.n_majority < r.n_test


def test_every_token_counts(spark):
    """A long text: its last token decides the last step, all of them the mean."""
    lab = rows(spark, [(i, "left left" if i % 2 else "right right", i % 2) for i in range(10)],
               "doc_id long, text string, label_id int")
    model = Q.TR.train_counted(lab, 2)
    docs = rows(spark, [(0, "right " * 1999 + "left", 0), (1, "left " * 900 + "right " * 1100, 0)],
                "doc_id long, text string, label_id int")
    last = {r.doc_id: r.class_id for r in S.score(docs, model, 2, reduction="last_step").collect()}
    mean = {r.doc_id: r.class_id for r in S.score(docs, model, 2).collect()}
    assert last == {0: 1, 1: 0} and mean == {0: 0, 1: 0}
    long = rows(spark, [(0, "pad " * 1000 + "rare", 1)], "doc_id long, text string, label_id int")
    assert Q.TR.train_counted(long, 2).where("word = 'rare'").count() == 1


def test_unknown_labels_train_nothing(spark):
    lab = rows(spark, [(0, "a b", 0), (1, "b c", 1), (2, "c d", -1), (3, "d", None), (4, None, 0), (5, "e", 7)],
               "doc_id long, text string, label_id int")
    got = {r.word: (r.n_word, r.n) for r in Q.TR.train_counted(lab, 2).collect()}
    assert got == {"a": (1, [1, 0]), "b": (2, [1, 1]), "c": (1, [0, 1])}
    assert Q.TR.predict_pipeline(Q.TR.train_linear(lab.where("text is not null"), 2), lab.where("doc_id < 2")).count() == 2


def test_scoring_without_broadcast(spark):
    want = sorted(map(tuple, Q.counted_predictions(spark, SF001, "quality").collect()))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(tuple, Q.counted_predictions(spark, SF001, "quality").collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_predictions_and_rejects_are_all_rows(spark):
    held = Q.TB.table(spark, SF01, "documents").where(~R.split_flag("text")).count()
    preds = Q.counted_predictions(spark, SF01, "quality").count()
    assert preds + Q.REGISTRY["predict_rejected"](spark, SF01).count() == held


def test_ties_go_to_lowest_class(spark):
    df = rows(spark, [(0, [0.5, 0.5]), (1, [0.2, 0.8]), (2, [0.3, 0.3, 0.4])],
              "doc_id long, scores array<double>")
    got = {r.doc_id: r.class_id for r in S.predict(df).collect()}
    assert got == {0: 0, 1: 1, 2: 2}


@pytest.mark.parametrize("model", ["counted", "linear"])
def test_train_job(spark, tmp_out, model):
    d = TB.table(spark, SF01, "documents").select("doc_id", F.col("lang").alias("label"), "text")
    odd = rows(spark, [(-1, "de", None), (-2, None, "x"), (-3, "zz", "x"), (-4, "de", "123")],
               "doc_id long, label string, text string")
    d = d.unionByName(odd)
    res = jobs.train_job(d, tmp_out, TB.LANGS, TrainConf(model=model))
    assert res["n_test"] > 0 and res["accuracy"] > 0.9
    preds = spark.read.parquet(f"{tmp_out}/predictions")
    gone = spark.read.parquet(f"{tmp_out}/rejected")
    assert {r.doc_id for r in gone.where("doc_id < 0").collect()} == {-1, -2, -3, -4}
    train = d.where(R.split_flag("text")).join(gone, "doc_id", "left_anti").count()
    assert train + preds.count() + gone.count() == d.count()
    assert set(preds.columns) >= {"class_id", "label"}
    assert spark.read.parquet(f"{tmp_out}/confusion").count() >= 4


def test_train_job_uses_the_text_settings(spark, tmp_out):
    d = rows(spark, [(i, "ab"[i % 2], f"the {'x y' if i % 2 else 'y x'} w{chr(97 + i % 20)}{chr(97 + i // 20)}")
             for i in range(60)],
             "doc_id long, label string, text string")
    conf = TrainConf(split_key="doc_id", text=TextConf(ngram=2, stop_words=("the",), min_count=2))
    res = jobs.train_job(d, tmp_out, ["a", "b"], conf)
    assert {r.word for r in spark.read.parquet(f"{tmp_out}/model").collect()} == {"x y", "y x"}
    assert res["accuracy"] == 1.0            # only the order of the two words tells the label


def test_split_disjoint_and_complete(spark):
    d = TB.table(spark, SF01, "documents")
    train, test = R.hash_split(d)
    r = R.check_split(train, test, d).collect()[0]
    assert r.n_overlap == 0 and r.n_missing == 0 and r.n_extra == 0
    assert r.n_train + r.n_test == r.n_all


def test_split_keeps_null_keys_and_check_finds_faults(spark):
    d = rows(spark, [(1, "a"), (2, None), (2, None), (3, "b"), (None, "c")], "doc_id long, text string")
    train, test = R.hash_split(d)
    assert train.count() + test.count() == 5
    one = d.where("doc_id = 1")
    r = R.check_split(train.unionByName(one), test.unionByName(one).where("doc_id <> 3"), d).collect()[0]
    assert r.n_overlap == 1 and r.n_extra >= 1 and r.n_all == 5


def test_layout_independence(spark):
    results = []
    for parts in (1, 4, 8):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        preds = Q.counted_predictions(spark, SF01, "quality")
        voc = Q.doc_vocab(spark, SF01)
        results.append((sorted(map(tuple, preds.collect())),
                        sorted(map(tuple, voc.collect()))))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] == results[2]


def test_train_job_from_lines(spark, tmp_out):
    import os
    p = os.path.join(tmp_out, "data.txt")
    lines = []
    for i in range(120):
        lab = "a" if i % 2 else "b"
        words = "apple pear plum" if lab == "a" else "stone rock sand"
        lines.append(f"{lab} {words} filler{i % 7} common")
    lines += ["a", "z unknown label", ""]
    with open(p, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    res = jobs.train_job_from_lines(spark, p, os.path.join(tmp_out, "out"), ["a", "b"])
    assert res["n_test"] > 0 and res["accuracy"] == 1.0
    rej = {r.reason for r in spark.read.parquet(os.path.join(tmp_out, "out", "rejected_lines")).collect()}
    assert rej == {"label_only", "unknown_label", "empty"}


def test_score_unspaced_text(spark):
    from lexiflow.operators import tokens as TK
    from lexiflow.operators import train as TR2
    lab = rows(spark, [(i, "中国 人 生活" if i % 2 else "今天 天气 好", i % 2) for i in range(20)],
               "doc_id long, text string, label_id int")
    model = TR2.train_counted(lab, 2)
    dic = TK.tokenize(lab).select("word")
    queries = rows(spark, [(100, "我是中国人"), (101, "今天天气很好"), (102, "没有")],
                   "doc_id long, text string")
    matches = TK.match_dictionary(queries, dic)
    got = {r.doc_id: (r.class_id, r.label) for r in S.score_segments(matches, model, 2, classes=["x", "y"]).collect()}
    assert got == {100: (1, "y"), 101: (0, "x")}


def test_hidden_layer_is_the_librarys(spark):
    """passes over blocks give the loss, gradient and model of ``pyspark.ml``, in few tasks."""
    import numpy as np
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.linalg import Vectors

    from lexiflow.operators import hidden as H
    rng = np.random.default_rng(3)
    data = [(float(i % 3), Vectors.sparse(8, [i % 3, 3 + i % 5], [1.0, 0.5]) if i % 4 else Vectors.dense(rng.random(8) + np.eye(8)[i % 3] * 2)) for i in range(96)]
    df = spark.createDataFrame(data, ["label_id", "vector"]).repartition(3)
    args = dict(featuresCol="vector", labelCol="label_id", layers=[8, 5, 3], seed=7, maxIter=12, blockSize=1)
    ours, theirs = (kind(**args).fit(df) for kind in (H.HiddenLayer, MultilayerPerceptronClassifier))
    assert np.allclose(ours.weights.toArray(), theirs.weights.toArray(), rtol=1e-3, atol=1e-3)
    assert [r.prediction for r in ours.transform(df).collect()] == [r.prediction for r in theirs.transform(df).collect()]
    label, x = np.array([int(a) for a, _ in data]), np.array([v.toArray() for _, v in data])
    at = ours.weights.toArray()
    loss, gradient = H.loss_and_gradient(at, [8, 5, 3], label, x)
    for i in range(0, len(at), 7):
        step = np.eye(len(at))[i] * 1e-6
        up, down = (H.loss_and_gradient(at + s, [8, 5, 3], label, x)[0] for s in (step, -step))
        assert abs((up - down) / 2e-6 - gradient[i]) < 1e-4
    blocks = next(H._packing(8)([df.select("label_id", F.unwrap_udt("vector")).toArrow().combine_chunks().to_batches()[0]]))
    back, matrix = H._unpacked(blocks.column(1)[0].as_py(), 8)
    assert sorted(map(repr, zip(back, matrix, strict=True))) == sorted(map(repr, zip(label, x, strict=True)))


def test_weights_meet_the_minimum():
    """L-BFGS on a long narrow valley; it ends where nothing changes any more."""
    import numpy as np

    from lexiflow.operators import hidden as H
    asked = []

    def valley(x):
        asked.append(1)
        a, b = x
        return (1 - a) ** 2 + 100 * (b - a * a) ** 2, np.array([-2 * (1 - a) - 400 * a * (b - a * a), 200 * (b - a * a)])

    assert np.allclose(H.minimise(valley, np.array([-1.2, 1.0]), 200, 1e-12), 1, atol=1e-4) and len(asked) < 120
    assert H.minimise(valley, np.array([-1.2, 1.0]), 0, 1e-6).tolist() == [-1.2, 1.0]
