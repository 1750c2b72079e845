"""One result for every row, whatever its key."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexiflow.conf import TextConf, TrainConf
from lexiflow.functions import text as T
from lexiflow.operators import examples as EX
from lexiflow.operators import score as S
from lexiflow.operators import tokens as TK
from lexiflow.operators import train as TR
from lexiflow.operators import vocab as V
from lexiflow.plans import jobs as JB
from lexiflow.sources.files import rows

FIVE = [(1, "a b", 0), (1, "b c c", 0), (None, "a c", 1), (None, "a c", 1), (2, "c", 1)]
KIND = "doc_id long, text string, label_id int"


def alone(spark, data, run):
    """The results of ``run`` on each row by itself, without the key."""
    out = Counter()
    for row in data:
        out += Counter((row[0], *r) for r in map(tuple, run(rows(spark, [(0, *row[1:])], KIND)).drop("doc_id").collect()))
    return out


@pytest.mark.parametrize("reduction", ["mean", "last_step"])
def test_one_prediction_a_row(spark, reduction):
    model = TR.train_counted(
        rows(spark, [(0, "a a b", 0), (1, "c c a", 1)], KIND), 2).cache()
    score = lambda df: S.score(df, model, 2, reduction=reduction)
    data = [*FIVE, (None, "", 0), (None, None, 0), (1, "a b", 1), (None, "c a", 1)]
    got = Counter((r.doc_id, *tuple(r)[1:]) for r in score(rows(spark, data, KIND).repartition(3)).collect())
    assert got == alone(spark, data, score)
    assert sum(got.values()) == 7


def test_one_example_a_row(spark):
    vocab = V.build_vocab(TK.tokenize(rows(spark, FIVE, KIND))).cache()
    for conf in (TextConf(seq_len=4), TextConf(seq_len=2, use_unknown=False), TextConf(seq_len=3, ngram=2, use_unknown=False)):
        flat = lambda df, conf=conf: EX.build_examples(df, vocab, conf).withColumns(
            {c: T.array_text(c) for c in ("features", "feature_mask", "known")})
        data = [*FIVE, (1, "a b", 0), (1, "a b", 1), (None, "zzz", 0), (3, "", 0)]
        got = Counter(tuple(r) for r in flat(rows(spark, data, KIND).repartition(3)).collect())
        assert got == alone(spark, data, flat)
    two = rows(spark, [(None, "a c", 0), (None, "b c", 0)], KIND)
    ids = {r.word: r.idx for r in vocab.collect()}
    found = EX.build_examples(two, vocab, TextConf(seq_len=2)).collect()
    assert sorted(r.features for r in found) == sorted([[ids["a"], ids["c"]], [ids["b"], ids["c"]]])


def test_job_keeps_every_row(spark, tmp_out):
    data = [(i % 3 or None, f"w{i % 4} common w{i % 7}", "ab"[i % 2]) for i in range(200)] + [(1, "", "a"), (None, "x", "q")]
    docs = rows(spark, data, "doc_id long, text string, label string")
    conf = TrainConf(classes=("a", "b"), split_key="text")
    found = JB.train_job(docs, tmp_out, ("a", "b"), conf)
    from lexiflow.operators.sampling import split_flag
    train = docs.where("label <> 'q' and text <> ''").where(split_flag("text")).count()
    assert found["n_test"] + spark.read.parquet(f"{tmp_out}/rejected").count() + train == len(data)


def test_long_runs_are_repeated_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(T, "REPEAT_BLOCK", 4)
    df = rows(spark, [("a", 1), ("b", 4), ("c", 5), ("d", 17)], "k string, n long")
    assert {r.k: r["count"] for r in T.repeated(df, "n").groupBy("k").count().collect()} == {"a": 1, "b": 4, "c": 5, "d": 17}
    assert T.repeated(df.where("n > 100"), "n").agg(F.count("*")).collect()[0][0] == 0
