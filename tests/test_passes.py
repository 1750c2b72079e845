"""Kept examples, dense tensors and sketches."""

import os

import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from lexiflow.conf import TextConf, TrainConf
from lexiflow.operators import examples as EX
from lexiflow.operators import sketches as SK
from lexiflow.operators import tokens as TK
from lexiflow.operators import train as TR
from lexiflow.operators import vocab as V
from lexiflow.sources.files import kept, rows

KIND = "doc_id long, text string, label_id int"


def counted(docs, folder):
    """``docs``, with a file written each time a partition's rows are read."""
    def run(batches):
        import uuid
        open(os.path.join(folder, uuid.uuid4().hex), "w").close()
        yield from batches
    return docs.mapInArrow(run, docs.schema)


@pytest.mark.parametrize("train", [TR.train_linear, TR.train_embedded])
def test_texts_are_read_once_in_training(spark, tmp_out, train):
    docs = rows(spark, [(i, f"w{i % 5} w{i % 3} x", i % 2) for i in range(60)], KIND).repartition(3)
    model = train(counted(docs, tmp_out), 2, TrainConf(epochs=4, hidden=4))
    assert len(os.listdir(tmp_out)) == 3
    assert TR.predict_pipeline(model, docs).count() == 60
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_kept_rows_are_released(spark, tmp_out):
    df = counted(rows(spark, [(i, "a", 0) for i in range(9)], KIND).repartition(2), tmp_out)
    with kept(df, StorageLevel.MEMORY_AND_DISK) as k:
        assert [k.count(), k.agg(F.max("doc_id")).collect()[0][0], len(os.listdir(tmp_out))] == [9, 8, 2]
        with kept(k) as again:
            assert again is k
        assert k.storageLevel != StorageLevel.NONE
    assert df.storageLevel == StorageLevel.NONE


def test_dense_tensors_and_back(spark):
    docs = rows(spark, [(1, "a b a c", 1), (2, "c", 0), (None, "b b", 1), (3, "a b c a b c", 2)], KIND)
    vocab = V.build_vocab(TK.tokenize(docs))
    ex = EX.build_examples(docs, vocab, TextConf(seq_len=4)).cache()
    dense = {r.doc_id: r for r in EX.to_tensors(ex, 2, seq_len=4).collect()}
    ids = {r.word: float(r.idx) for r in vocab.collect()}
    assert dense[1].features == [[ids["a"], ids["b"], ids["a"], ids["c"]]] and dense[1].feature_mask == [[1.0] * 4]
    assert dense[1].labels == [[0.0] * 4, [0.0, 0.0, 0.0, 1.0]] and dense[1].label_mask == [[0.0, 0.0, 0.0, 1.0]]
    assert dense[2].labels == [[1.0, 0.0, 0.0, 0.0], [0.0] * 4] and dense[None].feature_mask == [[1.0, 1.0, 0.0, 0.0]]
    assert dense[3].labels == [[0.0] * 4] * 2
    inside = ex.where("label_id < 2")
    cells = EX.to_cells(inside)
    want = sorted(map(repr, cells.collect()))
    assert sorted(map(repr, EX.tensor_cells(EX.to_tensors(inside, 2, seq_len=4)).collect())) == want
    back = EX.tensors_of_cells(cells, 2, seq_len=4)
    assert sorted(map(repr, EX.tensor_cells(back).collect())) == want
    assert {r.doc_id: tuple(r) for r in back.collect()} == {k: tuple(v) for k, v in dense.items() if k != 3}
    vectors = EX.tensor_vectors(back).where("doc_id = 1 and tensor = 'labels' and i = 1").collect()[0].vector
    assert vectors.toArray().tolist() == [0.0, 0.0, 0.0, 1.0]
    with pytest.raises(Exception, match="outside the tensors"):
        EX.tensors_of_cells(EX.to_cells(ex), 2, seq_len=4).collect()


def test_sketches_are_united(spark):
    toks = spark.range(60_000).select((F.col("id") % 3).alias("g"), F.concat(F.lit("w"), (F.col("id") % 20_000).cast("string")).alias("word"))
    toks = toks.unionByName(rows(spark, [(None, "only"), (0, None)], "g long, word string"))
    one = SK.vocab_sketches(toks, ["g"])
    size = {r.g: (r.vocab_size, r.n_tokens) for r in SK.estimated(one).collect()}
    for g in range(3):
        assert abs(size[g][0] - 20_000) < 20_000 * SK.error_bound() and size[g][1] == 20_000
    assert size[None] == (1, 1)
    whole = SK.estimated(SK.united(one)).collect()[0]
    assert abs(whole.vocab_size - 20_001) < 20_001 * SK.error_bound() and whole.n_tokens == 60_001
