"""Padding, masks, truncation, unknown words and rejects (edge fixtures)."""

import pytest
from pyspark.sql import functions as F

from lexiflow.conf import SEQ_LEN, TextConf
from lexiflow.operators import examples as EX
from lexiflow.operators import tokens as TK
from lexiflow.operators import vocab as V
from lexiflow.sources.files import rows


def _docs(spark, lengths):
    data = [(i, " ".join(f"w{j % 50}" for j in range(n)), 1) for i, n in enumerate(lengths)]
    return rows(spark, data, "doc_id long, text string, label_id int")


def test_lengths(spark):
    lengths = [1, 662, 663, 664, 2000]
    docs = _docs(spark, lengths)
    vocab = V.build_vocab(TK.tokenize(docs))
    ex = {r.doc_id: r for r in EX.build_examples(docs, vocab).collect()}
    for i, n in enumerate(lengths):
        r = ex[i]
        assert r.n_tokens == n
        assert len(r.features) == SEQ_LEN and len(r.feature_mask) == SEQ_LEN
        assert sum(r.feature_mask) == min(n, SEQ_LEN)
        assert r.truncated == (n > SEQ_LEN)
        assert r.label_step == min(n, SEQ_LEN) - 1
        assert all(v == 0 for v in r.features[min(n, SEQ_LEN):])


def test_unknown_words_get_zero_and_known_flag(spark):
    docs = rows(spark, [(0, "alpha beta", 0)], "doc_id long, text string, label_id int")
    vocab = rows(spark, [("alpha", 5, 0), ("gamma", 1, 7)], "word string, freq long, idx long")
    r = EX.build_examples(docs, vocab).collect()[0]
    assert r.features[:2] == [0, 0]
    assert r.known[:2] == [1, 0]
    assert sum(r.feature_mask) == 2


def test_empty_text_rejected(spark):
    docs = rows(spark, [(0, ""), (1, "   "), (2, "\n"), (3, "ok")], "doc_id long, text string")
    rej = {r.doc_id: r.reason for r in EX.rejects(docs).collect()}
    assert rej == {0: "empty", 1: "empty", 2: "empty"}


def test_label_split_rejects(spark):
    lines = rows(spark, [(0, "a word here"), (1, "a"), (2, "z word"), (3, "")],
                 "doc_id long, line string")
    ok, bad = TK.split_label(lines, ["a", "b"])
    ok = ok.collect()
    assert [(r.doc_id, r.label_id, r.text) for r in ok] == [(0, 0, "word here")]
    assert {r.doc_id: r.reason for r in bad.collect()} == {
        1: "label_only", 2: "unknown_label", 3: "empty"}


def test_cells_match_examples(spark):
    docs = _docs(spark, [3, 5])
    vocab = V.build_vocab(TK.tokenize(docs))
    ex = EX.build_examples(docs, vocab)
    cells = EX.to_cells(ex)
    per = cells.groupBy("doc_id", "tensor").count().collect()
    got = {(r.doc_id, r.tensor): r["count"] for r in per}
    assert got[(0, "feature_mask")] == 3 and got[(1, "feature_mask")] == 5
    assert got[(0, "labels")] == 1 and got[(0, "label_mask")] == 1
    assert cells.where(F.col("value") == 0).count() == 0


def test_cells_of_a_wider_example(spark):
    docs = _docs(spark, [900])
    ex = EX.build_examples(docs, V.build_vocab(TK.tokenize(docs)), TextConf(seq_len=1000))
    per = {r.tensor: r.n for r in EX.to_cells(ex).groupBy("tensor").agg(F.count("*").alias("n")).collect()}
    assert per["feature_mask"] == 900 == sum(ex.collect()[0].feature_mask)


@pytest.mark.parametrize("conf, words, ids", [
    (TextConf(), {"the": 3, "Cat": 0, "cat": 2, "sat": 1, "dog": 1}, [0, 1, 3]),
    (TextConf(min_count=2), {"the": 3, "cat": 2}, [0, 1, 9]),
    (TextConf(normalize=False), {"the": 2, "The": 1, "Cat": 1, "cat.": 1, "sat": 1, "dog": 1}, None),
    (TextConf(stop_words=("the",)), {"cat": 2, "sat": 1, "dog": 1}, [0, 2]),
    (TextConf(ngram=2), {"the cat": 2, "cat sat": 1, "the dog": 1}, [0, 1]),
    (TextConf(min_count=2, use_unknown=False), {"the": 3, "cat": 2}, [0, 1])])
def test_each_setting_drives_vocabulary_and_encoding(spark, conf, words, ids):
    docs = rows(spark, [(0, "the Cat sat", 0), (1, "The cat.", 0), (2, "the dog", 1)],
                "doc_id long, text string, label_id int")
    conf = TextConf(**{**conf.__dict__, "unknown_id": 9, "seq_len": 6})
    vocab = EX.build_vocab(docs, conf)
    assert {r.word: r.freq for r in vocab.collect()} == {w: n for w, n in words.items() if n}
    if ids is not None:
        r = EX.build_examples(docs, vocab, conf).where("doc_id = 0").collect()[0]
        assert r.features == ids + [9] * (6 - len(ids)) and sum(r.feature_mask) == len(ids)
        assert r.known == [int(i != 9) for i in r.features[:len(ids)]] + [0] * (6 - len(ids))


def test_rejects_cover_nulls(spark):
    docs = rows(spark, [(0, None, "a"), (1, "x", None), (2, "x", "a"), (3, "x", "q")],
                "doc_id long, text string, label string")
    got = {r.doc_id: r.reason for r in EX.rejects(docs, ["a", "b"]).collect()}
    assert got == {0: "empty", 1: "unknown_label", 3: "unknown_label"}


def test_lookups_without_broadcast(spark):
    """Sort-merge joins give the same rows as broadcasts, hot words included."""
    docs = rows(spark, [(i, "hot " * 50 + f"w{i % 7}") for i in range(60)], "doc_id long, text string")
    toks = TK.tokenize(docs)
    vocab = V.build_vocab(toks).where("word <> 'w3'")

    def all_rows():
        return (sorted(map(tuple, V.lookup(toks, vocab).collect())),
                sorted(map(tuple, V.lookup_or_default(toks, vocab).collect())),
                sorted(map(tuple, V.unknown_words(toks, vocab).collect())))

    want, old = all_rows(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set(adaptive, "-1")
    try:
        assert "SortMergeJoin" in V.lookup(toks, vocab)._jdf.queryExecution().executedPlan().toString()
        assert all_rows() == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset(adaptive)
