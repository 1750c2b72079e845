"""Lookups by blocks of documents; arrays of words are computed once."""

import json

import pytest
from pyspark.sql import functions as F

from lexiflow.functions import text as T
from lexiflow.operators import blocks as B
from lexiflow.operators import examples as EX
from lexiflow.operators import score as S
from lexiflow.operators import tokens as TK
from lexiflow.operators import train as TR
from lexiflow.operators import vocab as V
from lexiflow.sources import files as FS
from lexiflow.sources.files import rows

KIND = "doc_id long, text string, label_id int"


def shuffled_rows(spark, df):
    """Rows that the joins and groupings of ``df`` are handed by shuffles, from its final plan."""
    df.collect()
    plan = [df._jdf.queryExecution().executedPlan()]
    found, stack = 0, plan
    while stack:
        p = stack.pop()
        name = p.nodeName()
        if name == "AdaptiveSparkPlan":
            stack.append(p.executedPlan())
        elif name.startswith("ShuffleQueryStage"):
            found += p.shuffle().metrics().apply("shuffleRecordsWritten").value()
            stack.append(p.shuffle())
        else:
            stack += [p.children().apply(i) for i in range(p.children().size())]
    return found


@pytest.fixture()
def docs(spark):
    """Documents that have most of their words in common."""
    return rows(spark, [(i, " ".join(f"w{(i + j) % 60}" for j in range(50)), i % 2) for i in range(200)], KIND).coalesce(1)


@pytest.fixture()
def sort_merge(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = spark.conf.get(names[0])
    for n in names:
        spark.conf.set(n, "-1")
    yield
    spark.conf.set(names[0], old)
    spark.conf.unset(names[1])


def test_scores_shuffle_no_row_a_word(spark, docs, sort_merge):
    """200 documents of 50 words are 10,000 steps; a block has 200 rows and few words."""
    model = TR.train_counted(docs, 2).localCheckpoint()
    found = S.score(docs, model, 2)
    assert shuffled_rows(spark, found) < 1500 and found.count() == 200


def test_examples_shuffle_no_row_a_word(spark, docs, sort_merge):
    """F12, F13, F16."""
    vocab = V.build_vocab(TK.tokenize(docs)).localCheckpoint()
    found = EX.build_examples(docs, vocab)
    assert shuffled_rows(spark, found) < 1500 and found.count() == 200


def test_json_lines_shuffle_no_row_a_word(spark, docs, sort_merge):
    """F10."""
    vocab = V.build_vocab(TK.tokenize(docs)).localCheckpoint()
    found = FS.document_json_lines(TK.with_tokens(docs), vocab)
    assert shuffled_rows(spark, found) < 1500 and found.count() == 200


def test_cells_are_made_in_one_pass(spark, docs):
    """the examples are no longer computed twice."""
    cells = EX.to_cells(EX.build_examples(docs, V.build_vocab(TK.tokenize(docs))))
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapCoGroupsInArrow") == 1 and "Union" not in plan


def test_words_are_split_once(spark, docs):
    """no filter on the size of the array that computes it again."""
    found = [TK.tokenize(docs), EX.build_vocab(docs), TR.train_counted(docs, 2)]
    for df in found[:1] + found[2:]:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("split(") == 1
    assert "size(" not in found[0]._jdf.queryExecution().optimizedPlan().toString()


def test_ngrams_slice_no_array_a_gram(spark):
    """an n-gram is no slice of the array of its own, and gives what a slice gave."""
    df = rows(spark, [(0, ["a", "b", "c"]), (1, ["a"]), (2, []), (3, None), (4, ["a", None, "c", None, None, "d"])], "i long, w array<string>")
    for n in (1, 2, 3):
        got = {r.i: r.g for r in df.select("i", T.word_ngrams("w", n).alias("g")).collect()}
        want = {i: [" ".join(x for x in w[k:k + n] if x is not None) for k in range(len(w) - n + 1)]
                for i, w in ((0, ["a", "b", "c"]), (1, ["a"]), (2, []), (4, ["a", None, "c", None, None, "d"]))} if n > 1 else None
        if want is not None:
            assert got == want | {3: []}
    plan = df.select(T.word_ngrams("w", 2))._jdf.queryExecution().optimizedPlan().toString()
    assert "array_join" not in plan
    kept = df.select("i", T.remove_words("w", ["a", "d"]).alias("k")).collect()
    assert {r.i: r.k for r in kept} == {0: ["b", "c"], 1: [], 2: [], 3: None, 4: ["c"]}


def test_blocks_of_every_size(spark, monkeypatch):
    """Cut after any word or document, blocks give the same; null and empty arrays are left out."""
    data = [(None, ["b"]), (1, ["a", "b", "a"]), (1, ["a"]), (2, []), (3, None), (4, ["c"] * 9), (None, ["b"])]
    df = rows(spark, data, "k long, w array<string>").coalesce(1)
    want = sorted((repr(k), w) for k, w in data if w)
    for most_words, most_docs in ((1, 9), (3, 9), (99, 2), (99, 99)):
        monkeypatch.setattr(B, "BLOCK_WORDS", most_words)
        monkeypatch.setattr(B, "BLOCK_DOCS", most_docs)
        found = B.in_blocks(df, "w").collect()
        own = {r._block: r._words for r in found if r._words is not None}
        assert all(len(set(w)) == len(w) for w in own.values())
        assert sorted((repr(r.k), [own[r._block][i] for i in r._ids]) for r in found if r._ids is not None) == want


def test_json_lines_of_documents(spark):
    """As the lines of their tokens: characters to escape, repeated and null keys, unknown words."""
    data = [(1, 'a\\b "c" é \x01 </x> a\\b'), (2, ""), (3, None), (4, "z a b"), (4, "b z"), (None, "q"), (None, "z r"), (5, "gone"), (6, "z " * 300)]
    docs = rows(spark, data, "doc_id long, text string")
    tokens = TK.tokenize(docs)
    vocab = V.build_vocab(tokens).where("word <> 'gone'")
    got = sorted(map(repr, FS.document_json_lines(TK.with_tokens(docs), vocab).collect()))
    assert got == sorted(map(repr, FS.token_json_lines(V.lookup(tokens, vocab)).collect()))
    assert len(got) == 4
    line = FS.document_json_lines(TK.with_tokens(docs), vocab).where("doc_id = 1").collect()[0].json
    assert [json.loads(x)["word"] for x in json.loads(line)][0] == "a\\b"
    assert FS.document_json_lines(TK.with_tokens(docs.where("false")), vocab).count() == 0


def test_copies_of_a_row_have_a_result_each(spark):
    docs = rows(spark, [(None, "a b", 0), (None, "a b", 0), (7, "c", 1), (7, "a", 1), (8, " ", 0), (9, None, 1)], KIND)
    model = TR.train_counted(docs, 2)
    got = sorted(map(repr, S.score(docs, model, 2).select("doc_id", F.col("class_id")).collect()))
    assert got == ["Row(doc_id=7, class_id=0)", "Row(doc_id=7, class_id=1)", "Row(doc_id=None, class_id=0)", "Row(doc_id=None, class_id=0)"]


def test_matches_are_scored_in_blocks(spark, sort_merge, monkeypatch):
    """200 texts with 40 dictionary words each are 8,000 counted matches; what is shuffled are blocks and their words."""
    from lexiflow.operators import dictionary as D
    words = [f"{a}{b}" for a in "abcdefgh" for b in "vwxyz"]
    lab = rows(spark, [(i, " ".join(words[i % 7::3]), i % 2) for i in range(60)], KIND)
    model = TR.train_counted(lab, 2).localCheckpoint()
    texts = rows(spark, [(None if i % 50 == 0 else i // 2, "".join(words) * (1 + i % 3)) for i in range(200)] + [(7, None), (8, "-")],
                 "doc_id long, text string").coalesce(2)
    counted = D.count_matches(texts, rows(spark, [(w,) for w in [*words, "unseen"]], "word string"))
    found = S.score_segments(counted, model, 2, classes=["x", "y"])
    assert shuffled_rows(spark, found) < 1000
    n = counted.groupBy("doc_id", "word").agg(F.sum("n_here").alias("here"))
    plain = S.predict(S.reduce_steps(S.step_scores(n, model, 2), 2, ["doc_id"], "mean", "here"))
    want = {r.doc_id: (r.class_id, r.mean_score) for r in plain.collect()}
    got = {r.doc_id: (r.class_id, pytest.approx(r.mean_score, abs=2e-6)) for r in found.collect()}
    assert got == want and len(want) == 101
    monkeypatch.setattr(B, "BLOCK_ROWS", 16)               # a key in several blocks, blocks of several chunks
    again = S.score_segments(counted.repartition(3, "word"), model, 2)
    assert {r.doc_id: (r.class_id, pytest.approx(r.mean_score, abs=2e-6)) for r in again.collect()} == want


def test_counted_blocks_keep_every_row(spark):
    data = [("a", "x", 2), ("a", None, 1), (None, "x", 5), ("b", "y", 1 << 40), ("a", "x", 3)]
    blocks = B.counted_blocks(rows(spark, data, "k string, w string, n long").coalesce(1), "k", "w", "n").collect()
    assert len(blocks) == 1
    gaps, n = B._unpacked(blocks[0]["_counts"], 2)
    code, ids = divmod(gaps.cumsum(), len(blocks[0]["_words"]))
    got = {(blocks[0]["_keys"][c], blocks[0]["_words"][i]): m for c, i, m in zip(code.tolist(), ids.tolist(), n.tolist(), strict=True)}
    assert got == {("a", "x"): 5, ("a", None): 1, (None, "x"): 5, ("b", "y"): 1 << 40}


def test_null_keys_and_words_in_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_ROWS", 2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        data = [(None, "x"), (1, None), (2, "y"), (None, "z"), (None, None), (3, "x"), (None, "x")]
        blocks = B.counted_blocks(rows(spark, data, "k long, w string").coalesce(1), "k", "w").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    gaps, n = B._unpacked(blocks[0]["_counts"], 2)
    code, ids = divmod(gaps.cumsum(), len(blocks[0]["_words"]))
    got = {(blocks[0]["_keys"][c], blocks[0]["_words"][i]): m for c, i, m in zip(code.tolist(), ids.tolist(), n.tolist(), strict=True)}
    assert len(blocks) == 1 and got == {(None, "x"): 2, (1, None): 1, (2, "y"): 1, (None, "z"): 1, (None, None): 1, (3, "x"): 1}
