"""Golden vocabulary of the reference's pipeline test (three lines)."""

from lexiflow.operators import tokens as TK
from lexiflow.operators import vocab as V
from lexiflow.sources.files import rows

# Fixed input: the three test lines.
LINES = ["我 是 中国 人。", "中国 是 个 好 地方。", "中国 人 生活 在 中国。"]


def test_three_lines_vocabulary(spark):
    df = rows(spark, list(enumerate(LINES)), "doc_id long, text string")
    toks = TK.tokenize(df)
    assert toks.count() == 14
    vocab = {r.word: (r.freq, r.idx) for r in V.build_vocab(toks).collect()}
    assert len(vocab) == 11
    assert vocab["中国"] == (3, 0)
    assert vocab["是"] == (2, 1)
    # full-width punctuation survives cleaning, so 人。 is its own word
    assert "人。" in vocab and "人" in vocab
    singles = sorted(w for w, (f, _) in vocab.items() if f == 1)
    assert [vocab[w][1] for w in singles] == list(range(2, 11))


def test_ids_dense_under_many_partitions(spark):
    df = rows(spark, [(i, f"w{i % 97} w{i % 13} w{i % 5}") for i in range(2000)],
              "doc_id long, text string")
    voc = V.build_vocab(TK.tokenize(df, normalize=False)).collect()
    ids = sorted(r.idx for r in voc)
    assert ids == list(range(len(voc)))
    order = sorted(voc, key=lambda r: (-r.freq, r.word))
    assert [r.idx for r in order] == list(range(len(voc)))


def test_cleaning_contract(spark):
    df = rows(spark, [(0, "Hello, WORLD! 42 (x) [y] a|b c/d e?f g;h 'q' \"z\" 3.14")],
              "doc_id long, text string")
    words = [r.word for r in TK.tokenize(df).orderBy("pos").collect()]
    assert words == ["hello", "world", "x", "y", "ab", "cd", "ef", "gh", "q", "z"]


def test_dictionary_match_of_all_lengths(spark):
    from lexiflow.operators.tokens import match_dictionary
    texts = [(0, "ab abc xab"), (1, "😀ab c😀abc"), (2, "zz" * 30 + "a"), (3, ""), (4, None), (4, "x\nab")]
    words = ["ab", "abc", "bc", "b c", "c", "😀a", "zz" * 20, "zz" * 29 + "za", "z" * 7, "", None, "ab"]
    docs = rows(spark, texts, "doc_id long, text string")
    dic = rows(spark, [(w,) for w in words], "word string")
    known = {w for w in words if w and " " not in w}
    want = sorted({(d, s, t[s:s + n]) for d, t in texts if t for s in range(len(t)) for n in range(1, 70)
                   if s + n <= len(t) and t[s:s + n] in known})
    for window in (2, 8, 24):
        got = sorted((r.doc_id, r.start, r.word) for r in match_dictionary(docs, dic, window=window).collect())
        assert got == want


def test_stop_words_list_and_table(spark):
    df = rows(spark, [(0, "the cat and the dog")], "doc_id long, text string")
    toks = TK.tokenize(df)
    by_list = [r.word for r in TK.remove_stop_words(toks, ["the", "and"]).orderBy("pos").collect()]
    stop = rows(spark, [("the",), ("and",)], "w string")
    by_table = [r.word for r in TK.remove_stop_words(toks, stop).orderBy("pos").collect()]
    assert by_list == by_table == ["cat", "dog"]


def test_ngrams_short_texts(spark):
    from pyspark.sql import functions as F
    from lexiflow.functions import text as T
    df = rows(spark, [(0, "a b c d"), (1, "a b"), (2, "")], "doc_id long, text string")
    g = TK.ngrams(TK.with_tokens(df), 3).groupBy("doc_id").agg(F.collect_list("ngram").alias("g"))
    got = {r.doc_id: sorted(r.g) for r in g.collect()}
    assert got == {0: ["a b c", "b c d"]}
    assert df.select(F.size(T.word_ngrams(T.tokens_of("text"), 3))).collect()[2][0] == 0
