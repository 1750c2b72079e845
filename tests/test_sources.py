"""File sources and sinks: lines, TSV, token-JSON round trip, stores."""

import json
import os

from pyspark.sql import functions as F

from lexiflow.operators import examples as EX
from lexiflow.operators import tokens as TK
from lexiflow.operators import vocab as V
from lexiflow.sources import files as FS
from lexiflow.sources.files import rows

from .conftest import SF001


def test_read_lines(spark, tmp_out):
    p = os.path.join(tmp_out, "lines.txt")
    with open(p, "w", encoding="utf-8") as f:
        f.write("a first line\nb second\n")
    df = FS.read_lines(spark, p)
    assert sorted(r.text for r in df.collect()) == ["a first line", "b second"]
    assert df.select("doc_id").distinct().count() == 2


def test_read_tsv(spark, tmp_out):
    p = os.path.join(tmp_out, "src.tsv")
    with open(p, "w", encoding="utf-8") as f:
        f.write('a\tsome "quoted" text\nb\tother\textra\nc\n')
    got = {r.label: r.text for r in FS.read_labelled_tsv(spark, p).collect()}
    assert got == {"a": 'some "quoted" text', "b": "other", "c": None}


def test_token_json_round_trip(spark, tmp_out):
    df = rows(spark, [(0, 'say "hi" back\\slash ok'), (1, "ok again")], "doc_id long, text string")
    toks = TK.tokenize(df, normalize=False)
    vocab = V.build_vocab(toks)
    looked = V.lookup(toks, vocab)
    path = os.path.join(tmp_out, "tj")
    FS.write_token_json(looked, path)
    back = FS.read_token_json(spark, path)
    got = {(r.word, int(r["index"])) for r in back.collect()}
    want = {(r.word, r.idx) for r in looked.collect()}
    assert got == want
    # words with quotes and backslashes survive the double JSON encoding
    assert ('"hi"', vocab.where('word = \'"hi"\'').collect()[0].idx) in got
    first = {r.word: int(r["index"]) for r in V.first_match(back).collect()}
    assert first == {r.word: r.idx for r in vocab.collect()}


def test_token_json_newline_word(spark):
    items = rows(spark, [(0, 0, "a\nb", 3)], "doc_id long, pos int, word string, idx long")
    line = FS.token_json_lines(items).collect()[0].json
    import json
    assert json.loads(json.loads(line)[0]) == {"word": "a\nb", "index": 3}


def test_examples_store(spark, tmp_out):
    docs = rows(spark, [(0, "a b c", 1), (1, "b c", 0)], "doc_id long, text string, label_id int")
    vocab = V.build_vocab(TK.tokenize(docs))
    ex = EX.build_examples(docs, vocab)
    p = os.path.join(tmp_out, "ex")
    FS.save_examples(ex, p, partition_by="label_id")
    back = FS.load_examples(spark, p)
    assert back.count() == 2
    assert back.where(F.col("label_id") == 1).select("n_tokens").collect()[0][0] == 3


def test_model_store(spark, tmp_out):
    from lexiflow.conf import TrainConf
    from lexiflow.operators import train as TR
    docs = rows(spark, [(i, f"word{i % 3} common", i % 2) for i in range(20)],
                "doc_id long, text string, label_id int")
    m = TR.train_counted(docs, 2)
    p = os.path.join(tmp_out, "m")
    FS.save_model(m, p)
    assert FS.load_model(spark, p).count() == m.count()
    pm = TR.train_linear(docs, 2, TrainConf(epochs=3))
    p2 = os.path.join(tmp_out, "pm")
    FS.save_model(pm, p2)
    loaded = FS.load_model(spark, p2, pipeline=True)
    assert TR.predict_pipeline(loaded, docs).count() == 20


def test_bucketed_lookup_has_no_shuffle(spark):
    from lexiflow.session import scratch_path
    docs = rows(spark, [(i, f"w{i % 31} w{i % 7} shared") for i in range(300)], "doc_id long, text string")
    toks = TK.tokenize(docs)
    vocab = V.build_vocab(toks)
    bt = FS.save_bucketed(toks, "tok_bucketed", "word", 8, scratch_path(spark, "tok-b"))
    bv = FS.save_bucketed(vocab, "vocab_bucketed", "word", 8, scratch_path(spark, "voc-b"))
    joined = bt.join(bv.select("word", "idx").hint("merge"), "word")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    want = sorted(map(tuple, V.lookup(toks, vocab).select("doc_id", "pos", "word", "idx").collect()))
    assert sorted(map(tuple, joined.select("doc_id", "pos", "word", "idx").collect())) == want


def test_read_nested_token_json(spark, tmp_out):
    p = os.path.join(tmp_out, "pip.txt")
    with open(p, "w", encoding="utf-8") as f:
        f.write('["{\\"word\\":\\"中国\\",\\"index\\":0.0}","{\\"word\\":\\"是\\",\\"index\\":1.0}"]\n')
        f.write('["{\\"word\\":\\"我\\",\\"index\\":9.0}"]\n')
    back = FS.read_token_json(spark, p)
    got = sorted((r.word, r["index"], r.item_no) for r in back.collect())
    assert got == [("中国", 0.0, 0), ("我", 9.0, 0), ("是", 1.0, 1)]


def test_scans_are_shuffled_only_where_asked(spark):
    from lexiflow.sources.tables import SCAN_PARTITIONS, table
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(table(spark, SF001, "conversations"))
    wide = table(spark, SF001, "conversations", partitions=6)
    assert "Exchange" in plan(wide) and wide.rdd.getNumPartitions() == 6
    spark.conf.set(SCAN_PARTITIONS, "5")
    try:
        assert table(spark, SF001, "documents").rdd.getNumPartitions() == 5
    finally:
        spark.conf.unset(SCAN_PARTITIONS)


def test_tsv_with_a_key(spark, tmp_out):
    p = os.path.join(tmp_out, "k.tsv")
    with open(p, "w", encoding="utf-8") as f:
        f.write("a\tx\nb\ty\n")
    assert [tuple(r) for r in FS.read_labelled_tsv(spark, p, key="id").collect()] == [(0, "a", "x"), (1, "b", "y")]


def test_scratch_is_removed(spark):
    from lexiflow.session import scratch
    with scratch(spark, "t") as path:
        rows(spark, [(1,)], "a int").write.parquet(path)
        assert spark.read.parquet(path).count() == 1
    assert not os.path.exists(path.removeprefix("file:").replace("//", "/"))


def test_session_takes_the_master_from_outside(spark):
    from lexiflow.session import build_session, checkpoint_root
    assert build_session().sparkContext.master == "local[4]"
    assert spark.conf.get("spark.checkpoint.dir").removeprefix("file://") in checkpoint_root(spark)
    assert spark.conf.get("spark.cleaner.referenceTracking.cleanCheckpoints") == "true"


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace as Some

    import pytest

    from lexiflow.session import checkpoint_root

    def session(master, warehouse):
        kept = []
        context = Some(master=master, getCheckpointDir=lambda: kept[-1] if kept else None, setCheckpointDir=kept.append)
        conf = {"spark.sql.warehouse.dir": warehouse}
        return Some(sparkContext=context, conf=Some(get=lambda k, d=None: conf.get(k, d)))

    for warehouse in ("file:/home/me/spark-warehouse", "/home/me/spark-warehouse"):
        assert checkpoint_root(session("local[8]", warehouse)).endswith("/_checkpoints")
        for master in ("spark://a:7077", "yarn", "local-cluster[3,2,1000]"):
            with pytest.raises(ValueError, match="spark.checkpoint.dir"):
                checkpoint_root(session(master, warehouse))
    assert checkpoint_root(session("yarn", "hdfs://a/warehouse/")) == "hdfs://a/warehouse/_checkpoints"


def test_token_json_is_parsed_once(spark, tmp_out):
    lines = ['["{\\"word\\":\\"a\\",\\"index\\":1.0}","x"]', "no json", "[]", "[null]"]
    spark.createDataFrame([(x,) for x in lines], "line string").coalesce(1).write.text(f"{tmp_out}/one")
    items = FS.read_token_json_items(spark, f"{tmp_out}/one")
    got = sorted((r.line_id, r.item_no, r.reason, r.word) for r in items.where("line_id < 1").collect())
    assert got == [(0, 0, None, "a"), (0, 1, "bad_item", None)]
    assert sorted((r.line_id, r.reason, r.raw) for r in items.where("line_id > 0").collect()) == [
        (1, "no_json", "no json"), (2, "no_item", "[]"), (3, "bad_item", None)]
    for part in (*FS.read_token_json_checked(spark, f"{tmp_out}/one"), FS.read_token_json(spark, f"{tmp_out}/one")):
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(ArrayType") <= 1 and plan.count("from_json(Struct") <= 1


def test_first_match_needs_no_sort(spark):
    """the order of lines and items is one number, so a hash aggregate holds it; also at the ends of its range."""
    most, least = (1 << 63) - 1, -(1 << 63)
    data = [(5, 2, "a", 1.0), (5, 1, "a", 2.0), (6, 0, "a", 3.0), (None, 3, "b", 4.0), (0, 0, "b", 5.0), (None, None, "b", 6.0),
            (most, (1 << 31) - 1, "c", 7.0), (most, (1 << 31) - 2, "c", 8.0), (least, -(1 << 31), "d", 9.0), (None, 0, "d", None),
            (least, 7, "e", 1.5), (least, None, "e", 2.5), (0, -(1 << 31), None, 3.5)]
    items = rows(spark, data, "line_no long, item_no int, word string, index double")
    found = V.first_match(items)
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    got = {r.word: r["index"] for r in found.collect()}
    by_struct = items.groupBy("word").agg(F.min_by("index", F.struct("line_no", "item_no")).alias("index"))
    assert got == {r.word: r["index"] for r in by_struct.collect()} == {"a": 2.0, "b": 6.0, "c": 8.0, "d": None, "e": 2.5, None: 3.5}
    text = V.first_match(items.withColumn("line_no", F.col("line_no").cast("string")))
    assert {r.word: r["index"] for r in text.where("word = 'a'").collect()} == {"a": 2.0}


def test_token_json_files_are_compressed_and_bounded(spark, tmp_out, monkeypatch):
    """the files of token-JSON are packed; every line is there, its number by file and place."""
    monkeypatch.setitem(FS.JSON_FILES, "maxRecordsPerFile", 3)
    lines = [json.dumps([json.dumps({"word": f"word{i % 3}", "index": i}) for i in range(n, n + 40)]) for n in range(10)]
    FS.write_token_json(spark.createDataFrame([(x,) for x in [*lines, "", None]], "json string").coalesce(1), f"{tmp_out}/tj")
    files = [x for x in os.listdir(f"{tmp_out}/tj") if x.startswith("part-")]
    assert len(files) == 4 and all(x.endswith(".gz") for x in files)
    assert sum(os.path.getsize(f"{tmp_out}/tj/{x}") for x in files) * 2 < sum(map(len, lines))
    back = FS.read_numbered_lines(spark, f"{tmp_out}/tj").orderBy("line_id").collect()
    assert [r.text for r in back] == [*lines, "", ""] and [r.line_id for r in back] == list(range(12))
    assert FS.read_token_json(spark, f"{tmp_out}/tj").count() == 400


def test_what_was_shuffled_goes_when_a_table_is_stored(spark):
    from lexiflow.session import CLEAN_SHUFFLES, stored
    local = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    files = lambda: {x for top in local for _, _, names in os.walk(top) for x in names if x.startswith("shuffle_")}
    before, old = files(), spark.conf.get(CLEAN_SHUFFLES, None)
    found = stored(spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count(), "counts")
    assert not files() - before
    assert found.count() == 100 and spark.conf.get(CLEAN_SHUFFLES, None) == old
