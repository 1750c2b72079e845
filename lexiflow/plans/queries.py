"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each reads the driver tables (or data Spark derives from them) in full; the
matching DuckDB SQL is in ``oracle.py`` under the same name.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..conf import CharConf, TextConf, TrainConf
from ..functions import text as T
from ..operators import chars as CH
from ..operators import dictionary as D
from ..operators import embed as EM
from ..operators import examples as EX
from ..operators import sampling as R
from ..operators import score as S
from ..operators import sketches as SK
from ..operators import tokens as TK
from ..operators import train as TR
from ..operators import vocab as V
from ..operators import wide as W
from ..session import scratch_path, stored
from ..sources import files as FS
from ..sources import tables as TB
from ..streaming.score_stream import score_stream as _score_stream
from . import jobs as JB

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- step 1 ---

def _labelled(spark: SparkSession, sf_dir: str, target: str) -> DataFrame:
    if target == "lang":
        return TB.labelled_lang(spark, sf_dir)
    return TB.labelled_flag(spark, sf_dir, target)


def counted_predictions(spark: SparkSession, sf_dir: str, target: str = "lang",
                        reduction: str = "mean") -> DataFrame:
    """J05 -> P01 -> R01 -> T01 -> J06 -> A06 -> W02 -> P05 on the held-out side;
    rows with a label outside the class list take no part (see ``predict_rejected``)."""
    classes = TB.classes_for(target)
    lab = _labelled(spark, sf_dir, target).withColumn("_train", R.split_flag("text"))
    lab = TR.known_labels(lab, len(classes))
    model = stored(TR.train_counted(lab.where("_train"), len(classes)), "model")
    return S.score(lab.where(~F.col("_train")), model, len(classes), reduction=reduction, classes=classes)


@register("predict_lang")
def predict_lang(spark, sf_dir):
    return counted_predictions(spark, sf_dir, "lang")


@register("predict_quality")
def predict_quality(spark, sf_dir):
    return counted_predictions(spark, sf_dir, "quality")


@register("predict_toxic")
def predict_toxic(spark, sf_dir):
    """Correctness fixture: ``toxic`` carries no signal the counted model sees."""
    return counted_predictions(spark, sf_dir, "toxic")


@register("predict_rejected")
def predict_rejected(spark, sf_dir):
    """Held-out rows that ``predict_quality``'s job cannot score, with the reason:
    with the predictions they are all held-out rows."""
    d = TB.table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = d.join(TB.table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    held = lab.where(~R.split_flag("text"))
    return EX.rejects(held, TB.BINARY, label="quality")


@register("accuracy_counted")
def accuracy_counted(spark, sf_dir):
    return S.accuracy(counted_predictions(spark, sf_dir, "lang"))


@register("confusion_counted")
def confusion_counted(spark, sf_dir):
    return S.confusion(counted_predictions(spark, sf_dir, "lang"))


def _repeated_keys(rows: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with ``source_key`` for a key: that of many rows, and null for those of src0."""
    d = TB.table(rows.sparkSession, sf_dir, "documents").select("doc_id", "source")
    return rows.join(d, "doc_id").withColumn("source_key", F.when(F.col("source") != "src0", F.col("source"))).drop("source")


@register("predict_repeated_keys")
def predict_repeated_keys(spark, sf_dir):
    """T05 under a key that is no key: one prediction a row all the same."""
    train, test = _lang_split(spark, sf_dir)
    model = stored(TR.train_counted(train, len(TB.LANGS)), "model")
    return S.score(_repeated_keys(test, sf_dir), model, len(TB.LANGS), key="source_key", classes=TB.LANGS)


@register("last_step_predict")
def last_step_predict(spark, sf_dir):
    return counted_predictions(spark, sf_dir, "quality", reduction="last_step")


# ---------------------------------------------------------------- step 2 ---

# Fixed example stop-word list for P06 (the reference's own list is empty).
STOP_WORDS = ("the", "and", "of", "de", "la", "le", "el", "der", "die", "und")
MIN_COUNT = 2


def doc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TK.tokenize(TB.table(spark, sf_dir, "documents"))


def doc_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W01 over the cleaned tokens of all documents, stored for lookups."""
    return stored(V.build_vocab(doc_tokens(spark, sf_dir)), "vocab")


@register("tokens_clean")
def tokens_clean(spark, sf_dir):
    return doc_tokens(spark, sf_dir)


@register("word_counts")
def word_counts(spark, sf_dir):
    return V.word_counts(doc_tokens(spark, sf_dir))


@register("min_count_words")
def min_count_words(spark, sf_dir):
    return V.min_count(V.word_counts(doc_tokens(spark, sf_dir)), MIN_COUNT)


@register("token_total")
def token_total(spark, sf_dir):
    return V.token_total(doc_tokens(spark, sf_dir))


@register("vocab_size")
def vocab_size(spark, sf_dir):
    return V.vocab_size(doc_tokens(spark, sf_dir))


@register("vocab_sizes_approx")
def vocab_sizes_approx(spark, sf_dir):
    """A04 by sketches: one a source and language, stored; united by language, by
    source and over all without the texts.  Each estimate beside the exact count."""
    toks = TK.tokenize(TB.table(spark, sf_dir, "documents"), keep=("lang", "source"))
    sketches = stored(SK.vocab_sketches(toks, ["lang", "source"]), "sketches")
    levels = {"lang, source": ("lang", "source"), "lang": ("lang",), "source": ("source",), "": ()}
    found = []
    for name, by in levels.items():
        exact = toks.select(*by, "word").distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("vocab_size"))
        about = SK.estimated(SK.united(sketches, by)).withColumnRenamed("vocab_size", "about")
        both = exact.unionByName(about, allowMissingColumns=True).groupBy(*by).agg(
            *[F.max(c).alias(c) for c in ("vocab_size", "about", "n_tokens")])
        near = F.abs(F.col("about") - F.col("vocab_size")) <= F.col("vocab_size") * SK.error_bound()
        lang, source = (F.col(c) if c in by else F.lit(None).cast("string").alias(c) for c in ("lang", "source"))
        found.append(both.select(F.lit(name).alias("level"), lang, source, "vocab_size", "n_tokens", near.alias("near")))
    return functools.reduce(DataFrame.unionByName, found)


@register("vocab_index")
def vocab_index(spark, sf_dir):
    return V.build_vocab(doc_tokens(spark, sf_dir))


@register("stop_words_removed")
def stop_words_removed(spark, sf_dir):
    d = TB.table(spark, sf_dir, "documents")
    kept = T.remove_words(T.tokens_of("text"), STOP_WORDS)
    return (d.select("doc_id", F.posexplode(kept).alias("pos", "word"))
             .withColumn("pos", F.col("pos").cast("int")))


@register("word_bigrams")
def word_bigrams(spark, sf_dir):
    d = TK.with_tokens(TB.table(spark, sf_dir, "documents"))
    return TK.ngrams(d, 2)


@register("joined_tokens")
def joined_tokens(spark, sf_dir):
    d = TK.with_tokens(TB.table(spark, sf_dir, "documents"))
    return TK.join_tokens(d).select("doc_id", "joined")


def _conversation_tokens(spark, sf_dir):
    c = TB.table(spark, sf_dir, "conversations")
    return TK.tokenize(c, key="conv_id", keep=("turn",))


@register("lookup_default")
def lookup_default(spark, sf_dir):
    return (V.lookup_or_default(_conversation_tokens(spark, sf_dir), doc_vocab(spark, sf_dir))
             .select("conv_id", "turn", "pos", "word", "idx", "known"))


@register("unknown_words")
def unknown_words(spark, sf_dir):
    return V.unknown_words(_conversation_tokens(spark, sf_dir), doc_vocab(spark, sf_dir))


@register("configured_vocab")
def configured_vocab(spark, sf_dir):
    """The vocabulary that settings ask for: bigrams of the words that are
    no stop words, from two occurrences on."""
    conf = TextConf(min_count=MIN_COUNT, ngram=2, stop_words=STOP_WORDS)
    return EX.build_vocab(TB.table(spark, sf_dir, "documents"), conf)


# ---------------------------------------------------------------- step 3 ---

LINE_CLASSES = ("de", "en")   # two classes as in the reference; es/fr lines are rejected


def _label_lines(spark, sf_dir):
    d = TB.table(spark, sf_dir, "documents")
    return d.select("doc_id", F.concat_ws(" ", "lang", "text").alias("line"))


@register("split_label")
def split_label(spark, sf_dir):
    labelled, _ = TK.split_label(_label_lines(spark, sf_dir), LINE_CLASSES)
    return labelled.select("doc_id", "label", "label_id",
                           T.id_label("label_id", LINE_CLASSES).alias("label_name"), "text")


@register("split_rejected")
def split_rejected(spark, sf_dir):
    _, rejected = TK.split_label(_label_lines(spark, sf_dir), LINE_CLASSES)
    return rejected


@register("encoded_padded")
def encoded_padded(spark, sf_dir):
    d = TB.table(spark, sf_dir, "documents")
    ex = EX.build_examples(d, doc_vocab(spark, sf_dir), label=None)
    return ex.select("doc_id", "n_tokens", "truncated",
                     T.array_text("features").alias("features"),
                     T.array_text("feature_mask").alias("feature_mask"),
                     T.array_text("known").alias("known"), "label_step")


@register("examples_repeated_keys")
def examples_repeated_keys(spark, sf_dir):
    """P09, P14 under a key that is no key: one example a row all the same."""
    d = _repeated_keys(TB.table(spark, sf_dir, "documents").select("doc_id", "text"), sf_dir)
    ex = EX.build_examples(d, doc_vocab(spark, sf_dir), key="source_key", label=None)
    return ex.select("source_key", "n_tokens", "truncated", T.array_text("features").alias("features"),
                     T.array_text("known").alias("known"), "label_step")


def _quality_examples(spark, sf_dir):
    lab = TB.labelled_flag(spark, sf_dir, "quality")
    return EX.build_examples(lab, doc_vocab(spark, sf_dir))


@register("label_steps")
def label_steps(spark, sf_dir):
    return _quality_examples(spark, sf_dir).select("doc_id", "label_id", "n_tokens",
                                                   "label_step", "truncated")


@register("example_tensors")
def example_tensors(spark, sf_dir):
    """Dense tensors of every example, a row of each as text."""
    d = EX.to_tensors(_quality_examples(spark, sf_dir), len(TB.BINARY))
    each = F.array(*[F.struct(F.lit(t).alias("tensor"), F.col(t).alias("rows")) for t in EX.TENSORS])
    rows = d.select("doc_id", F.inline(each)).select("doc_id", "tensor", F.posexplode("rows").alias("i", "row"))
    return rows.select("doc_id", "tensor", F.col("i").cast("int").alias("i"), T.array_text(F.col("row").cast("array<bigint>")).alias("row"))


@register("tensors_roundtrip")
def tensors_roundtrip(spark, sf_dir):
    """Cells -> dense tensors -> cells."""
    cells = EX.to_cells(_quality_examples(spark, sf_dir))
    return EX.tensor_cells(EX.tensors_of_cells(cells, len(TB.BINARY)))


@register("example_cells")
def example_cells(spark, sf_dir):
    return EX.to_cells(_quality_examples(spark, sf_dir))


# ---------------------------------------------------------------- step 4 ---


def _doc_token_json(spark, sf_dir):
    """All cleaned tokens of all documents with their vocabulary ids, a line a document."""
    docs = TK.with_tokens(TB.table(spark, sf_dir, "documents")).select("doc_id", "tokens")
    return FS.document_json_lines(docs, doc_vocab(spark, sf_dir))


@register("token_json")
def token_json(spark, sf_dir):
    return _doc_token_json(spark, sf_dir)


@register("token_json_roundtrip")
def token_json_roundtrip(spark, sf_dir):
    """S04 write -> S03 read -> W06 first match per word."""
    path = scratch_path(spark, "token-json")
    FS.write_token_json(_doc_token_json(spark, sf_dir), path)
    return V.first_match(FS.read_token_json(spark, path))


@register("first_match_conflicts")
def first_match_conflicts(spark, sf_dir):
    """W06 where a word has several indexes: every document's words carry their
    position there, and the first in (doc_id, pos) order counts."""
    toks = doc_tokens(spark, sf_dir)
    items = toks.select(F.col("doc_id").alias("line_no"), F.col("pos").alias("item_no"), "word",
                        F.col("pos").cast("double").alias("index"))
    return V.first_match(items)


@register("lines_roundtrip")
def lines_roundtrip(spark, sf_dir):
    """The lines of all documents written as text and read back, counted."""
    path = scratch_path(spark, "lines")
    d = TB.table(spark, sf_dir, "documents")
    d.where("text is not null").select("text").write.text(path)
    return FS.read_lines(spark, path).groupBy("text").agg(F.count(F.lit(1)).alias("n"))


@register("tsv_roundtrip")
def tsv_roundtrip(spark, sf_dir):
    """Label and cleaned text of every document, tab-separated, and back."""
    path = scratch_path(spark, "tsv")
    d = TK.join_tokens(TK.with_tokens(TB.table(spark, sf_dir, "documents"))).where("length(joined) > 0")
    d.select(F.concat_ws("\t", "lang", "joined").alias("line")).write.text(path)
    return FS.read_labelled_tsv(spark, path)


@register("numbered_lines")
def numbered_lines(spark, sf_dir):
    """The lines of all documents, written in order to many files, with their numbers over all files."""
    path = scratch_path(spark, "lines")
    d = TB.table(spark, sf_dir, "documents").where("text is not null").select("doc_id", "text")
    d.repartitionByRange(8, "doc_id").sortWithinPartitions("doc_id").select("text").write.text(path)
    return FS.read_numbered_lines(spark, path).select("line_id", "text")


@register("tsv_checked")
def tsv_checked(spark, sf_dir):
    """Label and raw text of every document as lines; a text of several lines
    leaves some without a label.  All lines, with the reason if rejected."""
    path = scratch_path(spark, "tsv")
    TB.table(spark, sf_dir, "documents").select(F.concat_ws("\t", "lang", "text").alias("line")).write.text(path)
    good, rejected = FS.read_tsv_checked(spark, path)
    none = F.lit(None).cast("string")
    return good.select("label", "text", none.alias("reason")).unionByName(
        rejected.select(none.alias("label"), F.col("raw").alias("text"), "reason"))


@register("token_json_checked")
def token_json_checked(spark, sf_dir):
    """Token lines of all documents among lines of other kinds: the turns of
    conversations as they are, and items made from labels, which have no word.
    All items and rejected lines, with the reason, counted by word or raw text."""
    path = scratch_path(spark, "token-json")
    tokens = _doc_token_json(spark, sf_dir).select(F.col("json").alias("line"))
    turns = TB.table(spark, sf_dir, "conversations").select(F.col("text").alias("line"))
    flag = F.col("quality").cast("string")
    item = F.concat(F.lit('{"index":'), flag, F.lit("}"))
    labels = TB.table(spark, sf_dir, "labels").select(F.to_json(F.array(item, flag, F.lit("word"))).alias("line"))
    none = TB.table(spark, sf_dir, "labels").select(F.lit("[]").alias("line"))
    FS.write_token_json(tokens.unionByName(turns).unionByName(labels).unionByName(none).withColumnRenamed("line", "json"), path)
    rows = FS.read_token_json_items(spark, path)          # both sides of read_token_json_checked in one pass
    rows = rows.select(F.when(F.col("reason").isNull(), F.col("word")).otherwise(F.col("raw")).alias("value"),
                       F.coalesce("reason", F.lit("")).alias("reason"))
    return rows.groupBy("value", "reason").agg(F.count(F.lit(1)).alias("n"))


@register("examples_roundtrip")
def examples_roundtrip(spark, sf_dir):
    """Encoded examples stored and loaded; ids and mask as sums."""
    path = scratch_path(spark, "examples")
    FS.save_examples(_quality_examples(spark, sf_dir), path)
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    return FS.load_examples(spark, path).select(
        "doc_id", "label_id", "n_tokens", total("features").alias("id_sum"),
        total(F.col("feature_mask").cast("array<bigint>")).alias("mask_sum"))


@register("model_roundtrip")
def model_roundtrip(spark, sf_dir):
    """The counted model saved, loaded and listed."""
    path = scratch_path(spark, "model")
    train, _ = _lang_split(spark, sf_dir)
    FS.save_model(TR.train_counted(train, len(TB.LANGS)), path)
    return TR.model_long(FS.load_model(spark, path))


@register("train_job")
def train_job(spark, sf_dir):
    """Train, evaluate and save; the accuracy and the rows by where they went."""
    path = scratch_path(spark, "job")
    d = TB.table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("label"), "text")
    JB.train_job(d, path, LINE_CLASSES, TrainConf(classes=LINE_CLASSES))
    right = (F.col("label_id") == F.col("class_id")).cast("long").alias("right")
    rows = spark.read.parquet(f"{path}/predictions").select(right).unionByName(
        spark.read.parquet(f"{path}/rejected").select(F.lit(None).cast("long").alias("right")))
    n, hits = F.count("right"), F.coalesce(F.sum("right"), F.lit(0))
    return rows.agg(n.alias("n_test"), hits.cast("long").alias("n_correct"),
                    F.round(hits / n, S.DIGITS).alias("accuracy"), (F.count(F.lit(1)) - n).alias("n_rejected"))


# ---------------------------------------------------------------- step 5 ---

CHARS = CharConf()


def _filtered(spark, sf_dir):
    return CH.filter_charset(TB.table(spark, sf_dir, "documents").select("doc_id", "text"))


def _chunks(spark, sf_dir):
    return CH.chunk_text(_filtered(spark, sf_dir), CHARS.chunk_len, keep_tail=CHARS.keep_tail)


def _pairs(spark, sf_dir):
    return CH.char_pairs(_filtered(spark, sf_dir), keep_tail=CHARS.keep_tail)


def _transitions(spark, sf_dir):
    return CH.count_pairs(_filtered(spark, sf_dir), keep_tail=CHARS.keep_tail)


@register("charset_filtered")
def charset_filtered(spark, sf_dir):
    return _filtered(spark, sf_dir)


@register("chunks")
def chunks(spark, sf_dir):
    return _chunks(spark, sf_dir)


@register("char_ids")
def char_ids(spark, sf_dir):
    return (CH.encode_chars(CH.explode_chars(_chunks(spark, sf_dir)))
              .select("doc_id", "chunk", "pos", "ch", "char_id"))


@register("char_pairs")
def char_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir)


@register("one_hot_chars")
def one_hot_chars(spark, sf_dir):
    return CH.one_hot_chars(_pairs(spark, sf_dir))


@register("transitions")
def transitions(spark, sf_dir):
    return _transitions(spark, sf_dir)


@register("transition_cdf")
def transition_cdf(spark, sf_dir):
    return R.cumulate(_transitions(spark, sf_dir))


@register("draws")
def draws(spark, sf_dir):
    """One draw per chunk, from the distribution of its last character."""
    req = _chunks(spark, sf_dir).select(
        "doc_id", "chunk",
        F.concat_ws(":", F.col("doc_id").cast("string"), F.col("chunk").cast("string")).alias("req_id"),
        F.substring("text", -1, 1).alias("ch"))
    return R.draw(req, _transitions(spark, sf_dir), key="req_id")


def _word_transitions(spark, sf_dir):
    """A10 over words: how often one follows another in a document."""
    d = TK.with_tokens(TB.table(spark, sf_dir, "documents")).select("tokens")
    return W.count_followers(d, "tokens")


@register("word_cdf")
def word_cdf(spark, sf_dir):
    """W03 with words for contexts: any number of choices each."""
    return W.cumulate_wide(_word_transitions(spark, sf_dir), "word", "next_word")


@register("word_draws")
def word_draws(spark, sf_dir):
    """R02 + J07 with words for contexts: a word drawn to follow every word of every conversation."""
    req = _conversation_tokens(spark, sf_dir)
    key = F.concat_ws(":", *[F.col(c).cast("string") for c in ("conv_id", "turn", "pos")])
    return W.draw_wide(req.withColumn("req_id", key), _word_transitions(spark, sf_dir), ctx="word", choice="next_word")


@register("seed_chars")
def seed_chars(spark, sf_dir):
    return R.seed_rows(TB.table(spark, sf_dir, "documents").select("doc_id"))


@register("generated_text")
def generated_text(spark, sf_dir):
    seeds = R.seed_rows(TB.table(spark, sf_dir, "documents").select("doc_id"))
    return R.generate(seeds, _transitions(spark, sf_dir), CHARS.steps, CHARS.seed).select("doc_id", "generated")


@register("generated_samples")
def generated_samples(spark, sf_dir):
    """R04 with prefixes of any length and several samples a prefix: the kept
    characters of every turn of every conversation, extended."""
    c = TB.table(spark, sf_dir, "conversations")
    seeds = c.select("conv_id", "turn", CH.keep_charset("text").alias("prefix")).where("length(prefix) > 0")
    seeds = R.sample_seeds(seeds, CHARS.samples)
    key = F.concat_ws("/", *[F.col(c).cast("string") for c in ("conv_id", "turn", "sample")])
    return R.generate(seeds, _transitions(spark, sf_dir), CHARS.steps, CHARS.seed, key=key, start="prefix")


# ---------------------------------------------------------------- step 6 ---

def _matches(spark, sf_dir, match=TK.match_dictionary):
    dic = _conversation_tokens(spark, sf_dir).select("word")
    docs = TB.table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("text"))
    return match(docs, dic)


@register("dictionary_matches")
def dictionary_matches(spark, sf_dir):
    """P20: words of the conversations vocabulary, of any length, found anywhere
    in the lower-cased document text (index-mode style: overlapping matches)."""
    return _matches(spark, sf_dir)


@register("score_unspaced")
def score_unspaced(spark, sf_dir):
    """P20 -> J06 -> A06 -> W02 -> P05: texts scored by their dictionary matches."""
    train, _ = _lang_split(spark, sf_dir)
    model = stored(TR.train_counted(train, len(TB.LANGS)), "model")
    return S.score_segments(_matches(spark, sf_dir, D.count_matches), model, len(TB.LANGS), classes=TB.LANGS)


def _unspaced(spark, sf_dir, inner=False):
    """The turns of all conversations, cleaned and without blanks, cut into words
    by the frequencies that these have in the documents."""
    clean = F.lower(F.regexp_replace("text", T.STRIP_CHARS, ""))
    turns = TB.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.regexp_replace(clean, T.BLANKS, "").alias("text"))
    known = D.compile_dictionary(V.word_counts(doc_tokens(spark, sf_dir)), freq="freq")
    return D.segment(turns, known, inner=inner)


@register("segmented_words")
def segmented_words(spark, sf_dir):
    """P20: the words of unspaced text by the best path, and the words inside them."""
    found = _unspaced(spark, sf_dir, inner=True).select("conv_id", "turn", F.explode_outer("segments").alias("s"))
    return found.where("s is not null").select("conv_id", "turn", "s.start", "s.word", "s.known", "s.inner")


@register("score_segmented")
def score_segmented(spark, sf_dir):
    """P20 -> J06 -> A06 -> W02 -> P05: unspaced texts scored by the words they are cut into."""
    train, _ = _lang_split(spark, sf_dir)
    model = stored(TR.train_counted(train, len(TB.LANGS)), "model")
    return S.score_words(S.segment_words(_unspaced(spark, sf_dir)), model, len(TB.LANGS), "conv_id", ("turn",),
                         classes=TB.LANGS)


@register("hash_split")
def hash_split(spark, sf_dir):
    d = TB.table(spark, sf_dir, "documents")
    return d.select("doc_id", R.split_flag("text").alias("is_train"))


@register("split_check")
def split_check(spark, sf_dir):
    d = TB.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    train, test = R.hash_split(d)
    return R.check_split(train, test, d)


# ---------------------------------------------------------------- step 7 ---

def _lang_split(spark, sf_dir):
    lab = TB.labelled_lang(spark, sf_dir).withColumn("_train", R.split_flag("text"))
    lab = TR.known_labels(lab, len(TB.LANGS))
    return lab.where("_train").drop("_train"), lab.where(~F.col("_train")).drop("_train")


def _against_majority(predictions: DataFrame) -> DataFrame:
    """One row: held-out rows, those of the most frequent label, and whether more
    than these were predicted right."""
    per = predictions.groupBy("label_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("label_id") == F.col("class_id")).cast("long")).alias("right"))
    return per.agg(F.sum("n").alias("n_test"), F.max("n").alias("n_majority"),
                   (F.sum("right") > F.max("n")).alias("beats_majority"))


@register("train_linear")
def train_linear(spark, sf_dir):
    train, test = _lang_split(spark, sf_dir)
    model = TR.train_linear(train, len(TB.LANGS), TrainConf(classes=TB.LANGS))
    return _against_majority(TR.predict_pipeline(model, test))


@register("train_embedded")
def train_embedded(spark, sf_dir):
    train, test = _lang_split(spark, sf_dir)
    model = TR.train_embedded(train, len(TB.LANGS), TrainConf(classes=TB.LANGS))
    return _against_majority(TR.predict_pipeline(model, test))


@register("train_word_vectors")
def train_word_vectors(spark, sf_dir):
    """T03 with a learned embedding: word vectors from all documents' texts, the
    classifier from the train side's labels."""
    train, test = _lang_split(spark, sf_dir)
    vectors = EM.train_word_vectors(TB.table(spark, sf_dir, "documents"))
    model = EM.train_on_vectors(train, vectors, len(TB.LANGS), TrainConf(classes=TB.LANGS))
    return _against_majority(model.predict(test))


@register("near_words")
def near_words(spark, sf_dir):
    """The weights that are factorised: positive mutual information of words near each other."""
    d = TB.table(spark, sf_dir, "documents")
    vocab = stored(V.build_vocab(doc_tokens(spark, sf_dir), EM.MIN_COUNT), "vocab")
    found = EM.mutual_information(EM.near_pairs(d, vocab))
    return found.select("word_id", "other_id", F.round("weight", 6).alias("weight"))


# ---------------------------------------------------------------- step 8 ---

def _document_stream(spark, sf_dir):
    schema = TB.table(spark, sf_dir, "documents").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
                 .option("maxFilesPerTrigger", 64).parquet(f"{sf_dir.rstrip('/')}/documents.parquet*"))


@register("score_stream_rejects")
def score_stream_rejects(spark, sf_dir):
    """Every arriving row has a prediction or a reason.  The rows' text is the
    first line without its ASCII letters, which leaves many of them no word."""
    train, _ = _lang_split(spark, sf_dir)
    model = stored(TR.train_counted(train, len(TB.LANGS)), "model")
    out, rejected = scratch_path(spark, "scored"), scratch_path(spark, "rejected")
    line = F.regexp_replace(F.substring_index("text", "\n", 1), "[a-zA-Z]", "")
    q = _score_stream(_document_stream(spark, sf_dir), model, len(TB.LANGS), out, scratch_path(spark, "stream-ckpt"),
                      keep=(), prepare=lambda df: df.select("doc_id", line.alias("text")), classes=TB.LANGS,
                      rejected_path=rejected)
    q.awaitTermination()
    none = F.lit(None).cast("string")
    return spark.read.parquet(out).select("doc_id", "label", none.alias("reason")).unionByName(
        spark.read.parquet(rejected).select("doc_id", none.alias("label"), "reason"))


@register("score_stream")
def score_stream(spark, sf_dir):
    """Documents arrive as a file stream and are scored per micro-batch
    by the counted model trained on the train side of ``lang``."""
    train, _ = _lang_split(spark, sf_dir)
    model = stored(TR.train_counted(train, len(TB.LANGS)), "model")      # every batch looks it up
    stream = _document_stream(spark, sf_dir)
    out = scratch_path(spark, "scored")
    prep = lambda df: df.select("doc_id", "text", T.label_id("lang", TB.LANGS).alias("label_id"))
    q = _score_stream(stream, model, len(TB.LANGS), out, scratch_path(spark, "stream-ckpt"), prepare=prep,
                      classes=TB.LANGS)
    q.awaitTermination()
    return spark.read.parquet(out).select("doc_id", "label_id", "class_id", "mean_score", "label")


@register("mean_scores")
def mean_scores(spark, sf_dir):
    """A06 long form: mean class scores of every held-out document, all classes."""
    k = len(TB.BINARY)
    lab = TB.labelled_flag(spark, sf_dir, "quality").withColumn("_train", R.split_flag("text"))
    model = stored(TR.train_counted(lab.where("_train"), k), "model")
    test = lab.where(~F.col("_train"))
    return S.mean_scores(S.reduced_scores(test, model, k, keep=(), words=T.tokens_of("text")))


@register("token_class_model")
def token_class_model(spark, sf_dir):
    """A09 long form: ``(word, class_id, n, n_word)`` of the lang model."""
    train, _ = _lang_split(spark, sf_dir)
    return TR.model_long(TR.train_counted(train, len(TB.LANGS)))
