"""Columns that are named like an operator's own pass through unharmed."""

from pyspark.sql import functions as F

from lexiflow.llm import line_dedup, packing, quality, simhash

NAMES = ["__k", "__t", "__u", "__h", "__r", "__g", "__lines", "__ends", "__chunks", "__stay", "__new", "__text", "__score",
         "__group", "c0", "c1", "c2", "k", "t", "h", "one", "removed", "dotted.name"]
TEXTS = ["\n".join(f"line {i % 7} of {d % 3} tells {i * d % 5}" for i in range(30)) for d in range(12)] + [None, "", "one line"]


def _docs(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, TEXTS[4])]
    return spark.createDataFrame(rows, "doc_id long, text string")


def _named(df):
    return df.select("*", *[F.concat(F.lit(n + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(n)
                            for n in NAMES])


def _same(plain, named):
    """``named`` holds the rows of ``plain``, each with its own further columns."""
    assert [c for c in named.columns if c not in NAMES] == plain.columns
    rows = named.collect()
    for r in rows:
        assert all(r[n] == f"{n}:{'-' if r['doc_id'] is None else r['doc_id']}" for n in NAMES)
    assert sorted(repr([r[c] for c in plain.columns]) for r in rows) == sorted(repr(list(r)) for r in plain.collect())


def test_line_dedup(spark):
    docs = _docs(spark)
    plain = line_dedup.dedup_lines(docs, n_chars=None, removed="gone")
    assert plain.where("gone > 0").count() > 0
    _same(plain, line_dedup.dedup_lines(_named(docs), n_chars=None, removed="gone"))


def test_keep_one(spark):
    docs = _docs(spark)
    plain = simhash.keep_one(docs)
    assert 0 < plain.count() < docs.count()
    _same(plain, simhash.keep_one(_named(docs)))


def test_accept(spark):
    docs = _docs(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    w = quality.train(docs, labels)
    _same(quality.accept(docs, w), quality.accept(_named(docs), w))


def test_pack(spark):
    pieces = _docs(spark).withColumn("length", F.when(F.col("text").isNotNull(), F.length("text") % 60 + 1))
    out = packing.pack(_named(pieces).withColumn("offset", F.lit("old")), 64)
    assert out.columns == [*pieces.columns, *NAMES, "sequence_id", "offset"]
    rows = out.collect()
    assert len(rows) == pieces.count()
    used = {}
    for r in sorted((r for r in rows if r.length), key=lambda r: (r.sequence_id, r.offset)):
        assert r["__group"] == f"__group:{'-' if r.doc_id is None else r.doc_id}"
        assert r.offset == used.get(r.sequence_id, 0)
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values()) <= 64
