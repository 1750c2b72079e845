import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])

# Column names that operators use themselves.
CLASHES = ["k", "h", "t", "fp", "low", "root", "piece", "start", "length", "ids", "score", "node", "salt", "first"]


@pytest.fixture()
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with further columns of clashing names."""
    def make(rows):
        df = spark.createDataFrame(
            [(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows], DOCS)
        for c in CLASHES:
            df = df.selectExpr("*", f"'x' as `{c}`")
        return df
    return make


# Nulls, empty and blank texts, a very long one, repeated rows, ties.
EDGE = [(1, None), (2, ""), (3, "  \n\n "), (4, "word " * 30_000), (5, "same text here now"), (5, "same text here now"),
        (6, "same text here now"), (None, "same text here now"), (None, None), (7, "é́ ΑΣ <|endoftext|> 😀 x y  z\t1")]


@pytest.fixture()
def edge(docs_of):
    return docs_of(EDGE)


@pytest.fixture()
def nothing(docs_of):
    return docs_of([])
