"""Column expressions for text, labels and fixed-length sequences.

All of these are built-in Spark expressions (JVM side, inside whole-stage
codegen); none of them needs a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..conf import SEQ_LEN, TextConf

# The blank class used to split words and the characters the
# cleaning step removes (ASCII digits and . : , " ' ( ) [ ] | / ? ! ;).
BLANKS = r"[ \t\n\f\r]+"
STRIP_CHARS = r"""[0-9.:,"'()\[\]|/?!;]"""


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_words(text: str | Column) -> Column:
    """Blank-separated words, empty pieces dropped (dense positions)."""
    return F.filter(F.split(_col(text), BLANKS), lambda x: x != F.lit(""))


def clean_word(word: str | Column) -> Column:
    """Remove digits and ASCII punctuation, lower-case."""
    return F.lower(F.regexp_replace(_col(word), STRIP_CHARS, ""))


def clean_words(words: str | Column) -> Column:
    """P02 on an array: clean every word, drop the ones that become empty."""
    return F.filter(F.transform(_col(words), clean_word), lambda x: x != F.lit(""))


def tokens_of(text: str | Column, normalize: bool = True) -> Column:
    """P01 + P02: the token array of a text.

    Cleaning removes only characters outside the blank class, so cleaning the
    whole text once and then splitting gives exactly the words of splitting
    first and cleaning every word (dropping the emptied ones); the whole-text
    form is one native regex pass instead of one per word.
    """
    if not normalize:
        return split_words(text)
    return split_words(F.lower(F.regexp_replace(_col(text), STRIP_CHARS, "")))


def kept_tokens(text: str | Column, conf: TextConf) -> Column:
    """The tokens that ``conf`` asks for, stop words removed (before n-grams)."""
    return remove_words(tokens_of(text, conf.normalize), conf.stop_words)


def word_count(text: str | Column, conf: TextConf) -> Column:
    """How many words (or n-grams) ``conf`` gives; 0 for a null text."""
    n = F.size(kept_tokens(text, conf)) - F.lit(conf.ngram - 1)
    return F.greatest(F.coalesce(n, F.lit(0)), F.lit(0)).cast("int")


def label_id(label: str | Column, classes: Sequence[str]) -> Column:
    """0-based position in the class list, -1 when absent."""
    arr = F.array(*[F.lit(str(c)) for c in classes])
    return (F.array_position(arr, _col(label).cast("string")) - 1).cast("int")


def id_label(class_id: str | Column, classes: Sequence[str]) -> Column:
    """Class id back to its label (null when out of range)."""
    arr = F.array(*[F.lit(str(c)) for c in classes])
    cid = _col(class_id)
    return F.when((cid >= 0) & (cid < len(classes)), F.try_element_at(arr, cid + 1))


def join_words(words: str | Column, sep: str = " ") -> Column:
    """Words joined with one blank."""
    return F.array_join(_col(words), sep)


def word_ngrams(words: str | Column, n: int) -> Column:
    """N-grams as blank-joined strings, empty when fewer than n words."""
    a = _col(words)
    if n <= 1:
        return a
    count = F.size(a) - F.lit(n - 1)
    # The array beside itself, shifted: no slice of it for every n-gram.
    shifted = F.arrays_zip(*[F.slice(a, i + 1, F.greatest(count, F.lit(0))) for i in range(n)])
    grams = F.transform(shifted, lambda s: F.concat_ws(" ", *[s[str(i)] for i in range(n)]))
    return F.when(count > 0, grams).otherwise(F.array().cast("array<string>"))


def remove_words(words: str | Column, stop: Sequence[str]) -> Column:
    """P06 for a literal list; table-sized lists use a left-anti join."""
    if not stop:
        return _col(words)
    return F.filter(_col(words), lambda x: ~x.isin(list(stop)))


def pad_ids(ids: str | Column, length: int = SEQ_LEN, fill: int = 0) -> Column:
    """P10: first ``length`` ids, then ``fill`` up to ``length``."""
    a = _col(ids)
    head = F.slice(a, 1, length)
    pad = F.array_repeat(F.lit(fill).cast("long"), F.greatest(F.lit(0), F.lit(length) - F.size(head)))
    return F.concat(head.cast("array<long>"), pad)


def step_mask(n: str | Column, length: int = SEQ_LEN) -> Column:
    """1 at the first ``min(n, length)`` steps, 0 after."""
    k = _col(n)
    return F.transform(F.sequence(F.lit(0), F.lit(length - 1)),
                       lambda i: (i < k).cast("int"))


def last_step(n: str | Column, length: int = SEQ_LEN) -> Column:
    """Index of the step that carries the label (-1 for no tokens)."""
    return (F.least(_col(n), F.lit(length)) - 1).cast("int")


def hash_bucket(key: str | Column, seed: int | str, modulus: int) -> Column:
    """Layout-independent pseudo-random bucket of a key.

    First 32 bits of ``md5('<seed>:<key>')`` modulo ``modulus``; a null key is an
    empty one, so it has a bucket too.  The same value is computable in SQL
    engines (``('0x'||substr(md5(..),1,8))::ubigint``).
    """
    text = F.coalesce(_col(key).cast("string"), F.lit(""))
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), text)), 1, 8), 16, 10)
    return F.pmod(h.cast("long"), F.lit(int(modulus)))


ROW_HASH = ("_h1", "_h2")


def row_hash(value: str | Column) -> list[Column]:
    """128 bits that tell rows of one key apart by what they hold, the same
    whenever and wherever they are computed."""
    return [F.xxhash64(_col(value)).alias("_h1"), F.xxhash64(F.lit("2"), _col(value)).alias("_h2")]


# Copies of a row that one array stands for.
REPEAT_BLOCK = 1 << 16


def repeated(df: DataFrame, times: str) -> DataFrame:
    """Every row ``times`` times, that column dropped; a long run goes block by block."""
    n, size = F.col(times), F.lit(REPEAT_BLOCK)
    blocks = F.transform(F.sequence(F.lit(1), F.ceil(n / size)), lambda i: F.least(size, n - (i - 1) * size))
    df = df.withColumn(times, F.explode(F.when(n > 1, blocks).otherwise(F.array(n))))
    return df.withColumn(times, F.explode(F.array_repeat(F.lit(True), F.col(times).cast("int")))).drop(times)


def array_text(a: str | Column, sep: str = ",") -> Column:
    """Arrays as delimited text (for stable comparison with other engines)."""
    return F.array_join(_col(a).cast("array<string>"), sep)


def _sql_literal(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def tokens_sql(text: str = "text", normalize: bool = True) -> str:
    """P01 + P02 as Spark SQL text (for ``SQLTransformer`` stages)."""
    src = f"lower(regexp_replace({text}, {_sql_literal(STRIP_CHARS)}, ''))" if normalize else text
    return f"filter(split({src}, {_sql_literal(BLANKS)}), x -> x != '')"
