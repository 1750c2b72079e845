"""The character set of the character model."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Ids follow this order -- a-z, A-Z, 0-9, then the 15 marks
# ! & ( ) ? - ' " , . : ; <space> <newline> <tab>.  77 characters in all.
PUNCTUATION = ["!", "&", "(", ")", "?", "-", "'", '"', ",", ".", ":", ";", " ", "\n", "\t"]
CHARSET: list[str] = (list(string.ascii_lowercase) + list(string.ascii_uppercase)
                      + list(string.digits) + PUNCTUATION)
assert len(CHARSET) == 77

# Regex of everything outside the set, valid for Java and RE2 alike.
OUTSIDE_CHARSET = r"""[^a-zA-Z0-9!&()?\-'",.:; \n\t]"""


def charset_table(spark: SparkSession) -> DataFrame:
    """``(ch string, char_id int)``, 77 rows."""
    return spark.createDataFrame([(c, i) for i, c in enumerate(CHARSET)],
                                 "ch string, char_id int")


def char_id(ch: str | Column) -> Column:
    """P17 in the row: the id of a character of the set, null for any other string."""
    c = F.col(ch) if isinstance(ch, str) else ch
    place = {ord(x): i for i, x in enumerate(CHARSET)}
    ids = F.array(*[F.lit(place.get(code)).cast("int") for code in range(128)])
    return F.when(F.octet_length(c) == 1, F.get(ids, F.ascii(c)))


def keep_charset(text: str | Column) -> Column:
    """Drop every character outside the set."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(c, OUTSIDE_CHARSET, "")


def chars_of(text: str | Column) -> Column:
    """Code-point array of a string (surrogate pairs stay whole): the split at nothing, which runs no regex."""
    c = F.col(text) if isinstance(text, str) else text
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(c, ""))
