"""Line dedup with content-defined chunks, in DataFrame functions alone.

A rolling hash runs over the hashes of neighbouring lines; where its value says
so, a chunk starts.  A chunk reaches to the first line of the next one, that
line included, so it has at least two lines, and boundaries depend on two lines
each: an insertion shifts none but its own.  A chunk that occurs before,
anywhere in the corpus, is removed once its bytes are found equal, and with it
the lines beside it that are equal on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import numbered

# Fixed values of the rolling hash: base and modulus.  One value in SPARED starts no chunk.
BASE, MODULUS, SPARED = 31, 1_000_003, 8
# A line with something to read; the others start no chunk.
CONTENT = r"[^\x20\x09-\x0D]"
# Tasks among which the occurrences of one chunk are dealt before AQE splits what is still skewed, and
# occurrences for each copy of its lines.
SALTS, SHARED = 4, 2048


def _line_hashes(lines: Column) -> Column:
    return F.transform(lines, lambda x: F.conv(F.substring(F.md5(x.cast("binary")), 1, 7), 16, 10).cast("long"))


def with_chunks(rows: DataFrame, text: str = "__text", out: str = "__chunks") -> DataFrame:
    """Add the array of chunks ``(start, n, low, high, body, counts)``: first line, number of lines, first line
    of the chunk before and last line of the chunk after, text, and whether two different lines with content
    are in it.  The ends of a text are ends of chunks; null stays null."""
    n = F.size("__lines")
    # Each step is a projection of its own, so that no array is computed anew for each of its elements.
    rows = rows.withColumn("__lines", F.split(F.col(text), "\n", -1))
    rows = rows.withColumn("__h", _line_hashes(F.col("__lines")))
    rows = rows.withColumn("__at", F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.get("__lines", i).rlike(CONTENT)))
    rows = rows.withColumn("__g", F.transform("__at", lambda i: F.get("__h", i)))
    after = F.slice("__g", 2, F.greatest(F.size("__g") - 1, F.lit(0)))
    rows = rows.withColumn("__r", F.zip_with("__g", after, lambda a, b: (b + a * BASE) % MODULUS % SPARED))
    inner = F.when(F.size("__g") >= 3, F.sequence(F.lit(1), F.size("__g") - 2)).otherwise(F.array().cast("array<int>"))
    starts = F.transform(F.filter(inner, lambda j: F.get("__r", j) != 0), lambda j: F.get("__at", j))
    rows = rows.withColumn("__starts", F.concat(F.array(F.lit(0)), starts))
    stops = F.concat(F.slice("__starts", 2, F.size("__starts") - 1), F.array(n - 1))
    rows = rows.withColumn("__stops", stops)
    places = F.sequence(F.lit(0), F.size("__starts") - 1)
    rows = rows.withColumn("__places", F.transform(places, lambda i: F.struct(
        F.get("__starts", i).alias("start"), (F.get("__stops", i) - F.get("__starts", i) + 1).alias("n"),
        F.get("__starts", F.greatest(i - 1, F.lit(0))).alias("low"),
        F.coalesce(F.get("__stops", i + 1), F.get("__stops", i)).alias("high"))))
    lines = lambda c: F.slice("__lines", c["start"] + 1, c["n"])
    rows = rows.withColumn(out, F.when(F.col(text).isNotNull(), F.transform("__places", lambda c: F.struct(
        c["start"].alias("start"), c["n"].alias("n"), c["low"].alias("low"), c["high"].alias("high"),
        F.array_join(lines(c), "\n").alias("body"),
        (F.size(F.array_distinct(F.filter(lines(c), lambda x: x.rlike(CONTENT)))) >= 2).alias("counts")))))
    return rows.drop("__h", "__at", "__g", "__r", "__starts", "__stops", "__places")


def _equal_ahead(a: Column, b: Column) -> Column:
    """Elements at the front of ``a`` that equal those of ``b``."""
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    return F.when(F.array_contains(same, False), (F.array_position(same, False) - 1).cast("int")).otherwise(F.size(same))


def _removed(m: Column) -> Column:
    """Numbers of the lines of ``__lines`` that the match ``m`` takes out: the chunk if its lines are those of
    the first occurrence, and what equals its neighbours on both sides."""
    seg, before, n, start = m["seg"], m["before"], m["n"], m["start"]
    stop = start + n
    after = F.size(seg) - before - n
    own_before = F.slice("__lines", F.greatest(start - before, F.lit(0)) + 1, F.least(before, start))
    up = F.least(_equal_ahead(F.reverse(F.slice(seg, 1, before)), F.reverse(own_before)), before)
    down = F.least(_equal_ahead(F.slice(seg, before + n + 1, after), F.slice("__lines", stop + 1, after)), after)
    equal = F.slice(seg, before + 1, n) == F.slice("__lines", start + 1, n)
    return F.when(equal, F.sequence(start - up, stop - 1 + down)).otherwise(F.array().cast("array<int>"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars",
                removed: str | None = "removed_lines") -> DataFrame:
    """``docs`` with every repeated chunk of two lines or more taken out.

    The first occurrence stays: that of the smallest (key, hash of the text,
    line).  With a repeated chunk go the lines before and after it that equal
    those beside its first occurrence, as far as that one's neighbouring chunks
    reach; whatever is equal further on is a repeated chunk itself.  Each line
    taken out equals one at a smaller place, so the first copy of any line
    stays.  Chunks without two different lines of content (more than white
    space) are let be.  What is left is joined by line breaks; ``n_chars``,
    where that column exists, gets the new length, and ``removed`` the number
    of lines taken out.  A null text stays null and an empty one empty; texts of
    one line are never touched; a document may end up empty but is never
    dropped.  Null keys count as smaller than others.  Rows of equal key and
    text are one document: they are treated alike, and only differ from others.
    An empty table gives an empty result; all further columns are passed through.

    Chunks are counted by 64-bit hash, checksum and length.  Only the first
    occurrence of a repeated chunk sends its lines and its neighbours', one copy
    for each 2048 occurrences, to the documents that repeat it; there they are
    compared byte by byte.  A document's row holds a few times its own text then.
    A hash that two different chunks share removes nothing.
    """
    names, given = docs.columns, numbered(docs)
    at_key, at_text = (F.col(f"c{names.index(c)}") for c in (key, text))
    whole = at_text.cast("string")
    # A document is known by 128 bits of hash of its key and text, which are never null: joins and groups share them.
    given = given.withColumns({"__u": F.xxhash64(at_key.isNull(), at_key), "__t": F.xxhash64(whole)})
    rows = given.select("__u", "__t", at_key.alias("__k"), whole.alias("__text"))
    same = ["h", "crc", "size"]
    # The outer form: for explode(), Spark would infer a filter that computes the array a second time.
    chunk = (with_chunks(rows).select("__u", "__t", "__k", F.explode_outer("__chunks").alias("c")).where("c.counts")
             .select("__u", "__t", "__k", "c.start", "c.n", "c.low", "c.high", F.xxhash64("c.body").alias("h"),
                     F.crc32(F.col("c.body").cast("binary")).alias("crc"), F.length("c.body").alias("size")))
    first = F.min(F.struct("__k", "__t", "start", "n", "low", "high", "__u"))
    known = stored(chunk.groupBy(*same).agg(F.count(F.lit(1)).alias("times"), first.alias("first")).where("times > 1")
                   .select(*same, F.ceil(F.col("times") / SHARED).cast("int").alias("copies"), "first.*"), "repeated_chunks")

    # A chunk of a third of all rows meets its class in SALTS tasks; classes of repeated chunks are few rows.
    classes = known.select(*same, "copies", F.col("__u").alias("fu"), F.col("__t").alias("ft"), F.col("start").alias("fs"),
                           F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salt = F.pmod(F.xxhash64("__u", "__t", "start"), F.lit(SALTS)).cast("int").alias("salt")
    later = (chunk.select("__u", "__t", "start", *same, salt).join(classes.hint("merge"), [*same, "salt"])
             .where("not (__u = fu and __t = ft and start = fs)")
             .select("__u", "__t", "start", *same,
                     F.pmod(F.xxhash64("__t", "start", "__u"), F.col("copies")).cast("int").alias("copy")))
    asked = known.groupBy("__u", "__t").agg(
        F.collect_list(F.struct(*same, "copies", "start", "n", "low", "high")).alias("__asked"))
    # The hash of the row makes this join need the columns that the last one passes on: both read one shuffle.
    passed = [f"c{i}" for i, name in enumerate(names) if name == text or name not in (n_chars, removed)]
    sent = (given.join(asked, ["__u", "__t"]).withColumn("__lines", F.split(whole, "\n", -1))
            .withColumn("__row", F.xxhash64(*passed))
            .withColumn("__sent", F.transform("__asked", lambda c: F.struct(
                *[c[s].alias(s) for s in (*same, "copies", "n")], (c["start"] - c["low"]).alias("before"),
                F.slice("__lines", c["low"] + 1, c["high"] - c["low"] + 1).alias("seg"))))
            .select("__row", F.explode_outer("__sent").alias("s")).select("__row", "s.*")
            .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
            .groupBy(*same, "copy").agg(F.min(F.struct("__row", "n", "before", "seg")).alias("f")))
    matches = (later.join(sent, [*same, "copy"])
               .groupBy("__u", "__t").agg(F.collect_set(F.struct("start", "f.n", "f.before", "f.seg")).alias("__matches")))

    met = given.join(matches, ["__u", "__t"], "left")
    met = met.withColumn("__lines", F.when(F.col("__matches").isNotNull(), F.split(whole, "\n", -1)))
    met = met.withColumn("__gone", F.array_distinct(F.flatten(F.transform("__matches", _removed))))
    met = met.withColumn("__left", F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__gone")))
    kept = F.array_join(F.transform("__left", lambda i: F.get("__lines", i)), "\n")
    met = met.withColumn("__new", F.when(F.col("__gone").isNull(), at_text).otherwise(kept))
    gone = F.coalesce(F.when(F.col("__gone").isNotNull(), F.size("__gone")), F.lit(0))
    out = []
    for i, name in enumerate(names):
        if name == text:
            out.append(F.col("__new").alias(name))
        elif name == n_chars:
            kind = docs.schema[i].dataType
            out.append(F.length("__new").cast(kind).alias(name))
        elif name != removed:
            out.append(F.col(f"c{i}").alias(name))
    return met.select(*out, *([gone.alias(removed)] if removed else []))
