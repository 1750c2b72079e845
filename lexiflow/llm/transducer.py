"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

The corpus' frequent words are compiled, with their ids, into an automaton
that shares prefixes and suffixes.  Each arc carries the number of words that
sort before those below it, so the outputs along a word's path add up to its
number, and the number gives its ids.  The automaton is one file in the shared
folder that Spark hands to every executor, where the workers memory-map it.
Words that it lacks are merged exactly.
"""

from __future__ import annotations

import functools
import io
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .bpe import Bpe, gather, load
from .common import cut_lineage, map_texts, regrouped, small_batches
from .encode import as_binary

# Words in the lexicon at most: the bound on what the driver gets and compiles.
LEXICON = 65_536
WORD_BYTES = 64


def word_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``(word, n)``: how often each pre-token occurs in all of ``docs``."""
    small_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in regrouped(batches, "t"):
            words, codes, _ = load(path).pieces(pa.compute.fill_null(part.column(0), ""))
            n = np.bincount(codes, minlength=len(words)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n)], names=["word", "n"])

    rows = docs.select(F.col(f"`{text}`").cast("string").alias("t")).mapInArrow(run, "word string, n bigint")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def compile_lexicon(entries: dict[bytes, list[int]]) -> np.ndarray:
    """The automaton of ``word -> ids`` as one int64 array.

    Words are added in sorted order; whenever a branch is complete, its states
    are replaced by equal ones already known, so suffixes are shared.  Layout:
    six lengths, then the arcs' keys (state << 8 | byte, sorted), targets and
    outputs, the states' final flags, the words' id counts and all ids.
    """
    words = sorted(entries)
    arcs: list[dict[int, int]] = [{}]
    final = [False]
    known: dict[tuple, int] = {}
    path: list[tuple[int, int, int]] = []            # (state, byte, child) of the last word

    def close(depth: int) -> None:
        while len(path) > depth:
            state, byte, child = path.pop()
            same = known.setdefault((final[child], *arcs[child].items()), child)
            if same != child:
                arcs[state][byte] = same

    last = b""
    for word in words:
        depth = 0
        while depth < min(len(last), len(word)) and last[depth] == word[depth]:
            depth += 1
        close(depth)
        state = path[-1][2] if path else 0
        for byte in word[depth:]:
            arcs.append({})
            final.append(False)
            arcs[state][byte] = len(arcs) - 1
            path.append((state, byte, len(arcs) - 1))
            state = len(arcs) - 1
        final[state] = True
        last = word
    close(0)
    below: dict[int, int] = {}
    order, seen = [], {0}                            # states in use, children before parents
    stack = [(0, iter(sorted(arcs[0].items())))]
    while stack:
        state, rest = stack[-1]
        child = next((c for _, c in rest if c not in seen), None)
        if child is None:
            stack.pop()
            order.append(state)
            below[state] = final[state] + sum(below[c] for c in arcs[state].values())
        else:
            seen.add(child)
            stack.append((child, iter(sorted(arcs[child].items()))))
    number = {s: i for i, s in enumerate(reversed(order))}   # the start is 0
    rows = []
    for s in order:
        before = int(final[s])
        for byte, child in sorted(arcs[s].items()):
            rows.append((number[s] << 8 | byte, number[child], before))
            before += below[child]
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 3)
    flags = np.zeros(len(order), np.int64)
    flags[[number[s] for s in order if final[s]]] = 1
    counts = np.array([len(entries[w]) for w in words], np.int64)
    ids = np.array([i for w in words for i in entries[w]], np.int64)
    parts = [table[:, 0], table[:, 1], table[:, 2], flags, counts, ids]
    return np.concatenate([np.array([len(p) for p in parts], np.int64), *parts])


class Lexicon:
    """A compiled automaton (an array, or a memory map of one)."""

    def __init__(self, data: np.ndarray):
        cut = np.cumsum(np.concatenate(([6], data[:6])))
        self.key, self.target, self.out, self.final, self.counts, self.ids = (
            data[a:b] for a, b in zip(cut, cut[1:]))  # noqa: B905

    def look_up(self, words: list[bytes]) -> np.ndarray:
        """Each word's number, or -1: all words walk the automaton together."""
        n = len(words)
        found = np.full(n, -1, np.int64)
        if not len(self.key) or not n:
            return found
        lens = np.fromiter(map(len, words), np.int64, n)
        flat, begin = np.frombuffer(b"".join(words), np.uint8).astype(np.int64), np.cumsum(lens) - lens
        live, state, number, step = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64), 0
        while len(live):
            over = lens[live] == step
            hit = over & (self.final[state] == 1)
            found[live[hit]] = number[hit]
            live, state, number = live[~over], state[~over], number[~over]
            if not len(live):
                break
            want = state << 8 | flat[begin[live] + step]
            at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            ok = self.key[at] == want
            live, state, number = live[ok], self.target[at[ok]], number[ok] + self.out[at[ok]]
            step += 1
        return found


def build_lexicon(docs: DataFrame, path: str, text: str = "text", words: int = LEXICON) -> str:
    """Count all words, compile the most frequent ones and hand the file to the
    executors; returns its name there.

    Counts fall into classes, eight to each doubling; the lexicon has the words
    of as many of the highest classes as together have at most ``words`` words.
    So the driver gets the classes' sizes and then just these words.
    """
    spark = docs.sparkSession
    bpe = load(path)
    counts = word_counts(docs, path, text).where((F.length("word") > 0) & (F.octet_length("word") <= WORD_BYTES))
    counts = cut_lineage(counts.withColumn("class", F.floor(F.log2("n") * 8).cast("int")))
    least, total = 1 << 30, 0
    for r in counts.groupBy("class").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("class")).collect():
        total += r.n
        if total > words:
            break
        least = r["class"]
    top = [r.word for r in counts.where(F.col("class") >= least).collect() if r.word not in bpe.special]
    encoded = [w.encode("utf-8") for w in top]
    ids, n = bpe.merge(encoded)
    stop = np.cumsum(n)
    data = compile_lexicon({w: ids[b - k:b].tolist() for w, b, k in zip(encoded, stop, n, strict=True)})
    return _share(spark, data)


def _share(spark: SparkSession, data: np.ndarray) -> str:
    """Write to the shared folder through Hadoop's file system; add as a file."""
    target = scratch_path(spark, "lexicon") + ".npy"
    raw = io.BytesIO()
    np.save(raw, data)
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(target)
    out = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place)
    out.write(bytearray(raw.getvalue()))
    out.close()
    spark.sparkContext.addFile(target)
    return target.rsplit("/", 1)[1]


@functools.cache
def lexicon(name: str) -> Lexicon:
    return Lexicon(np.load(SparkFiles.get(name), mmap_mode="r"))


class TransducerEncoder:
    """``encode(texts)`` through a lexicon; unseen words are merged."""

    def __init__(self, bpe: Bpe, words: Lexicon):
        self.bpe, self.words = bpe, words

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        pieces, codes, counts = self.bpe.pieces(texts)
        number = self.words.look_up([p.encode("utf-8") for p in pieces])
        special = np.fromiter((self.bpe.special.get(p, -1) for p in pieces), np.int64, len(pieces))
        empty = np.fromiter((not p for p in pieces), bool, len(pieces))
        unseen = np.flatnonzero((number < 0) & (special < 0) & ~empty)
        size = np.where(empty, 0, 1)
        seen = number >= 0
        size[seen] = self.words.counts[number[seen]]
        ids, n = self.bpe.merge([pieces[i].encode("utf-8") for i in unseen])
        size[unseen] = n
        flat = np.zeros(size.sum(), np.int64)
        kind = np.where(seen, 0, np.where(special >= 0, 1, 2))
        where = np.repeat(kind, size)
        flat[where == 0] = gather(self.words.ids, self.words.counts, number[seen])
        flat[where == 1] = special[special >= 0]
        flat[where == 2] = ids
        total = np.concatenate(([0], np.cumsum(size[codes])))
        stop = np.cumsum(counts)
        return gather(flat, size, codes).astype(np.uint32), total[stop] - total[stop - counts]


def encode(docs: DataFrame, path: str, name: str, key: str = "doc_id", text: str = "text",
           decoded: bool = False) -> DataFrame:
    """``(key, n_tokens, ids)`` of each row; ids are little-endian uint32.

    ``name`` comes from ``build_lexicon``.  With ``decoded`` a column
    ``decoded`` has the text that the ids give.  A null text counts as empty
    (no ids, decoded to ""); repeated rows and null keys stay rows of their
    own; an empty table gives an empty result; further columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()

    def make(texts: pa.Array) -> dict[str, object]:
        bpe = load(path)
        ids, counts = TransducerEncoder(bpe, lexicon(name)).encode(texts)
        out: dict[str, object] = {"n_tokens": pa.array(counts), "ids": as_binary(ids, counts)}
        if decoded:
            row, stop = ids.tolist(), np.cumsum(counts).tolist()
            out["decoded"] = pa.array([bpe.decode(row[a:b]) for a, b in zip([0, *stop], stop)],  # noqa: B905
                                      pa.string())
        return out

    return map_texts(docs, [key], text, f"`{key}` {kind}, n_tokens bigint, ids binary"
                     + ", decoded string" * decoded, make)


def decode(rows: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the text of a column of little-endian uint32 ids (null: null).

    Ids outside the vocabulary fail the job, as they mean another tokenizer.
    An existing column of the name ``out`` is replaced."""
    @F.pandas_udf("string")
    def text(column):
        bpe = load(path)
        return column.map(lambda raw: None if raw is None else bpe.decode(np.frombuffer(raw, "<u4").tolist()))

    return rows.withColumn(out, text(F.col(f"`{ids}`")))
