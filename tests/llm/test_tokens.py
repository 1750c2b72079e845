"""Encoding, counts, packing and record files against the tokenizers library."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexiflow.llm import packing, records, token_counts, transducer
from lexiflow.llm.bpe import load
from lexiflow.llm.encode import encoder
from tests.conftest import SF001

from .conftest import EDGE

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
LIBRARY = {p: Tokenizer.from_file(p) for p in (BYTE, WORD)}


def library(texts, path):
    return [e.ids for e in LIBRARY[path].encode_batch([t or "" for t in texts], add_special_tokens=False)]


def split(ids, counts):
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] if len(counts) else []


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_every_code_point_is_encoded_as_by_the_library(path):
    texts = [f"a{chr(c)} B{chr(c)}.{chr(c)}!" for c in range(1, 0x3400) if not 0xD800 <= c < 0xE000]
    want = library(texts, path)
    assert split(*encoder(path).encode(pa.array(texts))) == want
    assert token_counts.counter(path).count(pa.array(texts)).tolist() == [len(x) for x in want]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abAB 'sté\n\t  ßΣ😀<|endoftext|>12!.", max_size=60), min_size=1, max_size=8))
def test_any_text_is_encoded_as_by_the_library(texts):
    for path in (BYTE, WORD):
        want = library(texts, path)
        assert split(*encoder(path).encode(pa.array(texts))) == want
        assert token_counts.counter(path).count(pa.array(texts)).tolist() == [len(x) for x in want]
    assert [records.ids_of(t, BYTE).tolist() for t in texts] == library(texts, BYTE)


def test_merging_takes_the_lowest_rank_from_the_left():
    bpe = load(BYTE)
    words = ["a" * n for n in range(1, 60)] + ["ababab", "é" * 9]
    ids, n = bpe.merge([w.encode() for w in words])
    assert split(ids, n) == library(words, BYTE)


def test_counts_of_edge_rows(edge, nothing):
    rows = token_counts.count_tokens(edge, BYTE).collect()
    want = Counter((i, len((t or "").encode()), len(x), len(x) > 512) for (i, t), x in zip(
        EDGE, library([t for _, t in EDGE], BYTE), strict=True))
    assert Counter(tuple(r) for r in rows) == want
    assert token_counts.count_tokens(nothing, BYTE).count() == 0


def test_automaton_shares_suffixes_and_numbers_words():
    words = {w.encode(): [i, i + 1] for i, w in enumerate(["tap", "taps", "top", "tops", "stop", "stops", "été"])}
    lexicon = transducer.Lexicon(transducer.compile_lexicon(words))
    assert len(lexicon.final) < 18                   # a tree of prefixes would need more states
    numbers = lexicon.look_up([*sorted(words), b"to", b"topsy", b"x", b""])
    assert numbers.tolist() == [*range(len(words)), -1, -1, -1, -1]
    stop = np.cumsum(lexicon.counts)
    assert [lexicon.ids[b - n:b].tolist() for b, n in zip(stop, lexicon.counts, strict=True)] == [
        words[w] for w in sorted(words)]


@settings(max_examples=40, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=5), max_size=30), st.sets(st.binary(max_size=5), max_size=20))
def test_automaton_knows_exactly_its_words(words, others):
    lexicon = transducer.Lexicon(transducer.compile_lexicon({w: [1] for w in words}))
    order = sorted(words)
    assert lexicon.look_up(order).tolist() == list(range(len(order)))
    assert all(n < 0 for n in lexicon.look_up(sorted(others - words)))


@pytest.mark.parametrize("words", [0, 3, 65_536])
def test_transducer_round_trip(spark, edge, words):
    name = transducer.build_lexicon(edge, WORD, words=words)
    rows = transducer.encode(edge, WORD, name, decoded=True).collect()
    want = Counter()
    for (i, _), ids in zip(EDGE, library([t for _, t in EDGE], WORD), strict=True):
        want[i, len(ids), np.array(ids, "<u4").tobytes(), LIBRARY[WORD].decode(ids, skip_special_tokens=False)] += 1
    assert Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in rows) == want


def test_transducer_on_the_table_and_decoding_of_ids(spark, nothing):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    name = transducer.build_lexicon(docs, WORD, words=2000)
    counts = transducer.word_counts(docs, WORD).where("length(word) > 0")
    assert {r.word: r.n for r in counts.collect()} == Counter(
        w for r in docs.collect() for w in load(WORD).split(load(WORD).normal(r.text or "")))
    rows = transducer.decode(transducer.encode(docs, WORD, name), WORD).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        ids = library([texts[r.doc_id]], WORD)[0]
        assert hashlib.sha256(bytes(r.ids)).digest() == hashlib.sha256(np.array(ids, "<u4").tobytes()).digest()
        assert r.decoded == LIBRARY[WORD].decode(ids, skip_special_tokens=False)
    assert transducer.encode(nothing, WORD, transducer.build_lexicon(nothing, WORD)).count() == 0


def test_byte_level_decoding_replaces_broken_characters():
    rng = random.Random(3)
    for _ in range(50):
        ids = [rng.randrange(50257) for _ in range(12)]
        assert load(BYTE).decode(ids) == LIBRARY[BYTE].decode(ids, skip_special_tokens=False)


def test_best_fit_takes_the_tightest_bin():
    bins, offsets = packing.best_fit(np.array([6, 5, 4, 3, 2]), 10)
    # 6 | 5 | 4 beside 6 (room 4 is tighter than 5) | 3 beside 5 | 2 beside 5 and 3
    assert bins.tolist() == [0, 1, 0, 1, 1] and offsets.tolist() == [0, 0, 6, 5, 8]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 33), max_size=80))
def test_best_fit_equals_a_plain_one(lengths):
    room, bins, offsets = [], {}, {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fit = [b for b, r in enumerate(room) if r >= lengths[i]]
        best = min((room[b] for b in fit), default=None)
        if best is None:
            room.append(33)
        # bins of equal room are alike: compare the rooms that are chosen
        b = next(b for b in range(len(room)) if room[b] == (best or 33) and room[b] >= lengths[i])
        bins[i], offsets[i] = b, 33 - room[b]
        room[b] -= lengths[i]
    got, at = packing.best_fit(np.array(lengths, np.int64), 33)
    assert len(set(got.tolist())) == len(room)
    assert [at[i] for i in range(len(lengths))] == [offsets[i] for i in range(len(lengths))]


def check_packing(rows, texts, width):
    pieces = defaultdict(list)
    for i, ids in zip([i for i, _ in texts], library([t for _, t in texts], WORD), strict=True):
        ids = [*ids, 0]
        for p in range(-(-len(ids) // width)):
            part = ids[p * width:(p + 1) * width]
            pieces[i, p, p * width, len(part), zlib.crc32(np.array(part, "<u4").tobytes())].append(1)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == Counter(
        {k: len(v) for k, v in pieces.items()})
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for place in places.values():
        end = 0
        for offset, length in sorted(place):
            assert offset == end
            end += length
        assert end <= width
    return places


def test_packing_of_edge_rows(edge, nothing):
    def packed(docs, **more):
        found = packing.token_pieces(docs, WORD, width=64)
        return packing.pack(found.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), width=64, **more)

    places = check_packing(packed(edge).collect(), EDGE, 64)
    total = sum(n for p in places.values() for _, n in p)
    assert len(places) <= -(-total // 64) + 1
    check_packing(packed(edge, group=100).collect(), EDGE, 64)
    assert packed(nothing).count() == 0


def test_packing_of_lengths(spark):
    rows = spark.createDataFrame([(1, 3), (2, None), (3, 10)], "id long, length long")
    got = {r.id: (r.sequence_id, r.offset) for r in packing.pack(rows, width=10).collect()}
    assert got[2] == (None, None) and got[1][1] == got[3][1] == 0 and got[1] != got[3]
    with pytest.raises(Exception, match="lengths must be"):
        packing.pack(spark.createDataFrame([(1, 11)], "id long, length long"), width=10).collect()


def test_long_white_space_is_encoded_as_by_the_library(spark, tmp_out):
    texts = [" " * 2_000_000 + "x", "a\n" + "\n" * 2_000_000, "\t " * 600_000 + "<|endoftext|>é", "short"]
    want = library(texts, BYTE)
    assert [records.ids_of(t, BYTE).tolist() for t in texts] == want
    folder = f"file://{tmp_out}/white"
    records.write_records(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), folder, BYTE, end_id=2)
    rows = records.read_records(spark, folder).collect()
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in rows} == {i: [*x, 2] for i, x in enumerate(want)}


def test_frames_show_damage():
    data = records.frame(b"payload")
    assert records.unframe(data) == b"payload"
    for i in range(len(data)):
        with pytest.raises(ValueError, match="damaged"):
            records.unframe(data[:i] + bytes([data[i] ^ 1]) + data[i + 1:])


@pytest.mark.parametrize("size", [1, 32 << 20])
def test_record_files_of_edge_rows(spark, edge, nothing, tmp_out, size):
    folder = f"file://{tmp_out}/r"
    records.write_records(edge, folder, BYTE, end_id=2, shard_bytes=size)
    rows = records.read_records(spark, folder).orderBy("start").collect()
    want = Counter((i, tuple([*x, 2])) for (i, _), x in zip(EDGE, library([t for _, t in EDGE], BYTE), strict=True))
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in rows) == want
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist()
    keys = [r.doc_id for r in rows]
    assert keys[:2] == [None, None] and keys[2:] == sorted(keys[2:])
    records.write_records(nothing, folder + "0", BYTE, end_id=2)
    assert records.read_records(spark, folder + "0").count() == 0
