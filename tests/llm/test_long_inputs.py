"""Inputs that are few rows but long: words without a blank, unclosed markup, repeated rows."""

import random
import resource
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lexiflow.llm import bpe, html_extract, packing, token_counts, topk, transducer
from lexiflow.llm.encode import encoder
from lexiflow.llm.html_dom import Page

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def letters(n, seed=0):
    rng = random.Random(seed)
    some = ["the", "ing", "str", "qu", "x", "zz", "aaaa", "é", "tion"]
    return "".join(rng.choice(some) if rng.random() < 0.6 else rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))[:n]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_long_words_are_merged_as_by_the_library(path):
    library = Tokenizer.from_file(path)
    texts = [letters(300, 1), "a" * 1000, "ab" * 700 + "a", letters(20_000, 2), "short", letters(257, 3) + "\n" + "é" * 400, "x" * 257]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    ids, n = encoder(path).encode(pa.array(texts))
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == want
    assert token_counts.counter(path).count(pa.array(texts)).tolist() == [len(w) for w in want]


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="abcdeinrst", min_size=1, max_size=90))
def test_one_by_one_or_together(word):
    for path in (BYTE, WORD):
        b = bpe.load(path)
        ids, _ = b.merge_all([word.encode()])
        assert b.merge_long(word.encode()).tolist() == ids.tolist()


def test_a_megabyte_of_letters():
    text = letters(1 << 20, 5)
    b, library = bpe.load(BYTE), Tokenizer.from_file(BYTE)
    began = time.perf_counter()
    ids = b.merge_long(text.encode())
    assert time.perf_counter() - began < 15
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_long_words_stay_out_of_the_lexicon(spark):
    docs = spark.createDataFrame([(1, "word " + "y" * 100_000), (2, "word " + "ab" * 33)], "doc_id long, text string")
    name = transducer.build_lexicon(docs, WORD)
    assert int(transducer.lexicon(name).final.sum()) == 1
    library = Tokenizer.from_file(WORD)
    got = {r.doc_id: r.n_tokens for r in transducer.encode(docs, WORD, name).collect()}
    assert got == {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) for r in docs.collect()}


@pytest.mark.parametrize("html", ["<b><h2>x" * 100_000, "<b>" * 100_000 + "</i>" * 100_000,
                                  "<b><div>" + "<i>" * 100_000 + "</b>" * 100_000, "<table><tr><td>x" * 50_000, "<ul><li>a" * 50_000])
def test_markup_that_is_never_closed(html):
    began = time.perf_counter()
    page = Page(html)
    assert time.perf_counter() - began < 10
    assert len(page.tag) > 50_000


def test_ends_within_scopes():
    page = Page("<div><p>a<b>c<div>d</b>e</div></p>f<table><tr><td>x<td>y<tr><td>z</table><ul><li>1<ul><li>2</ul><li>3</ul>")
    shown = [(page.tag[i], page.tag[page.parent[i]]) for i in range(1, len(page.tag))]
    assert shown == [("div", "#page"), ("p", "div"), ("b", "p"), ("div", "div"), ("table", "div"), ("tr", "table"), ("td", "tr"),
                     ("td", "tr"), ("tr", "table"), ("td", "tr"), ("ul", "div"), ("li", "ul"), ("ul", "li"), ("li", "ul"), ("li", "ul")]
    assert page.text([True] * len(page.tag)).split("\n") == ["ac", "de", "f", "x", "y", "z", "1", "2", "3"]


def test_slices_of_a_large_page(monkeypatch):
    rng = random.Random(1)
    htmls = ["<html><body><nav><a href=/>menu item</a></nav><article>" + "".join(
        f"<p>{' '.join(rng.choices(['alpha', 'beta', 'gamma'], k=12))}</p>" for _ in range(30)) + "</article></body></html>" for _ in range(6)]
    model = html_extract.fit(htmls)
    want = html_extract.main_texts(htmls, model)
    monkeypatch.setattr(html_extract, "ELEMENTS", 7)
    assert html_extract.main_texts(htmls, model) == want and all(want)
    assert html_extract.main_texts([], model) == []


def test_memory_of_a_page_of_many_elements():
    page = "<p>a" * (1 << 18)                       # 1 MB
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    text = html_extract.main_texts([page], None)[0]
    assert len(text) == 2 * (1 << 18) - 1
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400 << 10


def test_repeated_rows_part(spark):
    pieces = spark.range(5000).selectExpr("cast(null as long) as doc_id", "0 as piece", "1L as length")
    rows = packing.pack(pieces, width=16, group=1000).collect()
    groups = Counter(r.sequence_id >> 40 for r in rows)
    assert len(groups) == 5 and max(groups.values()) < 1300
    assert Counter(Counter(r.sequence_id for r in rows).values())[16] >= 5000 // 16 - 5


def test_repeated_candidates_are_answers_each(spark):
    rows = spark.createDataFrame([(0, [1, 1]), (1, [2, 2]), (1, [2, 2]), (2, [1, 0]), *[(3, [0, 1])] * 9], "vec_id long, embedding array<bigint>")
    for blocks in ((1024, 8192), (1, 2)):
        got = topk.top_k(rows.where("vec_id = 0"), rows, 5, queries_block=blocks[0], candidates_block=blocks[1]).collect()
        assert sorted((r.rank, r.vec_id, r.score) for r in got) == [(1, 1, 4), (2, 1, 4), (3, 2, 1), (4, 3, 1), (5, 3, 1)]
