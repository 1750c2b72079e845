"""Packing by least squares over the histogram: the plan by itself, then whole tables against tokenizers."""

import itertools
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lexiflow.llm import histogram_packing as P
from lexiflow.llm.queries import op11_nnls_packing
from tests.conftest import SF001

from .conftest import EDGE

BYTE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize(("lengths", "width"), [(range(1, 17), 16), ([1, 3, 4, 8, 12, 13, 16], 16), ([5], 16), ([], 16), ([8], 16)])
def test_all_shallow_combinations(lengths, width):
    want = {tuple(sorted(c, reverse=True) + [0] * (3 - n)) for n in (1, 2, 3)
            for c in itertools.combinations_with_replacement(lengths, n) if sum(c) == width}
    got = [tuple(r) for r in P.combinations(np.array(lengths, int), width).tolist()]
    assert set(got) == want and len(got) == len(want)


def test_least_squares_finds_an_exact_mix():
    wanted = np.zeros(65)
    ways = np.array([[40, 24, 0], [50, 10, 4], [32, 32, 0], [30, 24, 10], [64, 0, 0]])
    for way, n in zip(ways, (7, 11, 3, 0, 5), strict=True):
        for length in way[way > 0]:
            wanted[length] += n
    x = P.least_squares(ways, wanted)
    assert np.abs(x - [7, 11, 3, 0, 5]).max() < 1e-3
    # As a plain projected gradient of very small steps has it, where no mix is exact.
    wanted[24] += 9
    a = np.zeros((65, 5))
    for j, way in enumerate(ways):
        for length in way[way > 0]:
            a[length, j] += 1
    y = np.zeros(5)
    for _ in range(20_000):
        y = np.maximum(0, y - 0.05 * a.T @ (a @ y - wanted))
    assert np.abs(P.least_squares(ways, wanted) - y).max() < 1e-3


def check_plan(wanted, width):
    plan = P.solve(wanted, width)
    ranks = np.random.default_rng(0).permutation(int(wanted.sum()))
    own = np.repeat(np.arange(width + 1), wanted)[ranks]
    which, from_, length, sequence, offset = P.places(plan, ranks, width)
    pieces, places = defaultdict(list), defaultdict(list)
    for w, f, n, s, o in zip(which.tolist(), from_.tolist(), length.tolist(), sequence.tolist(), offset.tolist(), strict=True):
        pieces[w].append((f, n))
        places[s].append((o, n))
    assert len(pieces) == len(ranks)
    for w, parts in pieces.items():
        assert [f for f, _ in sorted(parts)] == [0, *np.cumsum([n for _, n in sorted(parts)])[:-1].tolist()]
        assert sum(n for _, n in parts) == own[w]
    for parts in places.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1].tolist()]
    sizes = sorted(sum(n for _, n in parts) for parts in places.values())
    short = [n for n in sizes if n < width]
    assert max(sizes, default=0) <= width and len(set(short)) == len(short) and all(n & (n - 1) == 0 for n in short)
    return plan, places


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=60))
def test_places_of_any_histogram(lengths):
    check_plan(np.bincount(lengths, minlength=33) if lengths else np.zeros(33, int), 32)


def test_combinations_hold_most_of_a_smooth_histogram():
    rng = np.random.default_rng(7)
    wanted = np.bincount(rng.integers(1, 2049, 20_000), minlength=2049)
    plan, places = check_plan(wanted, 2048)
    cut = plan.stream / (wanted * np.arange(2049)).sum()
    assert cut < 0.2, cut
    # Lengths that cannot meet exactly are cut.
    plan, _ = check_plan(np.bincount([1500] * 1000, minlength=2049), 2048)
    assert plan.sequences == 0 and plan.stream == 1_500_000


def check_rows(rows, texts):
    """``rows`` (key, start, length, crc, doc_tokens, sequence, offset); ``texts`` by key."""
    library = Tokenizer.from_file(BYTE)
    ids = {k: [np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for t in ts] for k, ts in texts.items()}
    found, places = defaultdict(list), defaultdict(list)
    for k, start, n, crc, tokens, seq, offset in rows:
        assert any(len(x) == tokens and start + n <= tokens and zlib.crc32(x[start:start + n].tobytes()) == crc for x in ids[k])
        found[k].append((start, n))
        places[seq].append((offset, n))
    for k, parts in found.items():
        want = sorted(i for x in ids[k] for i in range(len(x)))
        assert sorted(i for a, n in parts for i in range(a, a + n)) == want
    assert found.keys() == ids.keys()
    for parts in places.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1].tolist()]
        total = sum(n for _, n in parts)
        assert total == 2048 or total < 2048 and total & (total - 1) == 0


def rows_of(df):
    return [(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens, r.sequence_id, r.offset) for r in df.collect()]


def test_edge_rows(spark, edge, nothing):
    from pyspark.sql import functions as F
    found = P.pack(edge, BYTE, 1).withColumn("ids_crc32", F.crc32("ids"))
    texts = defaultdict(list)
    for k, t in EDGE:
        texts[k].append(t)
    check_rows(rows_of(found), texts)
    assert all(len(r.ids) == 4 * r.length for r in found.collect())
    assert P.pack(nothing, BYTE, 1).count() == 0


def test_the_query(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    texts = {r.doc_id: [r.text] for r in docs.collect()}
    found = op11_nnls_packing(spark, SF001)
    assert found.columns == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32"]
    check_rows(rows_of(found), texts)
