"""Line dedup, SimHash, embeddings and top-k against brute force."""

import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexiflow.llm import itq, simhash, topk
from lexiflow.llm.components import components
from lexiflow.llm.line_dedup import dedup_lines, with_chunks
from tests.conftest import SF01

from .conftest import EDGE


def roots(n, pairs):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (None, 3), (60, 61)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)} | {60: 60, 61: 60}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def chunks(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, __text string")
    return {r.i: r["__chunks"] for r in with_chunks(rows).collect()}


def test_chunks_cover_the_text_and_resist_shifts(spark):
    lines = [f"line number {i * i % 97}" for i in range(60)]
    found = chunks(spark, ["\n".join(lines), "\n".join(["new", "lines", *lines]), None, "", "a", "a\nb\nc"])
    for i in (0, 1):
        assert all(c.n >= 2 for c in found[i])
        # A chunk ends with the first line of the next one.
        assert [c.start for c in found[i]] == np.cumsum([0, *(c.n - 1 for c in found[i])])[:-1].tolist()
        assert [c.low for c in found[i]][1:] == [c.start for c in found[i]][:-1]
        assert [c.high for c in found[i]][:-1] == [c.start + c.n - 1 for c in found[i]][1:]
    assert "\n".join([found[0][0].body, *(c.body.split("\n", 1)[1] for c in found[0][1:])]) == "\n".join(lines)
    bodies = [{c.body for c in found[i]} for i in (0, 1)]
    assert len(bodies[0] & bodies[1]) >= len(bodies[0]) - 2
    assert found[2] is None and [c.body for c in found[3]] == [""] and not found[3][0].counts and not found[4][0].counts
    assert found[5][0].start == 0 and found[5][-1].start + found[5][-1].n == 3


def test_a_shared_passage_is_removed_once(docs_of):
    passage = [f"shared {i * 7 % 31} passage line of some words {i}" for i in range(30)]
    own = {i: [f"own {i} {j * 11 % 17}" for j in range(9)] for i in (1, 2, 3)}
    docs = docs_of([(i, "\n".join(own[i][:4] + passage + own[i][4:])) for i in own])
    out = {r.doc_id: r for r in dedup_lines(docs).collect()}
    assert out[1].removed_lines == 0
    for i in (2, 3):
        left = out[i].text.split("\n")
        assert [x for x in left if x.startswith("own")] == own[i]
        assert not any(x in passage for x in left)
        assert out[i].n_chars == len(out[i].text) and out[i].removed_lines + len(left) == 39


@pytest.mark.parametrize("size, share", [(2, 0.5), (3, 0.9), (4, 0.95), (6, 0.98), (8, 0.99)])
def test_short_passages_are_found(docs_of, size, share):
    """Passages of a few lines, each in two documents of other lines, some of them paragraphs with blank lines between."""
    docs, gap = [], {0: "\n", 1: "\n\n"}
    for p in range(100):
        passage = [f"passage {p} says {i} in some words" for i in range(size)]
        for d in (2 * p, 2 * p + 1):
            own = [f"document {d} has {i} of its own" for i in range(10)]
            docs.append((d, gap[p % 2].join(own[:5] + passage + own[5:])))
    left = [r.text for r in dedup_lines(docs_of(docs)).collect()]
    assert all(sum(f"document {d} has {i} of its own" in t for t in left) == 1 for d in (0, 1, 198, 199) for i in range(10))
    copies = sum(t.count("passage") for t in left) - 100 * size
    assert 0 <= copies <= (1 - share) * 100 * size


def test_line_dedup_equals_a_plain_version(docs_of):
    from .test_pipeline import plain_line_dedup
    rng = np.random.default_rng(8)
    words = ["", " ", "-", *(f"w{i}" for i in range(9))]
    docs = {i: "\n".join(words[w] for w in rng.integers(0, len(words), rng.integers(1, 40))) for i in range(150)}
    docs |= {500: None, 501: "", 502: docs[3], 503: "x\nx\nx\nx", 504: "\n\n\n\n", 505: "y\nz\ny\nz\ny\nz"}
    got = {r.doc_id: r for r in dedup_lines(docs_of(list(docs.items()))).collect()}
    assert {i: r.text for i, r in got.items()} == plain_line_dedup(docs)
    assert got[502].text == "" and got[503].text == docs[503] and got[504].removed_lines == 0
    assert sum(r.removed_lines for r in got.values()) > 500


def test_documents_are_shuffled_once(spark):
    """Both joins with whole documents read the same exchange."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = dedup_lines(spark.read.parquet(f"{SF01}/documents.parquet"))
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "ReusedExchange" in plan


def test_documents_that_repeat_a_passage_a_thousand_times(docs_of, monkeypatch):
    from lexiflow.llm import line_dedup
    monkeypatch.setattr(line_dedup, "SHARED", 64)
    docs = [(i, f"head {i}\nfirst of all\nsecond of all\nthird of all\ntail {i}") for i in range(1000)]
    docs += [(7, docs[7][1])] * 300
    left = Counter((r.doc_id, r.text) for r in dedup_lines(docs_of(docs)).collect())
    want = Counter({(i, f"head {i}\ntail {i}"): 1 for i in range(1000)} | {(7, "head 7\ntail 7"): 301, docs[0]: 1})
    del want[0, "head 0\ntail 0"]
    assert left == want


def test_line_dedup_of_edge_rows(edge, nothing, docs_of):
    out = dedup_lines(edge).collect()
    assert Counter((r.doc_id, r.text) for r in out) == Counter((i, t) for i, t in EDGE)   # nothing of two lines repeats
    assert set(edge.columns) < set(dedup_lines(edge).columns)
    rows = [(3, "x\ny"), (1, "x\ny"), (1, "x\ny"), (2, "x\ny\nx\ny"), (None, "x\ny"), (4, "x"), (5, "x")]
    got = Counter((r.doc_id, r.text, r.removed_lines) for r in dedup_lines(docs_of(rows)).collect())
    assert got[None, "x\ny", 0] == 1 and got[1, "", 2] == 2 and got[3, "", 2] == 1 and got[4, "x", 0] == got[5, "x", 0] == 1
    assert dedup_lines(nothing).count() == 0


def plain_fingerprint(text, shingle=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    parts = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=50, deadline=None)
@given(st.text(alphabet="aAbé \t\n\x0b  İ.", max_size=60))
def test_fingerprints_are_the_plain_ones(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_chain_keys_lose_no_link():
    rng = np.random.default_rng(1)
    for tau in (1, 2, 3, 4, 6):
        keys = [np.uint64(m) for _, m in simhash.chain_keys(tau)]
        for _ in range(3000):
            bits = rng.choice(64, rng.integers(0, tau + 1), replace=False)
            x = np.uint64(sum(1 << int(b) for b in bits))
            assert any(x & k == 0 for k in keys)


def test_links_of_planted_distances(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**64, 60, dtype=np.uint64)
    fps = set(base.tolist())
    for b in base.tolist():
        for d in (1, 3, 4, 5, 6):
            fps.add(b ^ sum(1 << int(i) for i in rng.choice(64, d, replace=False)))
    fps = np.array(sorted(fps), np.uint64)
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if int(fps[i] ^ fps[j]).bit_count() <= 4]
    rows = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    got = {r.node: r.root for r in components(simhash.links(rows, 4)).collect()}
    signed = fps.view(np.int64).tolist()
    want = roots(len(fps), pairs)
    groups = {}
    for i, r in enumerate(want):
        groups.setdefault(r, []).append(signed[i])
    assert got == {x: min(g) for g in groups.values() if len(g) > 1 for x in g}


def test_hot_buckets_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rows = spark.createDataFrame([(i << 40,) for i in range(300)], "fp long")
    got = {r.node: r.root for r in components(simhash.links(rows, 4)).collect()}
    assert got == {i << 40: 0 for i in range(300)}


def test_simhash_of_the_table(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").where("doc_id < 400")
    given = docs.orderBy("doc_id").collect()
    fps = [plain_fingerprint(r.text) for r in given]
    want = roots(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    got = simhash.near_duplicates(docs).orderBy("doc_id").collect()
    assert [(r.doc_id, r.fingerprint, r.component_id) for r in got] == [
        (r.doc_id, f"{f:016x}", given[w].doc_id) for r, f, w in zip(given, fps, want, strict=True)]
    kept = {r.doc_id for r in simhash.keep_one(docs).collect()}
    assert kept == {given[w].doc_id for w in want}


def test_simhash_of_edge_rows(edge, nothing):
    got = Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(edge).collect())
    same, zero = f"{plain_fingerprint('same text here now'):016x}", "0" * 16
    assert got[5, same, 5] == 2 and got[6, same, 5] == 1 and got[None, same, 5] == 1
    assert got[1, zero, 1] == got[2, zero, 1] == got[3, zero, 1] == got[None, zero, 1] == 1
    assert sum(got.values()) == len(EDGE)
    assert simhash.near_duplicates(nothing).count() == simhash.keep_one(nothing).count() == 0
    kept = simhash.keep_one(edge)
    assert kept.columns == edge.columns
    # the null key comes first in both groups; the long text and the odd one stay
    assert Counter(r.doc_id for r in kept.collect()) == Counter([None, None, 4, 7])


VECTORS = "vec_id long, embedding array<float>, label int, k string, v string, node string"


def brute_links(rows, threshold=0.93):
    n = len(rows)
    pairs = []
    for i in range(n):
        for j in range(i):
            a, b = (rows[x] for x in (i, j))
            if a[2] is not None and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], np.float32).astype(float), np.array(b[1], np.float32).astype(float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                    pairs.append((i, j))
    return pairs


@pytest.mark.parametrize("block", [itq.BLOCK, 8])
def test_embedding_links(spark, monkeypatch, block):
    monkeypatch.setattr(itq, "BLOCK", block)
    rng = np.random.default_rng(8)
    rows = []
    for dim in (16, 64, 100):
        for _ in range(6):
            center = rng.standard_normal(dim)
            for _ in range(7):
                rows.append((len(rows), (center + rng.standard_normal(dim) * rng.choice([0.02, 0.1, 0.2])).tolist(),
                             int(rng.integers(0, 2)), "x", "x", "x"))
    rows += [(len(rows) + i, rows[3][1], rows[3][2], "x", "x", "x") for i in range(3)]
    pairs = brute_links(rows)
    degree, want = Counter(x for p in pairs for x in p), roots(len(rows), pairs)
    got = {r.vec_id: r for r in itq.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()}
    found = sum(r.n_links for r in got.values())
    assert found >= 0.97 * 2 * len(pairs)            # the tables may miss a link at the threshold
    assert all(got[i].n_links <= degree[i] for i in got)
    if found == 2 * len(pairs):
        assert [got[i].component_id for i in range(len(rows))] == want


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(300):                             # pairs just above 0.93, the hardest ones
        a, b = rng.standard_normal((2, 64))
        a /= np.linalg.norm(a)
        b -= a * (a @ b)
        b /= np.linalg.norm(b)
        for v in (a, 0.935 * a + np.sqrt(1 - 0.935**2) * b):
            rows.append((len(rows), v.tolist(), 1, "x", "x", "x"))
    got = itq.near_duplicates(spark.createDataFrame(rows, VECTORS)).agg(F.sum("n_links")).first()[0]
    assert got >= 0.9 * 2 * len(brute_links(rows))


def test_embedding_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [], 1), (6, [0.0, 0.0], 1),
            (7, [1.0, None], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [1.0, 0.0], 2), (2, [2.0, 0.0], 1),
            (None, [1.0, 0.0], 1), (None, None, None), (11, [1.0], 1)]
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], VECTORS)
    got = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in itq.near_duplicates(df).collect())
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11, None)]
    assert got == Counter([(1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (None, 3, 1, False), *alone])
    assert itq.near_duplicates(df.where("1 = 0")).count() == 0


@pytest.mark.parametrize("blocks", [(1024, 8192), (3, 40)])
def test_top_k_of_the_table(spark, blocks):
    rows = spark.read.parquet(f"{SF01}/embeddings.parquet")
    whole = rows.select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * 1024)).alias("embedding"))
    got = topk.top_k(whole.where("vec_id % 100 = 0"), whole, 10, queries_block=blocks[0], candidates_block=blocks[1])
    given = rows.orderBy("vec_id").collect()
    ids = np.array([r.vec_id for r in given])
    x = np.floor(np.array([r.embedding for r in given], np.float64) * 1024).astype(np.int64)
    want = set()
    for i in np.flatnonzero(ids % 100 == 0):
        score = x @ x[i]
        best = [j for j in np.lexsort((ids, -score)) if j != i][:10]
        want |= {(int(ids[i]), n + 1, int(ids[j]), int(score[j])) for n, j in enumerate(best)}
    assert {tuple(r) for r in got.collect()} == want


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 30), st.integers(1, 6), st.integers(0, 2**31), st.booleans())
def test_branch_and_bound_equals_a_full_scan(n, dim, k, seed, whole):
    rng = np.random.default_rng(seed)
    x = rng.integers(-5, 6, (n, dim)) if whole else rng.standard_normal((n, dim))
    q, ids = (rng.integers(-5, 6, dim) if whole else rng.standard_normal(dim)), rng.permutation(n)
    got, score = topk.Vertical(ids, x, step=4).top(q, k, None)
    full = x @ q
    best = np.lexsort((ids, -full))[:k]
    assert np.allclose(score, full[best]) and (not whole or got.tolist() == ids[best].tolist())


def test_top_k_edge_rows(spark):
    rows = [(1, [1, 0]), (2, [5, 5]), (3, [5, 5]), (3, [5, 5]), (4, None), (5, [1, None]), (6, []), (None, [9, 9]),
            (7, [2, 0, 0]), (8, [2**31, 2**30])]
    df = spark.createDataFrame([(*r, "x", "x") for r in rows], "vec_id long, embedding array<bigint>, id string, v string")
    got = [tuple(r) for r in topk.top_k(df.where("vec_id in (1, 4, 7)"), df, 2).orderBy("rank").collect()]
    assert got == [(1, 1, 8, 2**31), (1, 2, 2, 5)]
    assert topk.top_k(df.where("1 = 0"), df).count() == topk.top_k(df, df.where("1 = 0")).count() == 0
    real = spark.createDataFrame([(1, [0.5, float("inf")]), (2, [0.5, 1.0]), (3, [1.0, float("nan")]), (4, [1.0, 1.0])],
                                 "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk.top_k(real, real).orderBy("query_id").collect()] == [(2, 1, 4, 1.5), (4, 1, 2, 1.5)]
