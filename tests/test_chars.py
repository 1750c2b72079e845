"""Character chunks, pairs, transitions, draws and generation."""

import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexiflow.conf import CharConf
from lexiflow.functions.charset import CHARSET, char_id, chars_of
from lexiflow.operators import chars as CH
from lexiflow.operators import sampling as R
from lexiflow.sources.files import rows


def test_charset_is_fixed():
    assert len(CHARSET) == 77 and CHARSET[0] == "a" and CHARSET[-1] == "\t"


def test_chunk_edges(spark):
    L = 10
    lengths = [0, L - 1, L, L + 1, 2 * L, 2 * L + 1]
    df = rows(spark, [(i, "x" * n) for i, n in enumerate(lengths)] + [(9, None)], "doc_id long, text string")
    got = {r.doc_id: r.n for r in CH.chunk_text(df, L).groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert [got.get(i, 0) for i in range(6)] == [0, 1, 1, 2, 2, 3] and 9 not in got
    # the loop's bounds: full chunks only, and none that ends at the end
    exact = CH.chunk_text(df, L, keep_tail=False)
    got = {r.doc_id: r.n for r in exact.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert [got.get(i, 0) for i in range(6)] == [0, 0, 0, 1, 1, 2]
    assert all(len(r.text) == L for r in exact.collect())


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab \n😀é", max_size=30), max_size=6), st.integers(1, 9))
def test_chunks_add_up_to_the_text(spark, texts, length):
    df = rows(spark, list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in sorted(CH.chunk_text(df, length).collect(), key=lambda r: r.chunk):
        got[r.doc_id] = got.get(r.doc_id, "") + r.text
    assert got == {i: t for i, t in enumerate(texts) if t}


def test_pair_edges(spark):
    df = rows(spark, [(i, "abc"[:n]) for i, n in enumerate([0, 1, 2, 3])], "doc_id long, text string")
    got = sorted((r.doc_id, r.pos, r.ch, r.next_ch) for r in CH.char_pairs(df).collect())
    assert got == [(2, 0, "a", "b"), (3, 0, "a", "b"), (3, 1, "b", "c")]
    assert [tuple(r) for r in CH.char_pairs(df, keep_tail=False).collect()] == [(3, 0, "a", "b")]


def test_non_bmp_code_points(spark):
    df = rows(spark, [(0, "a😀bc")], "doc_id long, text string")
    pairs = [(r.ch, r.next_ch) for r in CH.char_pairs(df).orderBy("pos").collect()]
    assert pairs == [("a", "😀"), ("😀", "b"), ("b", "c")]


def test_filter_charset(spark):
    df = rows(spark, [(0, "Héllo, wörld!\t😀\n")], "doc_id long, text string")
    assert CH.filter_charset(df).collect()[0].text == "Hllo, wrld!\t\n"


def test_cumulative_end_is_total(spark):
    t = rows(spark, [("a", "b", 2), ("a", "c", 3), ("b", "a", 1)], "ch string, next_ch string, n long")
    c = R.cumulate(t).collect()
    for r in c:
        if r.next_ch == max(x.next_ch for x in c if x.ch == r.ch):
            assert r.cum == r.total


def test_draw_edges(spark):
    t = rows(spark, [("a", "b", 2), ("a", "c", 3), ("a", "d", 1)], "ch string, next_ch string, n long")
    cdf = R.cdf_table(t).collect()[0]
    assert cdf.total == 6 and [x.cum for x in cdf.choices] == [2, 5, 6]
    choices = F.array(*[F.struct(F.lit(x.cum).alias("cum"), F.lit(x.next_ch).alias("next_ch"))
                        for x in cdf.choices])
    req = rows(spark, [(r,) for r in [0, 1, 2, 5]], "r long")
    picks = [r.p for r in req.select(R.pick_choice(choices, F.col("r")).alias("p")).collect()]
    # draw 0 and n1-1 -> first; n1 -> second; total-1 -> last
    assert picks == ["b", "b", "c", "d"]


def test_draw_keeps_requests_without_a_transition(spark):
    t = rows(spark, [("a", "b", 2)], "ch string, next_ch string, n long")
    req = rows(spark, [("1", "a"), ("2", "z"), ("3", None)], "req_id string, ch string")
    got = {r.req_id: (r.r is None, r.drawn) for r in R.draw(req, t).collect()}
    assert got == {"1": (False, "b"), "2": (True, None), "3": (True, None)}


def test_generation_stops_without_successor(spark):
    t = rows(spark, [("a", "b", 1)], "ch string, next_ch string, n long")
    seeds = rows(spark, [(0, "a"), (1, "z"), (2, "xya"), (3, "")], "doc_id long, seed_ch string")
    got = {r.doc_id: r.generated for r in R.generate(seeds, t, steps=5).collect()}
    assert got == {0: "ab", 1: "z", 2: "xyab", 3: ""}


def test_samples_of_a_prefix_differ_and_repeat(spark):
    t = rows(spark, [(a, b, 1) for a in "abcd" for b in "abcd"], "ch string, next_ch string, n long")
    seeds = R.sample_seeds(rows(spark, [(0, "ab")], "doc_id long, p string"), CharConf().samples)
    key = F.concat_ws("/", F.col("doc_id").cast("string"), F.col("sample").cast("string"))
    runs = [{r.sample: r.generated for r in R.generate(seeds, t, 30, key=key, start="p").collect()} for _ in range(2)]
    assert runs[0] == runs[1] and len(set(runs[0].values())) == CharConf().samples == 4
    assert all(x.startswith("ab") and len(x) == 32 for x in runs[0].values())


def test_generation_refuses_other_characters(spark):
    t = rows(spark, [("a", "é", 1)], "ch string, next_ch string, n long")
    with pytest.raises(Exception, match="character set"):
        R.generate(rows(spark, [(0, "a")], "doc_id long, seed_ch string"), t, 3).collect()


def test_characters_without_a_regex_and_ids_without_a_join(spark):
    texts = ["a\U0001F600b\n", "", None, "x", "\r\né\0z"]
    df = rows(spark, list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.a for r in df.select("doc_id", chars_of("text").alias("a")).collect()}
    assert got == {i: None if t is None else list(t) for i, t in enumerate(texts)}
    cells = CH.one_hot_chars(CH.char_pairs(df))
    plan = cells._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "Join" not in plan
    # Only "b\n" has both characters in the set.
    assert sorted((r.doc_id, r.pos, r.tensor, r.char_id) for r in cells.collect()) == [(0, 2, "features", 1), (0, 2, "labels", 75)]
    assert [r.id for r in rows(spark, [(c,) for c in [*CHARSET, "é", "#", "", "ab", None]], "ch string").select(
        char_id("ch").alias("id")).collect()] == [*range(77), None, None, None, None, None]


def test_counted_pairs_are_the_exploded_ones(spark):
    texts = rows(spark, [(1, "abab é中😀"), (1, "ab"), (2, "a"), (3, ""), (None, None), (4, "aab" * 50)], "doc_id long, text string")
    for tail in (True, False):
        want = sorted(map(tuple, CH.transitions(CH.char_pairs(texts, keep_tail=tail)).collect()))
        assert sorted(map(tuple, CH.count_pairs(texts, keep_tail=tail).collect())) == want


def test_generation_sends_no_model_with_its_rows(spark):
    """The totals are no column of the rows; nulls and dead ends as they are."""
    t = rows(spark, [("a", "b", 2), ("a", "c", 1), ("b", "a", 3)], "ch string, next_ch string, n long")
    seeds = rows(spark, [(1, "xa"), (None, "a"), (2, None), (3, ""), (4, "é"), (5, "c")], "doc_id long, seed_ch string")
    made = R.generate(seeds, t, 9)
    assert "aggregate(" not in made._jdf.queryExecution().executedPlan().toString()
    got = {r.doc_id: r.generated for r in made.collect()}
    for key, text in ((1, "xa"), (None, "a")):
        for i in range(1, 10):
            h = int(hashlib.md5(f"12345:{'' if key is None else key}:{i}".encode()).hexdigest()[:8], 16)
            text += {"a": "bbc"[h % 3], "b": "a", "c": ""}[text[-1]]
        assert got[key] == text
    assert [got[k] for k in (2, 3, 4, 5)] == [None, "", "é", "c"]
