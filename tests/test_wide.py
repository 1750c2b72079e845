"""Running totals and draws of contexts with very many choices."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from lexiflow.operators import chars as CH
from lexiflow.operators import sampling as R
from lexiflow.operators import wide as W
from lexiflow.sources.files import rows


def test_as_the_narrow_operators(spark):
    data = [("a", f"n{i:03d}", i % 7 + 1) for i in range(300)] + [("b", "x", 5), ("c", "é", 2), ("c", "z", 0)]
    trans = rows(spark, data, "ch string, next_ch string, n long").repartition(5)
    want = {tuple(r) for r in R.cumulate(trans.where("n > 0")).collect()}
    assert {tuple(r) for r in W.cumulate_wide(trans).collect()} == want
    asked = rows(spark, [(i, c) for i in range(200) for c in ("a", "b", "c", "nowhere", None)], "req_id long, ch string")
    want = sorted(map(repr, R.draw(asked, trans.where("n > 0")).collect()))
    assert sorted(map(repr, W.draw_wide(asked, trans).collect())) == want
    assert W.draw_wide(asked.limit(0), trans).count() == 0
    assert W.draw_wide(asked.limit(3), trans.limit(0)).where("r is null and drawn is null").count() == 3


def test_a_context_of_a_million_choices(spark):
    n = 1_000_000
    count = F.when(F.col("id") == 777, F.lit(5_000_000)).otherwise(F.col("id") % 3 + 1)
    trans = spark.range(n).select(F.lit("w").alias("ch"), F.format_string("%07d", "id").alias("next_ch"), count.alias("n"))
    cum = np.cumsum(np.where(np.arange(n) == 777, 5_000_000, np.arange(n) % 3 + 1))
    sizes = W.choice_blocks(trans).select(F.size("_choices").alias("n")).agg(F.max("n"), F.count("*"), F.sum("n")).collect()[0]
    assert sizes[0] <= 64 and sizes[1] >= n // 64 and sizes[2] == n
    asked = spark.range(2000).select(F.col("id").alias("req_id"), F.lit("w").alias("ch"))
    got = W.draw_wide(asked, trans).collect()
    for r in got:
        h = int(hashlib.md5(f"12345:{r.req_id}".encode()).hexdigest()[:8], 16) % int(cum[-1])
        assert (r.r, int(r.drawn)) == (h, int(np.searchsorted(cum, h, "right")))
    assert len(got) == 2000


def test_followers_are_the_transitions(spark):
    """Counted where the arrays are read: as the rows of the pairs, over batches, with nulls and empty arrays."""
    words = [f"w{i * i % 97}" if i % 5 else None for i in range(300)]
    data = [(words[i:i + i % 7],) for i in range(290)] + [(None,), ([],), (["é"],), (["é", "z", "é", "z"],)] * 3
    df = rows(spark, data, "tokens array<string>").repartition(3)
    pairs = rows(spark, [(a, b) for (t,) in data for a, b in zip(t or [], (t or [])[1:])], "word string, next_word string")
    want = {tuple(r) for r in R.cumulate(CH.transitions(pairs, "word", "next_word"), "word", "next_word").collect()}
    got = W.cumulate_wide(W.count_followers(df, "tokens"), "word", "next_word").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert W.cumulate_wide(W.count_followers(df.limit(0), "tokens")).count() == 0


def test_contexts_that_go_over_many_parts(spark, monkeypatch):
    """Contexts inside a part need no look-up: only those at its edges are joined, and none by a shuffle."""
    monkeypatch.setattr(W, "PART", W.RUN)
    n = 300_000
    ctx = F.when(F.col("id") % 3 == 0, F.lit("wide")).when(F.col("id") % 3 == 1, F.concat(F.lit("x"), F.col("id") % 500))
    trans = spark.range(n).select(ctx.alias("ch"), F.format_string("%06d", "id").alias("next_ch"), (F.col("id") % 4).alias("n"))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, "-1")
    try:
        done = W.cumulate_wide(trans.repartition(2))
        assert "SortMergeJoin" not in done._jdf.queryExecution().executedPlan().toString()
        got = done.collect()
    finally:
        spark.conf.unset(threshold)
    assert sorted(map(repr, got)) == sorted(map(repr, R.cumulate(trans.where("n > 0")).collect()))
    blocks = W.choice_blocks(trans.repartition(2)).where("ctx = 'wide'")
    assert blocks.select("_blocks").distinct().count() == 1 and blocks.count() == blocks.first()._blocks
