"""Conversation repair against a search of all edits and a plain table of costs."""

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from lexiflow.llm import conversation_repair as C
from lexiflow.llm.queries import damaged, op13_conversation_repair
from tests.conftest import SF001

RIGHT = re.compile(r"(s?(ua)+)?")
WHITE = re.compile(r"[^\x20\x09-\x0D]")


def plain_repair(rows):
    """Best first over (rows done, roles so far's state), each edit by itself; rows: (role, text, fault)."""
    heap, seen, tie = [(0, "", 0, "", ())], {}, itertools.count()
    heap = [(0, "", next(tie), 0, "", ())]
    while heap:
        cost, audit, _, i, roles, out = heapq.heappop(heap)
        state = (i, roles[-1:])
        if seen.get(state, (1 << 30, ""))[:2] <= (cost, audit) and state in seen:
            continue
        if i == len(rows) and RIGHT.fullmatch(roles):
            return cost, audit, "\n".join(out)
        seen[state] = (cost, audit)

        def go(c, mark, j, r, o, cost=cost, audit=audit):
            if re.fullmatch(r"s?(ua)*u?", r):
                heapq.heappush(heap, (cost + c, audit + mark, next(tie), j, r, o))

        if roles[-1:] != "x":
            for new in ("user", "assistant"):
                go(5, "I", i, roles + new[0], (*out, new + ":"))
        if i < len(rows):
            role, text, fault = rows[i]
            go(2, "D", i + 1, roles, out)
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                if role[:1] in ("s", "u", "a"):
                    go(more, "K", i + 1, roles + role[0], (*out, f"{role}:{text}"))
                for new in ("user", "assistant"):
                    go(1 + more, "R", i + 1, roles + new[0], (*out, f"{new}:{text}"))


def plain_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        end = WHITE.findall(text)
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def plain_summary(rows):
    """rows: (turn, role, text) in order."""
    if not rows:
        return 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()
    faults = plain_faults([r[1:] for r in rows])
    turns = {t for t, _, _ in rows if t is not None}
    n = lambda f: sum(x[2] == f for x in faults)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))  # noqa: B905
    cost, audit, text = plain_repair(faults)
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, n("blank"), n("duplicate"), n("truncated"),
            illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def in_order(rows):
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r[2])))


def test_audits_of_all_short_conversations():
    kinds = [("system", None), ("user", None), ("assistant", None), ("tool", None), ("user", "truncated"), ("user", "blank")]
    letter = lambda r, f: "-" if f == "blank" else {"s": "s", "u": "u", "a": "a"}.get(r[0], "o").upper() if f else \
        {"s": "s", "u": "u", "a": "a"}.get(r[0], "o")
    for n in range(5):
        for rows in itertools.product(kinds, repeat=n):
            codes = "".join(letter(*r) for r in rows)
            tables = [C.row_table(c) for c in codes.replace("-", "")]
            q = C.last_state(C.forward(tables, 0, len(tables), C.EMPTY)[0])
            audit = "".join(C.edits(codes, C.EMPTY, q)) + C.tail(q)
            assert audit == plain_repair([(r, "x", f) for r, f in rows])[1], rows


@pytest.mark.parametrize("size", [1, 2, 7, 64])
def test_blocks_meet_as_one_conversation(size):
    rng = random.Random(size)
    for _ in range(60):
        codes = "".join(rng.choice("suaoSUAO-uaua") for _ in range(rng.randrange(1, 90)))
        tables = [C.row_table(c) for c in codes.replace("-", "")]
        q = C.last_state(C.forward(tables, 0, len(tables), C.EMPTY)[0])
        want = C.edits(codes, C.EMPTY, q)
        blocks = [codes[i:i + size] for i in range(0, len(codes), size)]
        parts = [C._table(C._flat(C.combined([C.row_table(c) for c in b.replace("-", "")]))) for b in blocks]
        end = C.last_state(C.forward(parts, 0, len(parts), C.EMPTY)[0])
        states = C.crossings(parts, C.EMPTY, end)
        assert (end, [e for b, p, s in zip(blocks, states, states[1:]) for e in C.edits(b, p, s)]) == (q, want)  # noqa: B905


def test_a_long_conversation_against_a_table_of_costs():
    rng = random.Random(5)
    rows = [(rng.choice(["user", "assistant", "user", "system", "bot"]), str(i), rng.choice([None, None, "truncated", "blank"]))
            for i in range(3000)]
    codes = "".join("-" if f == "blank" else (r[0] if r[0] in "sua" else "o").upper() if f else (r[0] if r[0] in "sua" else "o")
                    for r, _, f in rows)
    tables = [C.row_table(c) for c in codes.replace("-", "")]
    (costs, ranks), base = C.forward(tables, 0, len(tables), 0)
    q = C.last_state((costs, ranks))
    found = C.edits(codes, C.EMPTY, q)
    price = {"K": 0, "R": 1, "D": 2, "I": 5}
    cost = sum(price[m] for e in found for m in e) + 5 * len(C.tail(q)) + sum(
        5 for e, (_, _, f) in zip(found, rows, strict=True) if f == "truncated" and e != "D")
    want = plain_repair(rows)
    assert (cost, "".join(found) + C.tail(q)) == want[:2]
    assert cost == base + costs[q] + 5 * len(C.tail(q)) + 2 * codes.count("-")


KIND = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                     T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
EDGE = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes!"), (2, 0, "assistant", "Alone."), (3, None, "user", "First?"),
        (3, None, "assistant", "Then."), (3, 5, "user", None), (3, 9, None, "Who."), (None, 0, "system", "Rules."),
        (None, 1, "user", "cut"), (None, 2, "assistant", "Fine. \n"), (4, 0, "user", "\t\n \x0b"), (5, 3, "", "No role."),
        (6, 0, "user", "Long " * 200_000 + "."), (7, 1, "user", "Same."), (7, 1, "user", "Same."), (7, 2, "user", "Same."),
        (7, 3, "assistant", "Ok."), (8, 0, "system", "Only."), (9, 1, "assistant", "é! "), (9, 0, "user", "ü?")]


def summary_of(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def test_edge_rows(spark):
    rows = spark.createDataFrame(EDGE, KIND)
    for c in ("conv", "at", "nth", "edit", "fault", "copies", "digest", "block", "rows", "p", "q", "ends", "op"):
        rows = rows.selectExpr("*", f"'x' as `{c}`")
    edited = C.repair(rows)
    convs = defaultdict(list)
    for k, t, r, x in EDGE:
        convs[k].append((t, " " if r is None else r, " " if x is None else x))
    assert summary_of(C.summarise(edited)) == {k: plain_summary(in_order(v)) for k, v in convs.items()}
    kept = [r for r in edited.where("edit <> 'Delete' and conv_id = 9").orderBy("at", "nth").collect()]
    assert [(r.role, r.text, r.edit) for r in kept] == [("user", "ü?", "Keep"), ("assistant", "é! ", "Keep")]
    assert C.summarise(C.repair(rows.limit(0))).count() == 0


def test_a_conversation_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_BITS", 3)
    rng = random.Random(3)
    rows = [(1, i, rng.choice(["user", "assistant", "tool", "system"]), rng.choice(["Yes.", "No", "", f"t{i}."])) for i in range(400)]
    rows += [(1, 400, "user", "Again.")] * 50 + [(2, i, "user", "x.") for i in range(9)]
    convs = defaultdict(list)
    for k, *rest in rows:
        convs[k].append(tuple(rest))
    found = summary_of(C.summarise(C.repair(spark.createDataFrame(rows, KIND).repartition(7))))
    assert found == {k: plain_summary(in_order(v)) for k, v in convs.items()}


def plain_damage(k, t, r, x):
    r, x = " " if r is None else r, " " if x is None else x
    case = zlib.crc32(f"{' ' if k is None else k}:{' ' if t is None else t}".encode()) % 20
    if case == 0:
        return []
    row = (t, "user" if case == 4 else r, "" if case == 1 else re.sub("[.!?]", "", x) if case == 2 else x)
    return [row] * (2 if case == 3 else 1)


def test_the_query(spark, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(100_000 + k, t, r, x) for k, t, r, x in EDGE if k is not None] + EDGE[7:10]
    rows += [(10**6 + i, 0, "user", "Gone or not.") for i in range(60)]
    spark.createDataFrame(rows, KIND).write.parquet(f"{tmp_path}/conversations.parquet")
    convs = defaultdict(list)
    for row in rows:
        convs[row[0]] += plain_damage(*row)
    assert any(not v for v in convs.values())
    got = op13_conversation_repair(spark, str(tmp_path))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert summary_of(got) == {k: plain_summary(in_order(v)) for k, v in convs.items()}
    assert damaged(spark.createDataFrame([], KIND)).count() == 0
