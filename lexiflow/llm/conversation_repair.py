"""Cheapest repair of the turn order of conversations, in linear space.

A conversation is right if its roles read ``(s?(ua)+)?``: nothing, or perhaps a
system turn, then user and assistant turns by turns.  A prefix of it is in one
of four states: empty, after the system turn, after a user, after an assistant.
Each row may be kept, given another role, or deleted, and empty turns may be
inserted; the cheapest edits are wanted, of these the ASCII-least audit (the
edits' initials in order).

Hirschberg's method: the cost vectors of the first half (from its known start
state) and of the second half (to its known end state) meet between two rows;
of the states of least total cost the one with the least audit before it is
crossed, and both halves are solved alike.  A block of rows is itself a table of
costs from state to state, so a long conversation is cut into blocks of many
tasks, and the same search first finds the states between the blocks.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, stored
from .common import small_batches

# Rows of a block: 2 to this power.
BLOCK_BITS = 12
# States: empty, after s, after u, after a.  What may come next where one turn is added.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
FAR = 1 << 40
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# Edits of one row with the turns inserted before it, in ASCII order.  None is the
# beginning of another, so rows of equal number are compared edit by edit; and a
# turn inserted before deleted rows is moved behind them, which is less.
EDITS = ("D", "IK", "IR", "K", "R")
BLANKS = " \t\n\x0b\x0c\r"

# For each state the ways on: (next state, cost, order among the ways of this state).
Table = tuple[tuple[tuple[int, int, int], ...], ...]
Vector = tuple[tuple[int, ...], tuple[int, ...]]


@functools.cache
def row_table(code: str) -> Table:
    """The ways through one row.  ``code``: the role's initial (``s``, ``u``, ``a``
    or ``o`` for others), in upper case if the text is truncated."""
    extra = TRUNCATED * code.isupper()
    keeps = {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(code.lower())
    table = []
    for p in range(4):
        ways = [(p, DELETE, 0)]
        nxt = NEXT[p]
        if keeps == SYSTEM:
            ways += [(SYSTEM, extra, 3)] * (p == EMPTY)
        elif keeps is not None:
            ways.append((keeps, extra, 3) if nxt == keeps else (keeps, INSERT + extra, 1))
        ways += [(nxt, REROLE + extra, 4), (NEXT[nxt], INSERT + REROLE + extra, 2)]
        table.append(tuple(ways))
    return tuple(table)


def begin(p: int) -> Vector:
    """Costs of the four states, and the rank of the audit that leads to each."""
    return tuple(0 if q == p else FAR for q in range(4)), (0, 1, 2, 3)


@functools.lru_cache(1 << 16)
def _step(vector: Vector, table: Table) -> tuple[Vector, int]:
    """One table further; costs less the least of them, and that one."""
    costs, ranks = vector
    best: list[tuple[int, int, int] | None] = [None] * 4
    for p in range(4):
        if costs[p] < FAR:
            for q, cost, order in table[p]:
                way = (costs[p] + cost, ranks[p], order)
                if best[q] is None or way < best[q]:
                    best[q] = way
    least = min(w[0] for w in best if w is not None)
    in_order = sorted((w[1:] if w else (9, q), q) for q, w in enumerate(best))
    rank = [0] * 4
    for i, (_, q) in enumerate(in_order):
        rank[q] = i
    return (tuple(w[0] - least if w else FAR for w in best), tuple(rank)), least


def forward(tables: Sequence[Table], lo: int, hi: int, p: int) -> tuple[Vector, int]:
    """The vector after the tables lo..hi from state ``p``, less a base, and the base."""
    vector, base = begin(p), 0
    for i in range(lo, hi):
        vector, more = _step(vector, tables[i])
        base += more
    return vector, base


@functools.lru_cache(1 << 16)
def _back(costs: tuple[int, ...], table: Table) -> tuple[int, ...]:
    new = [min((cost + costs[q] for q, cost, _ in table[p] if costs[q] < FAR), default=FAR) for p in range(4)]
    least = min(new)
    return tuple(c - least if c < FAR else FAR for c in new)


def backward(tables: Sequence[Table], lo: int, hi: int, q: int) -> tuple[int, ...]:
    """Costs from each state before the tables lo..hi to state ``q`` behind them, less a base."""
    costs = tuple(0 if s == q else FAR for s in range(4))
    for i in range(hi - 1, lo - 1, -1):
        costs = _back(costs, tables[i])
    return costs


def crossings(tables: Sequence[Table], p: int, q: int) -> list[int]:
    """The states between the tables on the best way from ``p`` to ``q``, both included."""
    states = [p] + [q] * len(tables)
    todo = [(0, len(tables))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo < 2:
            continue
        mid = (lo + hi) // 2
        (costs, ranks), _ = forward(tables, lo, mid, states[lo])
        rest = backward(tables, mid, hi, states[hi])
        states[mid] = min((costs[s] + rest[s], ranks[s], s) for s in range(4) if costs[s] < FAR and rest[s] < FAR)[2]
        todo += [(lo, mid), (mid, hi)]
    return states


def edits(codes: str, p: int, q: int) -> list[str]:
    """The edit of each row, from state ``p`` to ``q``; rows of code ``-`` must go."""
    kept = codes.replace("-", "")
    found = iter(_edits(kept, p, q))
    return ["D" if c == "-" else next(found) for c in codes]


def _solve(codes: str, p: int, q: int) -> tuple[str, ...]:
    tables = [row_table(c) for c in codes]
    states = crossings(tables, p, q)
    return tuple(EDITS[min((cost, order) for s, cost, order in t[a] if s == b)[1]]
                 for t, a, b in zip(tables, states, states[1:]))  # noqa: B905


_short = functools.lru_cache(1 << 15)(_solve)


def _edits(codes: str, p: int, q: int) -> tuple[str, ...]:
    return (_short if len(codes) <= 16 else _solve)(codes, p, q)


def tail(q: int) -> str:
    """The turns to insert at the end of a conversation in state ``q``."""
    return {EMPTY: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}[q]


def last_state(vector: Vector) -> int:
    costs, ranks = vector
    return min((costs[q] + INSERT * len(tail(q)), ranks[q], q) for q in range(4))[2]


def combined(tables: Sequence[Table]) -> Table:
    """Many tables in a row as one: the order of its ways is that of their audits."""
    out = []
    for p in range(4):
        (costs, ranks), base = forward(tables, 0, len(tables), p)
        out.append(tuple((q, base + costs[q], ranks[q]) for q in range(4) if costs[q] < FAR))
    return tuple(out)


def _flat(table: Table) -> list[int]:
    return [x for p, ways in enumerate(table) for way in ways for x in (p, *way)]


def _table(flat: Sequence[int]) -> Table:
    ways: list[list[tuple[int, int, int]]] = [[], [], [], []]
    for i in range(0, len(flat), 4):
        p, q, cost, order = (int(x) for x in flat[i:i + 4])
        ways[p].append((q, cost, order))
    return tuple(map(tuple, ways))


# ------------------------------------------------------------------ Spark ---

_SAME = ("conv", "turn", "role", "digest")


def _match(a: DataFrame, b: DataFrame, *on: str, how: str = "inner") -> DataFrame:
    """A join in which null equals null; the columns of ``b`` that it is ``on`` go."""
    b = b.withColumnsRenamed({c: f"{c}_b" for c in on})
    cond = functools.reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"{c}_b")) for c in on])
    return a.join(b, cond, how).drop(*[f"{c}_b" for c in on])


def _given(rows: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    spaced = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    whole = rows.select(F.col(f"`{key}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
                        spaced(role).alias("role"), spaced(text).alias("text"))
    return whole.withColumn("digest", F.sha2("text", 256))


def _coded(given: DataFrame) -> DataFrame:
    """Distinct rows without their texts: how many ``copies``, the fault of the first
    of them and its code; in order, in blocks of a conversation that have a list each."""
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    whole = F.substring(end, -1, 1).isin(".", "!", "?")
    light = given.select("conv", "turn", "role", "digest", (end == "").alias("blank"), whole.alias("whole"))
    light = light.groupBy(*_SAME, "blank", "whole").agg(F.count(F.lit(1)).alias("copies"))
    # The turn where a role and text come first (null before all).  Not a window: one text
    # may fill a conversation.
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = light.where(~F.col("blank")).groupBy("conv", "role", "digest").agg(F.min(turn).alias("first"))
    light = _match(light, first, "conv", "role", "digest", how="left")
    fault = (F.when(F.col("blank"), F.lit("blank")).when(~F.col("turn").eqNullSafe(F.col("first.turn")), F.lit("duplicate"))
             .when(~F.col("whole"), F.lit("truncated")))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("o"))
    light = light.withColumn("fault", fault)
    code = (F.when(F.col("fault").isin("blank", "duplicate"), F.lit("-"))
            .when(F.col("fault") == "truncated", F.upper(letter)).otherwise(letter))
    light = light.select(*_SAME, "copies", "fault", code.alias("code"))
    in_order = cut_lineage(light.repartitionByRange(*_SAME).sortWithinPartitions(*_SAME))
    placed = in_order.withColumn("at", F.monotonically_increasing_id())
    placed = placed.withColumn("block", F.shiftright("at", BLOCK_BITS))
    row = F.struct("at", "turn", "role", "digest", "copies", "fault", "code")
    blocks = placed.groupBy("conv", "block").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    return blocks.withColumn("codes", F.array_join(F.transform("rows", lambda r: r["code"]), ""))


def _block_tables(codes: pd.Series) -> pd.Series:
    return codes.map(lambda c: _flat(combined([row_table(x) for x in c.replace("-", "")])))


def _between(parts: pd.DataFrame, p: int, q: int | None) -> pd.DataFrame:
    """Start and end states of the parts; ``q`` None: up to the conversation's end."""
    tables = [_table(t) for t in parts["table"]]
    if q is None:
        q = last_state(forward(tables, 0, len(tables), p)[0])
    states = crossings(tables, p, q)
    return parts.assign(p=states[:-1], q=states[1:])


def _states(tables: DataFrame) -> DataFrame:
    """``(conv, block, p, q, ends)`` of the conversations of several blocks: the states
    around every block, and whether a conversation ends with it.

    Blocks of one conversation in one partition are combined first, then these:
    a task sees the blocks of one partition, or one table for each partition.
    """
    kind = tables.schema["conv"].dataType.simpleString()
    several = tables.groupBy("conv").agg(F.count(F.lit(1)).alias("blocks")).where("blocks > 1")
    tables = _match(tables, several, "conv").withColumn("part", F.shiftright("block", 33 - BLOCK_BITS))

    def up(blocks: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values("block")
        whole = _flat(combined([_table(t) for t in blocks["table"]]))
        return blocks.iloc[:1].assign(table=[whole])[["conv", "part", "table"]]

    def top(parts: pd.DataFrame) -> pd.DataFrame:
        found = _between(parts.sort_values("part"), EMPTY, None)
        found["ends"] = [False] * (len(found) - 1) + [True]
        return found[["conv", "part", "p", "q", "ends"]]

    def down(key: tuple, blocks: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        found = _between(blocks.sort_values("block"), int(part["p"].iloc[0]), int(part["q"].iloc[0]))
        found["ends"] = [False] * (len(found) - 1) + [bool(part["ends"].iloc[0])]
        return found[["conv", "block", "p", "q", "ends"]]

    parts = tables.groupBy("conv", "part").applyInPandas(up, f"conv {kind}, part bigint, table array<bigint>")
    around = parts.groupBy("conv").applyInPandas(top, f"conv {kind}, part bigint, p int, q int, ends boolean")
    return tables.groupBy("conv", "part").cogroup(around.groupBy("conv", "part")).applyInPandas(
        down, f"conv {kind}, block bigint, p int, q int, ends boolean")


def operations(codes: str, copies: Sequence[int], p: int, q: int, ends: bool) -> Iterator[tuple]:
    """``(pos, nth, edit, role, copies, again)`` of a block: ``role`` where it is new,
    ``again`` for the copies behind a row's first."""
    state, names = p, {USER: "user", ASSISTANT: "assistant"}
    pos = -1
    for pos, (code, edit, n) in enumerate(zip(codes, edits(codes, p, q), copies)):  # noqa: B905
        for mark in edit:
            if mark == "I":
                state = NEXT[state]
                yield pos, 0, "Insert", names[state], 1, False
            elif mark == "R":
                state = NEXT[state]
                yield pos, 1, "Rerole", names[state], 1, False
            elif mark == "K":
                state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[code.lower()]
                yield pos, 1, "Keep", None, 1, False
            else:
                yield pos, 1, "Delete", None, n if code == "-" else 1, False
        if code != "-" and n > 1:
            yield pos, 2, "Delete", None, n - 1, True
    for i in range(len(tail(state)) if ends else 0):
        state = NEXT[state]
        yield pos, 3 + i, "Insert", names[state], 1, False


_OPERATIONS = "array<struct<pos:int,nth:int,edit:string,role:string,copies:bigint,again:boolean>>"


def _end(codes: str) -> int:
    """The last state of a conversation of these rows."""
    tables = [row_table(c) for c in codes.replace("-", "")]
    return last_state(forward(tables, 0, len(tables), EMPTY)[0])


def _block_edits(codes: pd.Series, copies: pd.Series, p: pd.Series, q: pd.Series, ends: pd.Series) -> pd.Series:
    """``ends`` null: the block is a whole conversation."""
    names = ("pos", "nth", "edit", "role", "copies", "again")
    out = []
    for c, n, a, b, e in zip(codes, copies, p, q, ends):  # noqa: B905
        states = (EMPTY, _end(c), True) if e is None or e != e else (int(a), int(b), bool(e))
        out.append([dict(zip(names, op)) for op in operations(c, n, *states)])  # noqa: B905
    return pd.Series(out)


def repair(conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """Every row of every conversation with its edit, and the rows inserted:
    ``(key, at, nth, edit, turn, role, text, fault, copies, role_before)``.

    Rows go by turn, nulls first; rows of one turn by role, then by the SHA-256
    of the text.  ``at`` and ``nth`` order a conversation's result.  ``edit`` is
    ``Keep``, ``Rerole``, ``Delete`` or ``Insert``; the rows that are not deleted,
    with ``role`` and ``text``, are the repaired conversation.  ``fault`` is the
    row's first of ``blank`` (no character but white space), ``duplicate`` (role
    and text came before) and ``truncated`` (its last such character is none of
    ``.!?``); blank and duplicate rows must be deleted, and a truncated row that
    stays costs five more.  Repeated rows are one row with ``copies``, of which
    all but the first are deleted as duplicates.

    A null role or text is read as one space; a null key is a conversation, a
    null turn comes first; an empty table gives an empty result; further columns
    are not read.

    No conversation is gathered in one task: its rows are dealt by ranges of key
    and turn and solved in blocks of 4096; see ``_states`` for how these meet.
    """
    given = _given(conversations, key, turn, role, text)
    blocks = stored(_coded(given), "blocks")
    table_of, edits_of = F.pandas_udf(_block_tables, "array<bigint>"), F.pandas_udf(_block_edits, _OPERATIONS)
    states = _states(blocks.select("conv", "block", table_of("codes").alias("table")))
    copies = F.transform("rows", lambda r: r["copies"])
    ops = _match(blocks, states, "conv", "block", how="left").withColumn("ops", edits_of("codes", copies, "p", "q", "ends"))
    ops = ops.select("conv", F.explode(F.transform("ops", lambda op: F.struct(
        op.alias("op"), F.get("rows", op["pos"]).alias("row")))).alias("one"))
    own, op = F.col("one.row"), F.col("one.op")
    inserted = op["edit"] == "Insert"
    own_only = lambda c: F.when(~inserted, own[c])
    ops = ops.select(
        "conv", own["at"].alias("at"), op["nth"].alias("nth"), op["edit"].alias("edit"), own_only("turn").alias("turn"),
        op["role"].alias("new_role"), own_only("role").alias("role"), own_only("digest").alias("digest"),
        F.when(op["again"], F.lit("duplicate")).otherwise(own_only("fault")).alias("fault"), op["copies"].alias("copies"))
    texts = given.dropDuplicates(list(_SAME))
    found = _match(ops, texts, *_SAME, how="left")
    return found.select(
        F.col("conv").alias(key), "at", "nth", "edit", "turn", F.coalesce("new_role", "role").alias("role"),
        F.when(F.col("edit") == "Insert", F.lit("")).otherwise(F.col("text")).alias("text"), "fault", "copies",
        F.col("role").alias("role_before"))


def summarise(edited: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row for each conversation of ``repair``'s rows: ``(key, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256)``.

    The hash is one chain over a conversation's whole text, so one task reads a
    conversation; it does so row by row in order, and holds no more than the
    audit that it returns.
    """
    small_batches(edited.sparkSession)
    kind = edited.schema[key].dataType.simpleString()
    rows = edited.select(F.col(f"`{key}`").alias("conv"), "at", "nth", "edit", F.col("turn").cast("long").alias("turn"),
                         "role", "text", "fault", "copies", "role_before")
    rows = rows.repartition("conv").sortWithinPartitions("conv", "at", "nth")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = pa.schema([("conv", pa.null()), *[(c, pa.int64()) for c in counts], ("audit", pa.string()),
                        ("repaired_sha256", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, one = None, None
        for batch in batches:
            done: list[tuple] = []
            for values in zip(*(c.to_pylist() for c in batch.columns)):  # noqa: B905
                if one is None or values[0] != conv:
                    if one is not None:
                        done.append((conv, *one.result()))
                    conv, one = values[0], _Summary()
                one.add(*values[3:])
            if done:
                yield _as_batch(done, schema, batch.schema.field(0).type)
            kind_of = batch.schema.field(0).type
        if one is not None:
            yield _as_batch([(conv, *one.result())], schema, kind_of)

    found = rows.mapInArrow(run, f"conv {kind}, {', '.join(f'{c} bigint' for c in counts)}, audit string, repaired_sha256 string")
    return found.withColumnRenamed("conv", key)


def _as_batch(rows: list[tuple], schema: pa.Schema, kind: pa.DataType) -> pa.RecordBatch:
    types = [kind, *[f.type for f in schema][1:]]
    columns = zip(*rows)  # noqa: B905
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=schema.names)  # noqa: B905


class _Summary:
    """What one conversation's rows, given in order, come to."""

    def __init__(self) -> None:
        self.hash, self.audit, self.empty = hashlib.sha256(), [], True
        self.cost = self.illegal = self.turns = 0
        self.low = self.high = self.before = None
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}

    def add(self, edit: str, turn: int | None, role: str, text: str, fault: str | None, copies: int,
            role_before: str | None) -> None:
        self.audit.append(edit[0] * copies)
        self.cost += {"Keep": 0, "Rerole": REROLE, "Delete": DELETE, "Insert": INSERT}[edit] * copies
        if edit != "Delete":
            self.cost += TRUNCATED * (fault == "truncated")
            self.hash.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode())
            self.empty = False
        if edit == "Insert":
            return
        if fault:
            self.faults[fault] += copies
        initial = role_before[:1]
        self.illegal += copies - 1 + (self.before is not None and self.before + initial not in ("su", "ua", "au"))
        self.before = initial
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn

    def result(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())
