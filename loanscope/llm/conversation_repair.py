"""Repair of conversation structure by Hirschberg's divide and conquer over a four-state machine of roles.

A repaired conversation is empty or an optional system turn followed by user and assistant turns in turn. The machine's
states are start, after system, after user and after assistant. Rows are kept (cost 0), given the role user or assistant
(2) or deleted (3; a must for blank and duplicate rows), turns of empty text are inserted (2), and a truncated row that
stays adds 1. Inserted turns belong to the row behind them, those at the end to none.

Forward vectors hold the least cost of reaching each state and the order of the states' audits (K keep, R role, D delete,
I insert) as text; backward vectors hold the least cost of getting from each state to the end. Two different crossings of
one boundary have audits of as many rows, so neither begins the other, and the order of the audits before the boundary
decides between equally cheap ones. The two vectors meet mid-conversation, the audit-least of the cheapest crossings is
taken, and both halves are solved alike: space is linear in the rows, and nothing but one byte per row is looked at.

The same step works on blocks of rows, whose tables of least costs and orders compose: conversations of more than `LONG`
rows are cut into blocks by turn, blocks are summed up and solved by separate tasks, and only their tables meet. A text
digest runs over one conversation from its first to its last byte, so repaired turns of a long conversation stream
through one task, block by block in order; none is held whole.

Damage (`damaged`) is a function of conversation, turn and row: it makes test data out of sound conversations.

Null roles and texts are one space (blank, and of no role), null turns come first, a null conversation identifier is a
conversation of its own. Rows of one turn are ordered by role and text. Repeated rows are duplicates. A conversation
without rows has zeros, an empty audit and the digest of an empty text. An empty table gives no rows. Only the named
columns are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from loanscope.llm.shared import batches, written

#: Conversations of more rows are solved block by block.
LONG = 20_000
#: Turns of one block of a long conversation.
BLOCK = 4096

START, SYSTEM, USER, ASSISTANT = range(4)
#: What follows a state: (initial of the next turn, next state).
_NEXT = {START: (("s", SYSTEM), ("u", USER)), SYSTEM: (("u", USER),), USER: (("a", ASSISTANT),), ASSISTANT: (("u", USER),)}
_END = (START, ASSISTANT)
_INSERT, _ROLE, _DELETE, _TRUNCATED = 2, 2, 3, 1
_NAMES = {"u": "user", "a": "assistant"}

#: A table lists for each state the (next state, least cost, place of its audit among those of this state).
Table = tuple[tuple[tuple[int, int, int], ...], ...]


def kind(initial: str, gone: bool, truncated: bool) -> int:
    """A row as a number: 0 must be deleted, else its initial and whether it ends early."""
    return 0 if gone else 1 + "sua".find(initial if initial in ("s", "u", "a") else "?") + 1 + 4 * truncated


def _inserted(state: int) -> Iterator[tuple[int, str]]:
    """(state, audit) after any useful number of inserted turns."""
    yield state, ""
    seen, audit = {state}, ""
    while True:
        ahead = [t for initial, t in _NEXT[state] if initial in _NAMES and t not in seen]
        if not ahead:
            return
        (state,), audit = ahead, audit + "I"
        seen.add(state)
        yield state, audit


def _moves(row: int, state: int) -> Iterator[tuple[int, int, str]]:
    """(next state, cost, audit) of every way to deal with a row."""
    initial, late = (None, 0) if row == 0 else ("?sua"[(row - 1) % 4], _TRUNCATED * (row > 4))
    for there, audit in _inserted(state):
        cost = _INSERT * len(audit)
        yield there, cost + _DELETE, audit + "D"
        for wanted, after in _NEXT[there]:
            if row and wanted == initial:
                yield after, cost + late, audit + "K"
            if row and wanted in _NAMES:
                yield after, cost + _ROLE + late, audit + "R"


def _best(moves: Iterator[tuple[int, int, str]]) -> dict[int, tuple[int, str]]:
    out: dict[int, tuple[int, str]] = {}
    for state, cost, audit in moves:
        out[state] = min(out.get(state, (cost, audit)), (cost, audit))
    return out


def _table(per_state: Sequence[dict[int, tuple[int, object]]]) -> Table:
    """Least costs and audits (or what orders them) as a table."""
    out = []
    for found in per_state:
        order = sorted(audit for _, audit in found.values())
        out.append(tuple((state, cost, order.index(audit)) for state, (cost, audit) in sorted(found.items())))
    return tuple(out)


#: Of each kind of row: the best ways from each state, and the same as a table.
_WAYS = [[_best(_moves(row, state)) for state in range(4)] for row in range(9)]
_TABLES = [_table(ways) for ways in _WAYS]
#: From each state: (cost, audit) of the turns inserted at the end.
_TAIL = [min((_INSERT * len(a), a) for t, a in _inserted(s) if t in _END) if any(t in _END for t, _ in _inserted(s)) else None for s in range(4)]

Vector = dict[int, tuple[int, int]]


def forward(vector: Vector, table: Table) -> Vector:
    """Least cost and order of audits per state after one more row or block."""
    best: dict[int, tuple[int, int, int]] = {}
    for state, (cost, rank) in vector.items():
        for after, more, order in table[state]:
            way = (cost + more, rank, order)
            if after not in best or way < best[after]:
                best[after] = way
    places = {way: n for n, way in enumerate(sorted(way[1:] for way in best.values()))}
    return {state: (way[0], places[way[1:]]) for state, way in best.items()}


def backward(vector: dict[int, int], table: Table) -> dict[int, int]:
    """Least cost from each state before one more row or block."""
    out = {}
    for state, ways in enumerate(table):
        costs = [more + vector[after] for after, more, _ in ways if after in vector]
        if costs:
            out[state] = min(costs)
    return out


def crossings(tables: Sequence[Table], first: int, last: int) -> list[int]:
    """The states at all boundaries of the audit-least cheapest way from state `first` to `last`."""
    out, todo = [first], [(0, len(tables), first, last)] if tables else []
    while todo:  # left halves first, so that states come in order
        low, high, here, there = todo.pop()
        if high - low == 1:
            out.append(there)
            continue
        mid = (low + high) // 2
        ahead: Vector = {here: (0, 0)}
        for table in tables[low:mid]:
            ahead = forward(ahead, table)
        behind = {there: 0}
        for at in range(high - 1, mid - 1, -1):
            behind = backward(behind, tables[at])
        meet = min((ahead[s][0] + behind[s], ahead[s][1], s) for s in ahead if s in behind)[2]
        todo += [(mid, high, meet, there), (low, mid, here, meet)]
    return out


def ending(vector: Vector) -> tuple[int, int, str]:
    """(cost, state, inserted turns) of the audit-least cheapest end."""
    cost, _, state = min((vector[s][0] + _TAIL[s][0], vector[s][1], s) for s in vector if _TAIL[s])
    return cost, state, _TAIL[state][1]


def audit_between(rows: bytes, first: int, last: int) -> str:
    """The audit of rows on the least way from state `first` to `last`."""
    states = crossings([_TABLES[row] for row in rows], first, last)
    return "".join(_WAYS[row][a][b][1] for row, a, b in zip(rows, states, states[1:]))


def _repair(rows: bytes) -> tuple[int, str]:
    vector: Vector = {START: (0, 0)}
    for row in rows:
        vector = forward(vector, _TABLES[row])
    cost, last, tail = ending(vector)
    return cost, audit_between(rows, START, last) + tail


_short_repair = lru_cache(1 << 14)(_repair)


def repair(rows: bytes) -> tuple[int, str]:
    """The cost and the audit of the kinds of a conversation's rows; short ones of the same kinds are solved once."""
    return (_short_repair if len(rows) <= 64 else _repair)(rows)


def summed(rows: bytes) -> Table:
    """The table of a block of rows."""
    out = []
    for state in range(4):
        vector: Vector = {state: (0, 0)}
        for row in rows:
            vector = forward(vector, _TABLES[row])
        out.append(tuple((s, cost, rank) for s, (cost, rank) in sorted(vector.items())))
    return tuple(out)


def turns(audit: str, rows: Iterator[tuple[str, str]], state: int) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired turns of the rows that the audit speaks of; the value returned is the last state."""
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "K":
            state = dict(_NEXT[state])[role[:1]]
            yield role, text
        elif edit != "D":
            ((initial, state),) = [(i, s) for i, s in _NEXT[state] if i in _NAMES]
            yield _NAMES[initial], text
    return state


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after damage by crc32 of `conv_id:turn`: one row in 20 each is dropped, emptied, loses its
    ends of sentences, is repeated, or becomes the user's."""
    name = F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in ("conv_id", "", "turn")))
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    fate = F.crc32(F.encode(name, "UTF-8")) % 20
    out = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), fate.alias("fate")).filter("fate <> 0")
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return out.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


_ORDER = ["turn", "role", "text"]
_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_LEGAL = {"su", "ua", "au"}


class Tally:
    """What is counted over the rows of a conversation in their order, or over pieces of it."""

    def __init__(self) -> None:
        self.low = self.high = self.first = self.last = None
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def row(self, turn: int | None, role: str, blank: bool, duplicate: bool, truncated: bool) -> int:
        """Count a row; returns its kind."""
        if turn is not None and turn != self.high:
            self.low, self.high = (turn if self.low is None else self.low), turn
            self.distinct += 1
        self.blank += blank
        self.duplicate += duplicate and not blank
        self.truncated += truncated and not (duplicate or blank)
        self._meet(role[:1], role[:1])
        return kind(role[:1], blank or duplicate, truncated)

    def _meet(self, first: str, last: str) -> None:
        self.illegal += self.last is not None and self.last + first not in _LEGAL
        self.first, self.last = (first if self.first is None else self.first), last

    def add(self, piece: dict) -> None:
        """Count a later piece, whose turns are all later ones (those of a block are)."""
        for name in ("distinct", *_COUNTS):
            setattr(self, name, getattr(self, name) + piece[name])
        if piece["low"] is not None:
            self.low, self.high = (piece["low"] if self.low is None else self.low), piece["high"]
        self._meet(piece["first"], piece["last"])

    def counts(self) -> tuple[int, ...]:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (gaps, *(getattr(self, name) for name in _COUNTS))


def _rows(tables: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for table in tables:
        yield from zip(*(c.to_pylist() for c in table.columns))


def _bytes(role: str, text: str) -> bytes:
    return f"{role}:{text}".encode("utf-8", "surrogatepass")


def _mapped(rows: DataFrame, work: Callable[[Iterator[tuple]], Iterator[tuple]], columns: str, size: Callable[[tuple], int]) -> DataFrame:
    """`work` over the rows of each partition, as tuples in and out, in Arrow batches of bounded size."""
    schema = to_arrow_schema(StructType.fromDDL(columns))
    return rows.mapInArrow(lambda tables: batches(work(_rows(tables)), schema, size), columns)


def _solve_whole(rows: Iterator[tuple]) -> Iterator[tuple]:
    """One result per conversation of at most LONG rows, which are held while it is solved."""
    for conv, group in groupby(rows, lambda r: r[0]):
        tally, kinds, held, seen = Tally(), bytearray(), [], set()
        for _, turn, role, text, blank, truncated in group:
            if role is None:  # stands for the conversation only
                continue
            kinds.append(tally.row(turn, role, blank, (role, text) in seen, truncated))
            seen.add((role, text))
            held.append((role, text))
        cost, audit = repair(bytes(kinds))
        digest = hashlib.sha256(b"\n".join(_bytes(*turn) for turn in turns(audit, iter(held), START)))
        yield conv, *tally.counts(), cost, audit, digest.hexdigest()


def _piece(rows: Iterator[tuple]) -> Iterator[tuple]:
    """One row per block of a long conversation: its kinds of rows, its table and what is counted in it."""
    for (conv, block), group in groupby(rows, lambda r: r[:2]):
        tally, kinds, seen = Tally(), bytearray(), set()
        for _, _, mark, turn, role, _, blank, truncated, digest in group:
            if mark:
                kinds.append(tally.row(turn, role, blank, digest in seen, truncated))
            seen.add(digest)
        table = [n for state, ways in enumerate(summed(bytes(kinds))) for way in ways for n in (state, *way)]
        yield (
            conv, block, bytes(kinds), table, tally.low, tally.high, tally.distinct, *(getattr(tally, n) for n in _COUNTS),
            tally.first, tally.last,
        )


_PIECE = "table array<long>, low long, high long, distinct long, blank long, duplicate long, truncated long, illegal long, first string, last string"


def _meet_blocks(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Each block's states on both sides; the last block has the tail, the cost and the counts of the conversation."""
    for conv, group in groupby(rows, lambda r: r[0]):
        tally, blocks, tables, vector = Tally(), [], [], {START: (0, 0)}
        for _, block, flat, *counted in group:
            ways = [[], [], [], []]
            for n in range(0, len(flat), 4):
                ways[flat[n]].append(tuple(flat[n + 1:n + 4]))
            blocks.append(block)
            tables.append(tuple(map(tuple, ways)))
            vector = forward(vector, tables[-1])
            tally.add(dict(zip(("low", "high", "distinct", *_COUNTS, "first", "last"), counted)))
        cost, last, tail = ending(vector)
        states = crossings(tables, START, last)
        for n, block in enumerate(blocks):
            end = n == len(blocks) - 1
            yield conv, block, states[n], states[n + 1], tail if end else "", [*tally.counts(), cost] if end else None


def _audit_block(rows: Iterator[tuple]) -> Iterator[tuple]:
    for conv, block, kinds, first, last, tail, totals in rows:
        yield conv, block, first, audit_between(kinds, first, last) + tail, totals


def _digest_long(rows: Iterator[tuple]) -> Iterator[tuple]:
    """One result per long conversation; its repaired turns stream through the digest block by block."""
    for conv, group in groupby(rows, lambda r: r[0]):
        audits, digest, joint, totals = [], hashlib.sha256(), b"", None
        for _, block in groupby(group, lambda r: r[1]):
            _, _, _, _, _, _, first, audit, totals = next(block)
            audits.append(audit)
            for turn in turns(audit, ((r[4], r[5]) for r in block), first):
                digest.update(joint + _bytes(*turn))
                joint = b"\n"
        yield conv, *totals, "".join(audits), digest.hexdigest()


def _long(rows: DataFrame, id_type: str) -> DataFrame:
    """Conversations of any length, block by block."""
    key = f"conv_id {id_type}, block long"
    digest = F.md5(F.concat_ws(":", F.length("role"), "role", "text"))
    rows = rows.withColumns({"block": F.coalesce(F.shiftright(F.col("turn"), int(math.log2(BLOCK))), F.lit(-(1 << 62))), "digest": digest})
    # what was said in an earlier block: one narrow row per block and saying
    said = rows.groupBy("conv_id", "digest", "block").agg(F.lit(0).alias("mark"))
    before = F.min("block").over(Window.partitionBy("conv_id", "digest"))
    said = said.withColumn("before", before).filter("before < block")
    columns = ["conv_id", "block", "mark", *_ORDER, "blank", "truncated", "digest"]
    both = rows.withColumn("mark", F.lit(1)).select(*columns).unionByName(said.select("conv_id", "block", "mark", "digest"), allowMissingColumns=True)
    dealt = both.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "mark", *_ORDER).select(*columns)
    pieces = written(_mapped(dealt, _piece, f"{key}, kinds binary, {_PIECE}", lambda r: len(r[2]) + 1000))
    tables = pieces.drop("kinds").repartition("conv_id").sortWithinPartitions("conv_id", "block")
    met = _mapped(tables, _meet_blocks, f"{key}, first int, last int, tail string, totals array<long>", lambda r: 200)
    same = pieces.conv_id.eqNullSafe(met.conv_id) & (pieces.block == met.block)
    states = pieces.join(met, same).select(pieces.conv_id, pieces.block, "kinds", met["first"], met["last"], "tail", "totals")
    audits = _mapped(states, _audit_block, f"{key}, start int, audit string, totals array<long>", lambda r: len(r[3]) + 100)
    columns = ["conv_id", "block", "mark", *_ORDER, "start", "audit", "totals"]
    both = (
        rows.select("conv_id", "block", F.lit(1).alias("mark"), *_ORDER)
        .unionByName(audits.withColumn("mark", F.lit(0)), allowMissingColumns=True)
        .repartition("conv_id").sortWithinPartitions("conv_id", "block", "mark", *_ORDER).select(*columns)
    )
    return _mapped(both, _digest_long, f"conv_id {id_type}, {_RESULT}", lambda r: len(r[7]) + 200)


def repaired(rows: DataFrame, ids: DataFrame | None = None, long: int = LONG) -> DataFrame:
    """conv_id, faults, cost, audit and digest of the repaired turns per conversation.

    `rows` has conv_id, turn, role, text; `ids` (conv_id) names conversations that are reported even without rows.
    """
    id_type = rows.schema["conv_id"].dataType.simpleString()
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role, text)
    bare = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    rows = rows.withColumns({"blank": F.length(bare) == 0, "truncated": ~F.right(bare, F.lit(1)).isin(".", "!", "?")})
    lengths = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > long)
    lengths = written(lengths.select(F.col("conv_id").alias("long_id")))
    every = rows if ids is None else rows.unionByName(ids.select("conv_id").distinct(), allowMissingColumns=True)
    none = lengths.isEmpty()
    same = F.col("conv_id").eqNullSafe(F.col("long_id"))
    short = every if none else every.join(lengths, same, "left_anti")
    dealt = short.repartition("conv_id").sortWithinPartitions("conv_id", *_ORDER)
    out = _mapped(dealt, _solve_whole, f"conv_id {id_type}, {_RESULT}", lambda r: len(r[7]) + 200)
    return out if none else out.unionAll(_long(rows.join(lengths, same, "left_semi"), id_type))
