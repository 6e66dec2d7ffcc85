from __future__ import annotations

import hashlib
import itertools
import random

import pytest
from hypothesis import given, settings, strategies as st

from loanscope.llm import conversation_repair as cr

FIRST = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def legal(initials: str) -> bool:
    state = 0
    for initial in initials:
        if initial not in FIRST[state]:
            return False
        state = FIRST[state][initial]
    return state in (0, 3)


def by_search(rows):
    """(cost, audit) of the audit-least cheapest edits by trying all; rows of (initial, gone, truncated)."""
    best = None
    options = [("",), ("u",), ("a",), ("u", "a"), ("a", "u")]
    for inserts in itertools.product(options, repeat=len(rows) + 1):
        for edits in itertools.product("DKua", repeat=len(rows)):
            cost, audit, said = 0, "", ""
            for put, edit, (initial, gone, late) in itertools.zip_longest(inserts, edits, rows, fillvalue=(None, None, None)):
                put = [p for p in put if p]
                cost, audit, said = cost + 2 * len(put), audit + "I" * len(put), said + "".join(put)
                if edit is None or isinstance(edit, tuple):
                    continue
                if gone and edit != "D":
                    break
                cost += {"D": 3, "K": 0}.get(edit, 2) + (late and edit != "D")
                audit += edit if edit in "DK" else "R"
                said += "" if edit == "D" else initial if edit == "K" else edit
            else:
                if legal(said) and (best is None or (cost, audit) < best):
                    best = cost, audit
    return best


@pytest.mark.parametrize("seed", range(25))
def test_audit_against_all_edits(seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice("suax"), rnd.random() < 0.2, rnd.random() < 0.3) for _ in range(seed % 4)]
    kinds = bytes(cr.kind(*row) for row in rows)
    assert cr.repair(kinds) == by_search(rows)


def by_steps(kinds):
    """(cost, audit) by carrying whole audits forward."""
    best = {0: (0, "")}
    for row in kinds:
        step = {}
        for state, (cost, audit) in best.items():
            for after, more, text in cr._moves(row, state):
                step[after] = min(step.get(after, (1 << 60, "")), (cost + more, audit + text))
        best = step
    return min((cost + 2 * len(tail), audit + tail) for s, (cost, audit) in best.items() for t, tail in cr._inserted(s) if t in (0, 3))


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=60).map(lambda b: bytes(x % 9 for x in b)))
def test_divide_and_conquer(kinds):
    assert cr._repair(kinds) == by_steps(kinds)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=12).map(lambda b: bytes(x % 9 for x in b)), min_size=1, max_size=6))
def test_blocks_compose(blocks):
    tables, vector = [cr.summed(b) for b in blocks], {0: (0, 0)}
    for table in tables:
        vector = cr.forward(vector, table)
    cost, last, tail = cr.ending(vector)
    states = cr.crossings(tables, 0, last)
    audit = "".join(cr.audit_between(b, x, y) for b, x, y in zip(blocks, states, states[1:])) + tail
    assert (cost, audit) == by_steps(b"".join(blocks))


ROWS = [
    (1, 0, "system", "Be kind.", 0), (1, 1, "user", "Hi there", 0), (1, 2, "user", "Hi there", 0), (1, 5, "assistant", " \t\n", 0),
    (1, 6, "assistant", "Hello!", 0), (2, None, "tool", "x.", 0), (2, None, None, None, 0), (2, 3, "user", "Why?", 0),
    (None, 1, "user", "No id.", 0), (None, 2, "assistant", "None.  ", 0), (3, 7, "user", "a.\nb", 0), (3, 7, "user", "a.\nb", 0),
    (4, 1, "", "", 0), (5, 1, "user", "long " * 50_000 + ".", 0), (5, 2, "assistant", "Ends.\x0b", 0),
] + [(6, i, ("user", "assistant", "user")[i % 3], f"Turn {i % 11}.", 0) for i in range(60)]


def plain(rows, ids):
    """All results by definition."""
    out = {i: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for i in ids}
    for conv in {r[0] for r in rows}:
        mine = sorted(((t is not None, t or 0, " " if r is None else r, " " if x is None else x) for c, t, r, x, *_ in rows if c == conv))
        seen, kinds, faults = set(), [], [0, 0, 0]
        for _, _, role, text in mine:
            bare = text.strip(" \t\n\x0b\x0c\r")
            flags = not bare, (role, text) in seen, not bare.endswith((".", "!", "?"))
            fault = next((n for n, f in enumerate(flags) if f), None)
            if fault is not None:
                faults[fault] += 1
            seen.add((role, text))
            kinds.append(cr.kind(role[:1], fault in (0, 1), fault == 2))
        cost, audit = by_steps(kinds)
        said, state, at = [], 0, 0
        for edit in audit:
            role, text = ("", "") if edit == "I" else mine[at][2:]
            at += edit != "I"
            if edit == "D":
                continue
            if edit != "K":
                role = "assistant" if state == 2 else "user"
            state = FIRST[state][role[:1]]
            said.append(f"{role}:{text}")
        turns = [t for known, t, *_ in mine if known]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        out[conv] = (gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


@pytest.mark.parametrize(("long", "block"), [(20_000, 4096), (2, 4), (0, 1)])
def test_table(spark, monkeypatch, long, block):
    monkeypatch.setattr(cr, "BLOCK", block)
    rows = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string, audit int").repartition(3)
    ids = spark.createDataFrame([(1,), (9,), (None,)], "conv_id long")
    got = {r[0]: tuple(r[1:]) for r in cr.repaired(rows, ids, long=long).collect()}
    assert got == plain(ROWS, [1, 9, None])


def test_empty_table(spark):
    assert cr.repaired(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_damage(spark):
    rows = spark.createDataFrame([(c, t, "assistant", "Yes. No!") for c in range(40) for t in range(5)], "conv_id long, turn long, role string, text string")
    out = cr.damaged(rows).collect()
    from zlib import crc32
    fates = {(c, t): crc32(f"{c}:{t}".encode()) % 20 for c in range(40) for t in range(5)}
    want = []
    for (c, t), fate in fates.items():
        row = (c, t, "user" if fate == 4 else "assistant", "" if fate == 1 else "Yes No" if fate == 2 else "Yes. No!")
        want += [row] * (0 if fate == 0 else 2 if fate == 3 else 1)
    assert sorted(map(tuple, out)) == sorted(want) and {0, 1, 2, 3, 4} <= set(fates.values())
