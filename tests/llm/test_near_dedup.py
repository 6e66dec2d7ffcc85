"""Near-duplicate groups against all pairs in plain Python."""

from __future__ import annotations

import random
import re
from itertools import combinations
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from loanscope.llm import signature_join
from loanscope.llm.components import components
from loanscope.llm.signature_join import Rule

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, cls string, token string"


def brute(rows, rule):
    """{identifier: (set size, component)} from all pairs of full sets."""
    sets = {}
    for ident, text in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))
        runs = [tuple(words[k : k + rule.width]) for k in range(len(words) - rule.width + 1)] or ([tuple(words)] if words else [])
        sets[ident] = frozenset(runs)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= rule.percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def corpus(seed=3):
    rng = random.Random(seed)
    word = lambda: rng.choice("the of and").lower() if rng.random() < 0.3 else f"w{rng.randrange(4000)}"
    rows, ident = [], 0
    passage = [word() for _ in range(80)]
    for _ in range(12):  # chains of edits: neighbours are alike, the ends are not
        text = [word() for _ in range(rng.choice((4, 30, 150)))]
        for _ in range(rng.choice((2, 5, 12))):
            for _ in range(max(1, len(text) // 60)):
                text = [*text]
                text[rng.randrange(len(text))] = word()
            rows.append((ident, " ".join(text)))
            ident += 1
    for _ in range(40):  # much of it is a shared passage, without being alike
        rows.append((ident, " ".join([*passage, *(word() for _ in range(rng.randrange(5, 80)))])))
        ident += 1
    centre = [word() for _ in range(200)]
    for _ in range(60):  # a large group around one text
        copy = [*centre]
        for _ in range(rng.randrange(1, 9)):
            copy[rng.randrange(len(copy))] = word()
        rows.append((ident, " ".join(copy)))
        ident += 1
    rows += [(ident, None), (ident + 1, ""), (ident + 2, " \t"), (ident + 3, "One"), (ident + 4, "one"), (ident + 5, "two Words"), (ident + 6, "a " * 20000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rule", [Rule(3, 85), Rule(5, 80)])
def test_against_all_pairs(spark, rule):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x", None) for i, t in rows], SCHEMA)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in signature_join.near_groups(docs, rule).collect()}
    assert found == brute(rows, rule)


def test_long_lists_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(signature_join, "BLOCK", 8)
    rows = corpus(8)
    docs = spark.createDataFrame([(i, t, "x", None) for i, t in rows], SCHEMA)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in signature_join.near_groups(docs, Rule(3, 85)).collect()}
    assert found == brute(rows, Rule(3, 85))


def test_sets_that_share_a_hash(spark):
    rows = corpus(5)

    def coarse(hashes, at):
        high, low = signature_join.set_keys(hashes, at)
        return high % 7, low

    docs = spark.createDataFrame([(i, t, "x", None) for i, t in rows], SCHEMA)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in signature_join.near_groups(docs, Rule(3, 85), keys=coarse).collect()}
    assert found == brute(rows, Rule(3, 85))


def test_repeated_rows_and_missing_identifiers(spark):
    text = " ".join(f"w{k}" for k in range(100))
    docs = spark.createDataFrame([(5, text, "a", "b"), (5, text, "a", "b"), (None, text + " x", "a", "b"), (2, "alone", "a", "b"), (None, None, None, None)], SCHEMA)
    rows = signature_join.near_groups(docs, Rule(5, 80)).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in rows) == [
        ("2", "2", True), ("5", "5", True), ("5", "5", True), ("None", "5", False), ("None", "None", True),
    ]
    kept = signature_join.drop_near_copies(docs, Rule(5, 80))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {2, 5, None}


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert signature_join.near_groups(docs).count() == signature_join.drop_near_copies(docs).count() == 0


def test_components(spark):
    rng = random.Random(1)
    pairs = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)] + [(7, 7)]
    root = {n: n for p in pairs for n in p}
    for _ in root:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    found = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    alone = {n for n in root if not any(n in p and p[0] != p[1] for p in pairs)}
    assert found == {n: c for n, c in root.items() if n not in alone}


def test_one_row_of_a_group_stays_whatever_shares_its_identifier(spark):
    text = " ".join(f"w{k}" for k in range(100))
    rows = [(5, text), (5, text + " x"), (5, "something else altogether, that is like nothing here"), (None, text + " y"), (None, "no near copy of any other row is this"), (6, text), (7, ""), (7, "")]
    docs = spark.createDataFrame([(i, t, "a", "b") for i, t in rows], SCHEMA)
    kept = [(r.doc_id, r.text) for r in signature_join.drop_near_copies(docs, Rule(5, 80)).collect()]
    assert len([t for _, t in kept if t.startswith("w0")]) == 1 and len(kept) == 5


def test_signatures_of_a_group_are_looked_up_once(monkeypatch):
    rng, rule, n = np.random.default_rng(4), Rule(3, 85), 150
    sketch = rng.integers(0, 9, signature_join.SKETCH).astype(np.int32)
    values = rng.integers(0, 1 << 32, (n + 1, signature_join.K), np.uint32)
    sig = np.where(rng.random((n, signature_join.K)) < 0.12, values[:-1], values[-1])
    comp = [k // 3 for k in range(n)]
    prefixes = signature_join._ordered(sig, sketch, rule.prefix).tolist()
    expected, found, members, looked = set(), set(), 0, []
    for u, v in combinations(range(n), 2):
        if comp[u] != comp[v] and (sig[u] == sig[v]).sum() >= rule.least:
            expected.add((next(t for t in prefixes[u] if t in prefixes[v]), u, v))
    assert len({t for t, *_ in expected}) > 1

    tokens = signature_join._tokens
    monkeypatch.setattr(signature_join, "_tokens", lambda s: looked.append(len(s)) or tokens(s))
    kinds = [pa.int64(), *[pa.int32()] * 5, *[pa.int64()] * 3, pa.binary()]
    for token in sorted({t for prefix in prefixes for t in prefix}):
        rows = [(token - (token >> 63 << 64), 7, 0, 0, 0, 7, k, comp[k], 50, sig[k].tobytes()) for k in range(n) if token in prefixes[k]]
        members += len(rows)
        batch = pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names=[str(k) for k in range(len(kinds))])
        for out in signature_join._candidates(SimpleNamespace(value=sketch), rule)(iter([batch])):
            for cls, partners in zip(out["cls"].to_pylist(), out["partners"].to_pylist()):
                pairs = [(token, min(cls, v), max(cls, v)) for v in partners]
                assert found.isdisjoint(pairs)
                found.update(pairs)
    assert found == expected
    assert sum(looked) <= members


def test_only_pairs_without_a_hub_are_compared_again(spark):
    lists = {1: [10, 11], 2: [10, 11, 12], 3: [10, 12, 13], 4: [11, 14, 15, 16]}  # the first of each is its hub
    rows = [(token, c, 40, len(of), of[0], 40) for token, of in lists.items() for c in of]
    members = spark.createDataFrame(rows, "token long, cls long, n_shingles long, size long, hub long, hub_shingles long")
    comps = spark.createDataFrame([(13, 12)], "a long, b long")
    found = {(r.token, r.cls) for r in signature_join._mixed_groups(members, comps, Rule(3, 85)).collect()}
    assert found == {(2, 11), (2, 12), (4, 14), (4, 15), (4, 16)}


def test_sets_are_read_once_per_class(spark):
    rule, one, two = Rule(3, 85), "a b c d e", "f g h i"
    rows = spark.createDataFrame([(5, one), (5, two), (7, one), (5, ""), (8, one + " x")], "doc_id long, text string")
    (_, _, hashes, at), = signature_join.shingle_sets(pa.array([one, two]), rule.width)
    high, low = signature_join.set_keys(hashes, at)
    none = spark.createDataFrame([], "high long, first long")
    wanted = spark.createDataFrame([(int(high[0]), 5)], "cls long, doc_id long")
    found = [(r.cls, bytes(r.shingles)) for r in signature_join._sets(rows, wanted, none, rule).collect()]
    assert found == [(high[0], hashes[: at[1]].tobytes())]
    # sets that share their first hash: the one with another second hash has a class of its own
    both = spark.createDataFrame([(7, int(min(low)))], "high long, first long")
    coarse = lambda h, a: (np.full(len(a) - 1, 7), signature_join.set_keys(h, a)[1])
    wanted = spark.createDataFrame([(7, 5)], "cls long, doc_id long")
    found = [bytes(r.shingles) for r in signature_join._sets(rows, wanted, both, rule, coarse).collect()]
    k = int(np.argmin(low))
    assert found == [hashes[at[k] : at[k + 1]].tobytes()]


def test_sets_are_dealt_by_class_once(spark):
    rows = spark.createDataFrame([(5, "a b c d e")], "doc_id long, text string")
    none = spark.createDataFrame([], "high long, first long")
    pairs = spark.createDataFrame([(2, 1)], "a long, b long")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        sets = signature_join._sets(rows, spark.createDataFrame([(1, 5)], "cls long, doc_id long"), none, Rule(3, 85))
        plan = signature_join._confirmed(pairs, sets, Rule(3, 85))._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # that of the sets and that of the comparison; the other side of the pairs reads the same exchange, by class
    assert plan.count("MapInArrow") == 2 and "ReusedExchange [cls" in plan
