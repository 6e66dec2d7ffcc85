from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanscope.llm import vantage_trees as vt

SCHEMA = "vec_id long, embedding array<float>, score int"


def by_all_pairs(rows, every, k):
    """query_id, rank, vec_id, score by definition."""
    rows = [(i, [float(np.float32(v)) for v in x]) for i, x, *_ in rows]
    out = []
    for query, q in sorted({i: min(x for j, x in rows if j == i) for i, _ in rows if i % every == 0}.items()):
        found = []
        for i, x in rows:
            if i != query:
                s = 0.0
                for a, b in zip(q, x):
                    s += a * b
                found.append((-s, i))
        out += [(query, n, i, -s) for n, (s, i) in enumerate(sorted(found)[:k], 1)]
    return out


def table(n, dim, seed=0, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dim))
    return [(i, [float(np.float32(v)) for v in centres[i % 5] + spread * rng.normal(size=dim)], 0) for i in range(n)]


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_factor_one_is_exact(spark, monkeypatch, spread):
    monkeypatch.setattr(vt, "SHARD_BYTES", 40 * 8 * 6)
    monkeypatch.setattr(vt, "SAMPLE_BYTES", 150 * 8 * 6)
    monkeypatch.setattr(vt, "LEAF", 8)
    rows = table(400, 6, spread=spread)
    rows += [(1000 + i, rows[3][1], 0) for i in range(90)] + [(1000, rows[5][1], 0)] * 30 + [rows[20]] * 3 + [(40, rows[1][1], 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = sorted(map(tuple, vt.nearest(df, F.col("vec_id") % 20 == 0, k=20, factor=1.0).collect()))
    want = by_all_pairs(rows, 20, 20)
    assert [g[:3] for g in got] == [w[:3] for w in want] and [g[3] for g in got] == [w[3] for w in want]


@pytest.mark.parametrize(("dim", "spread"), [(16, 0.3), (4, 0.05)])
def test_pruning_and_recall(spark, monkeypatch, dim, spread):
    monkeypatch.setattr(vt, "SHARD_BYTES", 300 * 8 * dim)
    monkeypatch.setattr(vt, "SAMPLE_BYTES", 1000 * 8 * dim)
    rows = table(3000, dim, spread=spread)
    df = spark.createDataFrame(rows, SCHEMA)
    want = {(q, i) for q, _, i, _ in by_all_pairs(rows, 100, 20)}
    got = vt.nearest(df, F.col("vec_id") % 100 == 0, k=20).collect()
    assert len({(r.query_id, r.vec_id) for r in got} & want) >= 0.9 * len(want)
    assert len(got) == len(want)


def test_larger_factors_look_at_fewer_pairs():
    x = np.array([r[1] for r in table(2000, 8, spread=0.2)])
    longest = float((x**2).sum(axis=1).max())
    tree, seen = vt.build(vt.lifted(x, longest), leaf=32), []
    for factor in (1.0, 2.0, 4.0):
        search = vt.Search(np.arange(len(x)), x, tree, longest, 5, factor)
        search.run(np.arange(50), x[:50], np.full(50, np.inf))
        seen.append(search.scanned)
    assert seen[0] > seen[1] > seen[2] and seen[0] < 50 * len(x)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(20, None), (40, [0.0, 0.0]), (60, [1.0, None]), (80, [nan, 1.0]), (100, [inf, 1.0]), (None, [1.0, 1.0]), (3, [1.0, 2.0, 3.0]), (5, [])]
    good = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [-1.0, 0.5]), (120, [2.0, 0.0])]
    df = spark.createDataFrame([(i, x, 1) for i, x in odd + good], SCHEMA)
    got = sorted(map(tuple, vt.nearest(df, F.col("vec_id") % 20 == 0, k=3).collect()))
    assert got == [(0, 1, 1, 2.0), (0, 2, 120, 2.0), (0, 3, 2, -1.0), (120, 1, 1, 4.0), (120, 2, 0, 2.0), (120, 3, 2, -2.0)]
    assert vt.nearest(df.limit(0), F.lit(True)).count() == 0
    assert vt.nearest(df.filter("vec_id = 0"), F.lit(True)).count() == 0


def test_thinning_loses_no_neighbour():
    ids, x = vt.thinned(np.array([7] * 50 + list(range(40))), np.ones((90, 2)), k=3)
    for query in (7, 0, 1, 99):
        assert sorted(ids[ids != query])[:3] == sorted(i for i in [7] * 50 + list(range(40)) if i != query)[:3]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_whole_table(spark, folder):
    from loanscope.llm import queries

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want = {(q, i): s for q, _, i, s in by_all_pairs(rows, 20, 20)}
    got = {(r.query_id, r.vec_id): r.score for r in queries.queries()["op13_neighbours"](spark, folder).collect()}
    assert len(got.keys() & want.keys()) >= 0.9 * len(want) and all(got[p] == want[p] for p in got.keys() & want.keys())
