from __future__ import annotations

import itertools
import random

from loanscope.llm import spaced_seeds

SCHEMA = "doc_id long, text string, item_id string, seed string"


def words(rng, n):
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def test_substitutions_and_clean_documents(spark):
    rng = random.Random(2)
    items = [(k, words(rng, n)) for k, n in enumerate([15, 18, 25, 40, 60, 13, 11])]
    bench = [(k, " ".join(w)) for k, w in items] + [(90, "Only Five Words Are Here"), (91, None), (92, ""), (93, "eight words make an item of eight words"), (94, " ".join(items[2][1]).upper() + "!")]
    docs, want = [], set()
    for n in range(120):
        k, item = items[n % len(items)]
        inside = [*item]
        for at in rng.sample(range(len(item)), len(item) // 12):
            inside[at] = "changed"
        before, after = words(rng, rng.choice((0, 3, 200))), words(rng, rng.choice((0, 5)))
        docs.append((n, " ".join([*before, *inside, *after])))
        if len(item) > 11:  # items of 11 tokens allow two substitutions only where a mask ignores them
            want.add((n, k))
    for n in range(200, 240):  # clean: single words and short runs of items
        k, item = items[n % len(items)]
        docs.append((n, " ".join([*words(rng, 40), *item[:6], *words(rng, 30)])))
    docs += [(300, None), (301, ""), (302, "only five words are here."), (303, "only five words are here, and more"), (304, "so eight words make an ITEM of eight words there")]
    docs += [(305, " ".join(items[4][1])), (305, " ".join(items[4][1])), (None, " ".join(items[4][1])), (306, " ".join(items[4][1][20:40]))]
    table = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], SCHEMA)
    found = spaced_seeds.leaks(table, spark.createDataFrame(bench, "item_id long, text string")).collect()
    pairs = [(r.doc_id, r.item_id) for r in found]
    assert len(pairs) == len(set(pairs))
    got = set(pairs)
    assert want <= got
    assert {p for p in got if p[0] is not None and 200 <= p[0] < 300} == set()
    assert {p for p in got if p[0] is None or p[0] >= 300} == {(302, 90), (303, 90), (304, 93), (305, 4), (None, 4), (306, 4)}
    kept = spaced_seeds.drop_leaks(table, spark.createDataFrame(bench, "item_id long, text string"))
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - {p[0] for p in got}


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, "a " * 30, "x", "y")], SCHEMA)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert spaced_seeds.leaks(some, bench).count() == 0 and spaced_seeds.drop_leaks(some, bench).count() == 1
    assert spaced_seeds.leaks(none, some.selectExpr("doc_id as item_id", "text")).count() == 0


def test_repeated_words_are_no_leak(spark):
    docs = spark.createDataFrame([(1, "of, " * 5000, "", ""), (2, "the of and " * 3000, "", "")], SCHEMA)
    bench = spark.createDataFrame([(1, "the cat of the dog and the bird of the tree and of the sea " * 2)], "item_id long, text string")
    assert spaced_seeds.leaks(docs, bench).count() == 0


def patterns(n, need):
    """All substitutions in an item of n tokens of which some 13 tokens in a row (all of a shorter item) agree in `need`."""
    for k in range(4):
        for p in itertools.combinations(range(n), k):
            if any(sum(a <= x < a + 13 for x in p) <= min(13, n) - need for a in range(max(1, n - 12))):
                yield p


def all_patterns_found(spark, lengths):
    rng = random.Random(5)
    items = {n: words(rng, n) for n in lengths}
    docs = [(n, p) for n, need in lengths.items() for p in patterns(n, need)]
    texts = [" ".join([*words(rng, 20), *("changed" if k in p else w for k, w in enumerate(items[n])), *words(rng, 20)]) for n, p in docs]
    table = spark.createDataFrame([(k, t, "x", "y") for k, t in enumerate(texts)], SCHEMA)
    found = spaced_seeds.leaks(table, spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string"))
    missed = {docs[k] for k in range(len(docs))} - {docs[r.doc_id] for r in found.collect() if docs[r.doc_id][0] == r.item_id}
    assert missed == set()


def test_every_accepted_substitution_is_found(spark):
    all_patterns_found(spark, {11: 9, 12: 10, 13: 11, 14: 11, 15: 11, 16: 11})


def test_short_items_with_substitutions_are_found(spark):
    all_patterns_found(spark, {8: 7, 9: 8, 10: 8})


def test_items_without_identifier_are_kept(spark):
    rng = random.Random(7)
    items = [words(rng, n) for n in (16, 20, 9)]
    bench = spark.createDataFrame([(None, " ".join(w)) for w in items] + [(5, " ".join(items[2]))], "item_id long, text string")
    docs = [(k, " ".join([*words(rng, 9), *w, *words(rng, 9)]), "x", "y") for k, w in enumerate(items)] + [(9, " ".join(items[0] + items[1]), "x", "y"), (10, " ".join(words(rng, 50)), "x", "y")]
    table = spark.createDataFrame(docs, SCHEMA)
    found = sorted((r.doc_id, r.item_id or 0, r.item_tokens) for r in spaced_seeds.leaks(table, bench).collect())
    assert found == [(0, 0, 16), (1, 0, 20), (2, 5, 9), (9, 0, 16), (9, 0, 20)]
    assert [r.doc_id for r in spaced_seeds.drop_leaks(table, bench).collect()] == [10]


def test_only_leaking_rows_of_an_identifier_go(spark):
    rng = random.Random(9)
    item = " ".join(words(rng, 20))
    clean = [" ".join(words(rng, 30)) for _ in range(6)]
    docs = [(None, item), (None, clean[0]), (None, clean[1]), (None, None), (7, f"so {item}"), (7, clean[2]), (7, clean[2]), (8, f"so {item}"), (8, f"so {item}"), (9, clean[3])]
    table = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], SCHEMA)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = spaced_seeds.drop_leaks(table, bench)
    assert kept.columns == table.columns
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=key) == sorted((d for d in docs if item not in (d[1] or "")), key=key)
    assert {(r.doc_id, r.item_id) for r in spaced_seeds.leaks(table, bench).collect()} == {(None, 1), (7, 1), (8, 1)}
