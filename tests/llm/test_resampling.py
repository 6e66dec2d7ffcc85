from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st

from loanscope.llm import importance_resampling as ir

WORDS = " ".join(f"w{i}" for i in range(30))
DOCS = [
    (1, "The cat sat on the mat. " * 5, 7), (2, None, 7), (3, "", 7), (4, WORDS, 7), (4, WORDS, 7), (5, "É\x00x é X " * 9, 7),
    (None, WORDS + " more", 7), (None, None, 7), (6, "a-b_c1 " * 3000, 7), (7, "one two", 7),
] + [(8, "copy " * 25, 7)] * 40 + [(i, f"text number {i} " * 8, 7) for i in range(100, 140)]


def plain(docs, target, n, percent, least, buckets):
    """doc_id, n_features, weight, score, rank by definition."""
    def grams(text):
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)
        return words, [" ".join(words[i:i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]

    def bucket(gram):
        return zlib.crc32(gram.encode()) % buckets

    s = Counter(bucket(g) for _, text, *_ in docs for g in grams(text)[1])
    t = Counter(bucket(g) for text in target for g in grams(text)[1])
    S, T = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text, *_ in docs:
        words, found = grams(text)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in map(bucket, found)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)))
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0], r[1], r[2]))
    ranks = {}
    for place, row in enumerate(able[: len(able) * percent // 100], 1):
        ranks.setdefault(row, []).append(place)
    return sorted(((*row[:4], ranks[row].pop() if ranks.get(row) else None) for row in out), key=str)


@pytest.mark.parametrize(("n", "percent", "least"), [(1, 10, 20), (3, 50, 2), (2, 100, 1), (1, 0, 20)])
def test_against_definition(spark, n, percent, least):
    target = ["the cat and the hat", None, "", "copy that"]
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, score int").repartition(5)
    want = plain(DOCS, target, n, percent, least, 500)
    rows = ir.resampled(docs, spark.createDataFrame([(t,) for t in target], "text string"), most_words=n, buckets=500, percent=percent, least_words=least)
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in rows.collect()), key=str) == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a " * 30)], "doc_id long, text string")
    assert ir.resampled(none, some).count() == 0
    assert ir.resampled(some, none, percent=100).first()["rank"] == 1


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aB9 .\x00é\n", max_size=12), min_size=1, max_size=6), st.integers(1, 4))
def test_no_run_crosses_texts(texts, n):
    lowered = [t.encode().translate(ir._LOWER) for t in texts]
    owner, bucket, words = ir.features(lowered, n, 1 << 32)
    want = Counter()
    for i, text in enumerate(lowered):
        found = re.findall(rb"[0-9a-z\x80-\xff]+", text)
        assert words[i] == len(found)
        want += Counter((i, zlib.crc32(b" ".join(found[j:j + k]))) for k in range(1, n + 1) for j in range(len(found) - k + 1))
    assert Counter(zip(owner.tolist(), bucket.tolist())) == want


def test_batches_are_bounded_by_bytes():
    groups = list(ir.joined(iter(["x" * 400] * 10), most=1000))
    assert [len(g) for g in groups] == [3, 3, 3, 1]
