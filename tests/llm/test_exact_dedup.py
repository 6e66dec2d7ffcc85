from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from loanscope.llm import trie_dedup
from loanscope.llm.trie_dedup import Owner, PatriciaTrie

ROWS = [
    (1, "a b", "x", "s"), (2, "ab", "x", "s"), (3, "a  b", "x", "s"), (4, None, "x", "s"), (5, "", "x", "s"), (6, " \n", "x", "s"),
    (7, "é ", "x", "s"), (8, "é", "x", "s"), (9, "long " * 30000, None, None), (10, "long" * 30000, None, None),
    (11, "same", "x", "s"), (11, "same", "x", "s"), (None, "ab", "x", "s"), (None, "only", "x", "s"), (12, "x", "t", "u"),
]
SCHEMA = "doc_id long, text string, digest string, n_bytes string"


def expected(rows):
    groups = defaultdict(list)
    for ident, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), ident is None, ident or 0))
    out = Counter()
    for ident, text, *_ in rows:
        own = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        best = min(groups[own])
        out[ident, None if best[1] else best[2], len(groups[own]), hashlib.sha256(own.encode()).hexdigest()] += 1
    return out, len(groups)


def test_groups(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    for size in (1 << 20, 200):  # the second spills
        rows = trie_dedup.exact_groups(docs, trie_bytes=size).collect()
        want, n = expected(ROWS)
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == want
        assert sum(r.kept for r in rows) == n


def test_drop_copies(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumn("__x", F.lit(1))
    kept = trie_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    _, n = expected(ROWS)
    texts = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in kept.collect()]
    assert len(texts) == len(set(texts)) == n


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert trie_dedup.exact_groups(docs).count() == trie_dedup.drop_copies(docs).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=12) | st.sampled_from([b"aaaa", b"aaab", b"aa", b""]), max_size=60), st.sampled_from([1, 700, 5000, 1 << 20]))
def test_trie_with_spill(keys, most):
    trie = PatriciaTrie(most)
    for k, key in enumerate(keys):
        trie.insert(key, Owner(1, 0, k, b"d"))
    found = sorted((text, o.rows, o.ident) for text, o in trie.owners())
    assert found == sorted((key, n, keys.index(key)) for key, n in Counter(keys).items())


def test_long_key_is_spilled():
    trie, digest = trie_dedup.PatriciaTrie(200_000), b"d" * 32
    keys = [b"x" * 150_000, *(b"y%06d" % i + b"z" * 300 for i in range(3000)), b"x" * 150_000 + b"more", b"x"]
    for n, key in enumerate(keys):
        trie.insert(key, trie_dedup.Owner(1, len(key), n, digest))
        assert trie.held < 200_000 + 160_000
    assert trie.held <= 200_000
    assert sorted(text for text, _ in trie.owners()) == sorted(keys)
