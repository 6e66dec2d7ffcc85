"""Words and shingles against plain Python."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from loanscope.llm.words import find_words, hash_words, shingle_sets, text_bytes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbé \n\t\x0b ß한", max_size=30)), max_size=12)


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda c: c[0].lower(), text)


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_words(texts):
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    starts, ends, first = find_words(data, offsets)
    found = [[bytes(data[a:b]).decode() for a, b in zip(starts[i:j], ends[i:j])] for i, j in zip(first, first[1:])]
    assert found == [WORD.findall(t or "") for t in texts]
    hashes = hash_words(data, starts, ends, lower=True)
    words = [lower(w) for ws in found for w in ws]
    assert len(set(hashes.tolist())) == len(set(words))
    assert all((a == b) == (x == y) for a, x in zip(hashes, words) for b, y in zip(hashes, words))


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 4))
def test_shingle_sets(texts, width):
    sizes = {}
    for i, j, hashes, at in shingle_sets(pa.array(texts, pa.string()), width):
        for k in range(j - i):
            own = hashes[at[k] : at[k + 1]]
            assert (np.diff(own.astype(object)) > 0).all()
            sizes[i + k] = len(own)
    for k, t in enumerate(texts):
        words = WORD.findall(lower(t or ""))
        whole = {tuple(words)} if words else set()
        expected = {tuple(words[a : a + width]) for a in range(len(words) - width + 1)} if len(words) >= width else whole
        assert sizes[k] == len(expected)


def test_sliced_and_null_columns():
    column = pa.array(["x y", None, "z", ""], pa.string()).slice(1, 2)
    data, offsets = text_bytes(column)
    assert bytes(data) == b"z" and offsets.tolist() == [0, 0, 1]
    assert text_bytes(pa.array([], pa.string()))[1].tolist() == [0]
