"""The agenda against the sentencepiece library, and the digests of a table."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from loanscope.llm.agenda_bpe import PieceCodec, token_digests, tokens

PATH = public_tokenizers.path("piece_bpe_32k.model")
CODEC = PieceCodec(PATH)
SMALL = st.text(alphabet="ab the in ▁éß한\n\t\r😀<s>0x;)}", max_size=80)


@settings(max_examples=300, deadline=None)
@given(st.one_of(SMALL, st.text(max_size=60)))
def test_like_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    ids = CODEC.encode(text)
    assert ids == CODEC.library.encode(text, add_bos=True, add_eos=True)
    assert CODEC.decode(ids) == CODEC.library.decode(ids)


@pytest.mark.parametrize("text", ["x" * 3000, " " * 500 + "ab", "ab" * 2000 + " " + "\n" * 100, "supercalifragilistic" * 50, "é" * 700, ""])
def test_long_segments(text):
    assert CODEC.encode(text) == CODEC.library.encode(text, add_bos=True, add_eos=True)


def test_table(spark, sf_dir):
    odd = spark.createDataFrame([(-1, None, 1), (-2, "", 1), (-2, "", 1), (None, "a", 1), (-3, "long " * 50000, 1)], "doc_id long, text string, ids int")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", "text", "1 as ids").unionAll(odd)
    found = sorted(map(str, token_digests(docs, PATH, check_every=1).collect()))
    want = []
    for r in docs.collect():
        ids = CODEC.library.encode(r.text or "", add_bos=True, add_eos=True)
        back = CODEC.library.decode(ids)
        sha = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), back.encode())]
        want.append(f"Row(doc_id={r.doc_id}, n_tokens={len(ids)}, ids_sha256='{sha[0]}', decoded_sha256='{sha[1]}')")
    assert found == sorted(want)
    assert {r.doc_id: r.decoded for r in tokens(odd, PATH).collect()} == {-1: "", -2: "", None: "a", -3: "long " * 50000}
    assert token_digests(odd.limit(0), PATH).count() == 0
