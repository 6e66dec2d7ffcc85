from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from loanscope.llm import semi_markov
from loanscope.llm.semi_markov import KINDS, Lattice, Model, base_spans, luhn

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ODD = (
    "mail a@b@c.de, x.y+z@q-r.co.uk. ip 1.2.3.4.5 300.1.1.1 255.255.255.255 0.0.0.01 é 4111 1111 1111 1111 and "
    "4111-1111-1111-1112 +49 (30) 123456-78 call (202) 555-0133 now + 1 a@@b.c @ ٣٤ " + "9" * 5000
)


def plain(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(p[-9:]) < 256 and len(p.lstrip("0")) < 4 for p in m[0].split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.@-+ (2%4é\n", max_size=60))
def test_base_patterns(text):
    assert base_spans(text) == plain(text)


def test_known_values():
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    assert base_spans(ODD) == plain(ODD) and len(plain(ODD)) == 7


def test_sums_and_best_path_against_all_segmentations():
    rng = np.random.default_rng(1)
    model = Model(rng.normal(size=(5, semi_markov.N_FEATURES)), rng.normal(size=(5, 5)))
    text = "call +1 (202) 555"
    words = [m.span() for m in re.finditer(r"\S+", text)]
    lattice = Lattice.of(text, words)
    scores = lattice.scores(model.weights)
    place = {seg: k for k, seg in enumerate(lattice.segments)}

    def paths(i):
        if i == len(words):
            yield []
        for j in range(i + 1, len(words) + 1):
            for t in range(5):
                if scores[place[i, j], t] > -1e8:
                    yield from ([(i, j, t), *rest] for rest in paths(j))

    def score(path):
        return sum(scores[place[i, j], t] for i, j, t in path) + sum(model.moves[a[2], b[2]] for a, b in zip(path, path[1:]))

    every = list(paths(0))
    top = max(every, key=score)
    assert model.best(lattice) == [s for s in top if s[2] != semi_markov.OUTSIDE]
    weight = np.exp([score(p) for p in every])
    p, moved = model.expected(lattice)
    for (i, j), k in place.items():
        for t in range(5):
            assert p[k, t] == pytest.approx(sum(w for w, path in zip(weight, every) if (i, j, t) in path) / weight.sum(), abs=1e-9)
    assert moved.sum() == pytest.approx(sum(w * (len(path) - 1) for w, path in zip(weight, every)) / weight.sum())


def test_training_finds_base_spans_again():
    texts = [f"write to a{k}@mail{k}.example.org today" for k in range(30)] + [f"host 10.{k}.3.{k} is up" for k in range(30)] + [f"call +1 ({200 + k}) 555-01{k:02d} now" for k in range(30)]
    model = semi_markov.train(texts)
    found = []
    for text in ["mail z9@host.example.net please", "the host 8.8.4.4 fails", "or call +1 (999) 555-0199 again"]:
        words = [m.span() for m in re.finditer(r"\S+", text)]
        found += [(KINDS[t], text[words[i][0] : words[j - 1][1]]) for i, j, t in model.best(Lattice.of(text, words))]
    assert found == [("email", "z9@host.example.net"), ("ip", "8.8.4.4"), ("phone", "+1 (999) 555-0199")]


def test_table(spark, sf_dir):
    odd = spark.createDataFrame([(-1, None, 1), (-2, "", 1), (-3, ODD, 1), (-3, ODD, 1), (None, "no marks", 1), (-4, "a1 " * 3000, 1)], "doc_id long, text string, spans int")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", "text", "1 as spans").unionAll(odd)
    rows = {r.doc_id: r for r in semi_markov.personal_data(docs, semi_markov.fit(docs, most=100)).collect()}
    for r in docs.collect():
        base, own = plain(r.text or ""), rows[r.doc_id]
        listed = [f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(base)]
        assert own.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [own[f"n_{k}"] for k in KINDS] == [sum(n == k for n, _, _ in base) for k in range(4)]
        assert set(listed) <= set(own.spans.split(",")) | {""} and own.n_added == len([s for s in own.spans.split(",") if s]) - len(listed)
    none = docs.limit(0)
    assert semi_markov.personal_data(none, semi_markov.fit(none)).count() == 0
