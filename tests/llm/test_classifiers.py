"""Held-out accuracy of both classifiers, and what they do with odd rows."""

from __future__ import annotations

import binascii

import numpy as np
import pyarrow as pa
import pytest

from loanscope.llm import bradley_terry, factorization_machine, queries

SF = "/root/testdata/sf0.1"
ODD = [(1, None, "x"), (2, "", "x"), (3, "a " * 50000, "x"), (3, "a " * 50000, "x"), (None, "idiot", "x"), (4, "\U0001F600 é", None)]


@pytest.mark.parametrize("name, label, least", [("op2_quality", "quality", 0.97), ("op4_toxicity", "toxic", 0.95)])
def test_held_out_accuracy(spark, name, label, least):
    rows = queries.queries()[name](spark, SF)
    assert rows.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    found = rows.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    assert found.score.between(0, 1).all()
    assert ((binascii_mod(found.doc_id) == 0) == found.held_out).all()
    held = found[found.held_out]
    assert (held.predicted == held[label]).mean() >= least
    assert len(held) > 500 and all((found.predicted == 1) == (found.score >= (0.3 if label == "quality" else 0.5)))
    for value in (0, 1):
        assert (held[held[label] == value].predicted == value).mean() >= 0.8


def binascii_mod(ids):
    return ids.map(lambda i: binascii.crc32(str(i).encode()) % 5)


@pytest.mark.parametrize("module, target", [(bradley_terry, "quality"), (factorization_machine, "toxic")])
def test_odd_rows_and_labels(spark, module, target):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, label string")
    for rows in ([], [(2, 1)], [(2, 1), (3, 0), (3, 1), (None, 1), (1, None), (99, 0)]):
        labels = spark.createDataFrame(rows, f"doc_id long, {target} int")
        found = module.scored(docs, module.fit(docs, labels)).collect()
        assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
        assert len({r.score for r in found if r.doc_id == 3}) == 1
    none = spark.createDataFrame([], docs.schema)
    assert module.scored(none, module.fit(none, labels)).count() == 0


def test_machine_learns_a_pair():
    """Neither term alone is toxic, both together are."""
    x = np.array([[1, 0], [0, 1], [1, 1], [0, 0]] * 50, np.float32)
    y = x.prod(axis=1)
    bias, linear, factors = factorization_machine.fit_machine(x, y, ridge=1e-5, steps=600)
    model = factorization_machine.Model(np.array([1, 2], np.uint64), bias, linear, factors)
    owner, term = np.nonzero(x[:4])
    assert (model.scores(4, owner, term) > 0.5).tolist() == [False, False, True, False]


def test_pairs_order_documents():
    texts = ["good plain words here"] * 30 + ["BAD!! SHOUT!! NOW!!"] * 10
    (_, _, x), = bradley_terry.features(pa.array(texts))
    label = np.array([1] * 30 + [0] * 10)
    model = bradley_terry.fit_pairs(x, label, 0.25)
    assert ((model.scores(x) >= bradley_terry.CUT) == (label == 1)).all()


def test_every_labelled_document_counts(spark):
    """One document among thousands decides whether a feature is known to be bad, and the threshold is theirs all."""
    good = [(n, "good plain words here") for n in range(0, 14_000) ]
    docs = spark.createDataFrame([*good, *((n, "BAD!! SHOUT!!") for n in range(14_000, 14_020))], "doc_id long, text string")
    known = docs.selectExpr("doc_id", "cast(doc_id < 14000 as int) as quality")
    seen = []
    summed = bradley_terry._summed

    def counted(rows, width, act):
        seen.append(rows.count())
        return summed(rows, width, act)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(bradley_terry, "_summed", counted)
        model = bradley_terry.fit(docs, known)
    used = sum(binascii.crc32(str(n).encode()) % 5 != 0 for n in range(14_020))
    assert set(seen) == {used}
    found = bradley_terry.scored(docs, model)
    assert found.filter("(doc_id < 14000) <> (predicted = 1)").count() == 0


def test_quantile_between(spark):
    values = [0.5, -3.0, 0.5, 1e-9, 7.0, 1e9, 0.5, 2e-9]
    rows = spark.createDataFrame([(v,) for v in values], "s double")
    order = sorted(values)
    for rank in range(1, len(values)):
        assert bradley_terry.quantile_between(rows, rank) == (order[rank - 1] + order[rank]) / 2


def test_fit_finds_a_pair_of_neutral_terms(spark):
    """Two words stand in half of the toxic and half of the clean documents each; only together or apart do they tell."""
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(3, 10))) for _ in range(2000)]
    rows, labels = [], []
    for n in range(4000):
        text, first = list(rng.choice(words, 40)), rng.integers(2)
        for word, there in (("gravel", first), ("teapot", first == n % 2)):
            if there:
                text.insert(rng.integers(len(text)), word)
        rows.append((n, " ".join(text)))
        labels.append((n, n % 2))
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = factorization_machine.fit(docs, known)
    found = factorization_machine.scored(docs, model).collect()
    held = [r for r in found if r.held_out]
    assert len(held) > 700 and np.mean([r.predicted == r.doc_id % 2 for r in held]) >= 0.9
    for r in held[:50]:  # every score from the plain sum over terms and pairs
        (_, _, places, owner), = factorization_machine.terms(pa.array([rows[r.doc_id][1]]))
        at = [k for k, key in enumerate(model.keys) if key in set(places)]
        z = model.bias + sum(model.linear[k] for k in at) + sum(model.factors[i] @ model.factors[k] for i in at for k in at if i < k)
        assert abs(r.score - 1 / (1 + np.exp(-z))) < 1e-9
