"""What keeps Python workers small: Arrow batches, one Python step per stage, memory handed back."""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from loanscope.llm import agenda_bpe, bradley_terry
from loanscope.llm.shared import BATCH_BYTES, BATCH_ROWS, tuned
from tests.llm.test_pieces import CODEC

NAMES = [f"spark.sql.execution.arrow.{name}" for name in ("maxRecordsPerBatch", "maxBytesPerBatch")]


@pytest.fixture
def fresh(spark):
    """The session as if nobody had set the sizes of its batches."""
    before = [spark.conf.get(name, None) for name in NAMES]
    for name in NAMES:
        spark.conf.unset(name)
    yield spark
    for name, value in zip(NAMES, before):
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def sizes(source):
    for batch in source:
        yield pa.record_batch([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])


def test_batches_of_a_fresh_session_are_small(fresh):
    rows = tuned(fresh).range(0, 4 * BATCH_ROWS, 1, 1)
    assert {r.n for r in rows.mapInArrow(sizes, "n long, size long").collect()} == {BATCH_ROWS}
    long = rows.selectExpr("repeat('x', 100000) as text").mapInArrow(sizes, "n long, size long").collect()
    assert sum(r.n for r in long) == 4 * BATCH_ROWS and max(r.size for r in long) < 2 * BATCH_BYTES


def test_sizes_that_the_session_sets_stay(fresh):
    for name, value in zip(NAMES, ("70", "1000000b")):
        fresh.conf.set(name, value)
    tuned(fresh)
    assert [fresh.conf.get(name) for name in NAMES] == ["70", "1000000b"]


def test_fit_has_one_python_step_a_stage(spark):
    """The filter is asked inside the task; as a function of its own it would have a second worker for each task."""
    docs = spark.createDataFrame([(n, "good plain words" if n % 3 else "BAD!!") for n in range(300)] + [(None, None)], "doc_id long, text string")
    known = docs.limit(200).selectExpr("doc_id", "cast(doc_id % 3 > 0 as int) as quality")
    want = bradley_terry.fit(docs, known)
    bloom = bradley_terry.bloom
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(bradley_terry, "bloom", lambda keys: SimpleNamespace(table=bloom(keys).table))  # can't be called
        found = bradley_terry.fit(docs, known)
    assert np.allclose(found.weights, want.weights) and np.isclose(found.threshold, want.threshold)
    assert bradley_terry.scored(docs, found).filter("doc_id is not null and (doc_id % 3 > 0) <> (predicted = 1)").count() == 0


def test_blocks_hand_memory_back():
    column = pa.array(["some words of a text "] * 200 + [None, ""])
    back = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(agenda_bpe, "hand_back", lambda: back.append(1))
        patch.setattr(agenda_bpe, "BLOCK", 1000)
        assert len(list(agenda_bpe.encoded(column, CODEC, 1))) == 202
    assert len(back) >= 4
