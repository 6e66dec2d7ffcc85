"""Toxicity scores from a factorization machine over hashed terms.

Terms are the letter runs of the whole text in lower case and their first 4 and 5 bytes (stems of inflected insults),
each hashed to one of BUCKETS places. score = logistic(b + sum w_i + sum over pairs <v_i, v_j>) over the distinct places
of a text, so that a pair of terms, such as an insult beside the mention of a group, can weigh more or less than its
parts. All terms of the sample are examined, and there is no limit on how many count: a place gets a weight and factors
if it tells the labels apart beyond chance, by itself or with another term. For the latter the sample's pair sums, toxic
less clean, are examined by their leading eigenvectors, in which such pairs stand out even if each of their terms is
neutral alone; the factors start from them. All other places keep 0. Labels are read only of documents that are
not held out; identifier, language and source are no inputs. The fit takes a bounded sample of at most SAMPLE documents
of each label (a parameter).

Null and empty texts have no terms and score logistic(b). Repeated rows give repeated results, equal texts equal scores.
Of several labels of a document the smallest counts. An empty table gives no rows. Without toxic or without clean labels
every score is 0. Other columns of the table are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loanscope.llm.samples import held_out, labelled, sample
from loanscope.llm.words import NO_LETTER, blocks, find_words, hash_words, text_bytes

SAMPLE = {0: 8000, 1: 4000}
#: Places of hashed terms, a power of two.
BUCKETS = 1 << 17
#: Standard deviations above chance, and root mean squares of an eigenvector, from which a place counts.
ALONE, PAIRED = 4.0, 12.0
FACTORS = 6
STEMS = (4, 5)


def terms(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks (i, j, places, owner) of all terms, repeated ones too; owner counts from the block's first text."""
    data, offsets = text_bytes(column)
    for i, j in blocks(offsets):
        piece, own = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, first = find_words(piece, own, NO_LETTER)
        owner = np.repeat(np.arange(j - i), np.diff(first))
        out, whose = [hash_words(piece, starts, ends, lower=True)], [owner]
        for n in STEMS:
            longer = ends - starts > n
            out.append(hash_words(piece, starts[longer], starts[longer] + n, lower=True) + np.uint64(n))
            whose.append(owner[longer])
        yield i, j, np.concatenate(out) & np.uint64(BUCKETS - 1), np.concatenate(whose)


@dataclass
class Model:
    keys: np.ndarray  # ascending places of the known terms
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def __post_init__(self) -> None:
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.keys & np.uint64(0xFFFF)).astype(np.int64)] = True

    def known(self, places: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (owner, term number) pairs of the known terms."""
        hit = self.maybe[(places & np.uint64(0xFFFF)).astype(np.int64)]
        places, owner = places[hit], owner[hit]
        at = np.minimum(np.searchsorted(self.keys, places), max(len(self.keys) - 1, 0))
        same = self.keys[at] == places if len(self.keys) else np.zeros(len(places), bool)
        pair = np.unique(owner[same] * len(self.keys) + at[same])
        return pair // max(len(self.keys), 1), pair % max(len(self.keys), 1)

    def scores(self, n: int, owner: np.ndarray, term: np.ndarray) -> np.ndarray:
        z = self.bias + np.bincount(owner, self.linear[term], n)
        for f in range(self.factors.shape[1]):
            v = self.factors[term, f]
            z += (np.bincount(owner, v, n) ** 2 - np.bincount(owner, v * v, n)) / 2
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def even(label: np.ndarray) -> np.ndarray:
    """Weights of the documents by which both labels have half of the whole."""
    return np.where(label == 1, 0.5 / max((label == 1).sum(), 1), 0.5 / max((label == 0).sum(), 1))


class Sparse:
    """A matrix of 0 and 1 by the row and column of each 1; products work column by column."""

    def __init__(self, row: np.ndarray, column: np.ndarray, shape: tuple[int, int]):
        self.row, self.column, self.shape = row, column, shape

    @property
    def T(self) -> Sparse:
        return Sparse(self.column, self.row, self.shape[::-1])

    def __matmul__(self, other: np.ndarray) -> np.ndarray:
        if other.ndim == 1:
            return np.bincount(self.row, other[self.column], self.shape[0])
        return np.stack([self @ np.ascontiguousarray(c) for c in other.T], axis=1)

    def columns(self, chosen: np.ndarray) -> Sparse:
        at = np.full(self.shape[1], -1)
        at[chosen] = np.arange(len(chosen))
        hit = at[self.column] >= 0
        return Sparse(self.row[hit], at[self.column[hit]], (self.shape[0], len(chosen)))


def alone(x: Sparse, label: np.ndarray, bar: float = ALONE) -> np.ndarray:
    """Which columns have shares in toxic and clean documents that differ by more than `bar` standard deviations of chance."""
    pos, neg = (label == 1).sum(), (label == 0).sum()
    gap = x.T @ np.where(label == 1, 1 / pos, -1 / neg)
    share = x.T @ np.full(len(label), 1 / len(label))
    return np.abs(gap) > bar * np.sqrt(np.maximum(share * (1 - share), 0) * (1 / pos + 1 / neg)) + 1e-9


def paired(x: Sparse, label: np.ndarray, high: float = PAIRED, rounds: int = 8) -> np.ndarray:
    """Leading eigenvectors of the pair sums, toxic less clean, of the centred columns, by subspace iteration.

    A pair of a column with itself counts nothing. Entries below `high` root mean squares of their vector, or half of its
    largest if that is less, are 0.
    """
    weight = even(label)
    pull, mean = (label - 0.5) * weight, x.T @ weight
    own = (x.T @ pull) * (1 - 2 * mean) + mean * mean * pull.sum()

    def times(v: np.ndarray) -> np.ndarray:
        s = x @ v - mean @ v
        return x.T @ (pull[:, None] * s) - np.outer(mean, pull @ s) - own[:, None] * v

    block = np.random.default_rng(0).normal(size=(x.shape[1], min(2 * FACTORS, x.shape[1])))
    for _ in range(rounds):
        block = np.linalg.qr(times(block))[0]
    inner = block.T @ times(block)
    size, turn = np.linalg.eigh((inner + inner.T) / 2)
    best = np.argsort(-size)[:FACTORS]
    out = np.zeros((x.shape[1], FACTORS))
    out[:, : len(best)] = block @ turn[:, best] * (size[best] > 0)
    high_enough = np.minimum(high * np.sqrt((out * out).mean(axis=0)), np.abs(out).max(axis=0) / 2)
    return np.where(np.abs(out) >= high_enough, out, 0)


def fit_machine(
    x: np.ndarray | Sparse, label: np.ndarray, ridge: float = 2e-4, steps: int = 150, rate: float = 0.05, start: np.ndarray | float = 0.0
) -> tuple[float, np.ndarray, np.ndarray]:
    """Adam on the logistic loss, both labels weighted alike; x is 0 or 1, a row for each document.

    start: factors to begin with, to which small random ones are added.
    """
    n, m = x.shape
    rng = np.random.default_rng(0)
    theta = [np.zeros(1, np.float32), np.zeros(m, np.float32), (rng.normal(0, 0.01, (m, FACTORS)) + start).astype(np.float32)]
    weight = even(label).astype(np.float32)
    first, second = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    for step in range(1, steps + 1):
        b, w, v = theta
        sums = x @ v
        z = b[0] + x @ w + (sums**2 - x @ (v * v)).sum(axis=1) / 2
        pull = ((1 / (1 + np.exp(-np.clip(z, -40, 40))) - label) * weight).astype(np.float32)
        slope = [pull.sum(keepdims=True), x.T @ pull + ridge * w, x.T @ (pull[:, None] * sums) - (x.T @ pull)[:, None] * v + ridge * v]
        for k, g in enumerate(slope):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            theta[k] = theta[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return float(theta[0][0]), theta[1].astype(float), theta[2].astype(float)


def fit(docs: DataFrame, labels: DataFrame, most: dict[int, int] | None = None, key: str = "doc_id", text: str = "text") -> Model:
    rows = sample(docs, labelled(labels, "toxic"), most or SAMPLE, key, text)

    def find(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for i, j, places, owner in terms(batch.column(2)):
                pair = np.unique(owner * BUCKETS + places.astype(np.int64))
                at = np.searchsorted(pair, np.arange(j - i + 1) * BUCKETS).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array((pair % BUCKETS).astype(np.int32)))
                yield pa.record_batch([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), lists], names=["doc_id", "label", "terms"])

    found = rows.mapInArrow(find, "doc_id long, label int, terms array<int>").toArrow().sort_by("doc_id")
    label = found.column("label").to_numpy()
    if not (label == 1).any() or not (label == 0).any():
        return Model(np.zeros(0, np.uint64), -40.0, np.zeros(0), np.zeros((0, FACTORS)))
    lists = found.column("terms").combine_chunks()
    owner = np.repeat(np.arange(len(label)), np.diff(lists.offsets.to_numpy()))
    seen, column = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    x = Sparse(owner, column, (len(label), len(seen)))
    start = paired(x, label) if len(seen) else np.zeros((0, FACTORS))
    chosen = np.flatnonzero(alone(x, label) | (start != 0).any(axis=1))
    start = start[chosen] * 0.1 / max(np.abs(start).max(initial=0), 1e-12)
    return Model(seen[chosen].astype(np.uint64), *fit_machine(x.columns(chosen), label, start=start))


def scored(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""

    def task(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            out = np.empty(batch.num_rows)
            for i, j, places, owner in terms(batch.column(1)):
                out[i:j] = model.scores(j - i, *model.known(places, owner))
            yield pa.record_batch([batch.column(0), pa.array(out)], names=["doc_id", "score"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = rows.mapInArrow(task, "doc_id long, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
