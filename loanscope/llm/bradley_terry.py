"""Quality scores from pairwise preferences (Bradley-Terry): logistic loss on feature differences, then a quantile.

Features come from the whole text: shares of character classes and of each ASCII sign, word lengths, distinct and
repeated words and lines. Each preference pairs a document labelled good with one labelled bad; the weights are the
ones under which good documents most likely win. A document's strength is its weighted sum. The share of bad labels
gives the quantile of strengths at which a document is rejected, and the score is a logistic function of the distance
to that threshold, moved so that the threshold itself has the score CUT.

Labels are read only of documents that are not held out; identifier, language and source are no inputs. The fit takes
all labelled documents: dealt by a hash, they meet in blocks of about BLOCK, and every pair of both labels in a block is a
preference. Tasks add up slope and curvature of the loss, the driver solves for each Newton step. The threshold is the
quantile of the strengths of all of them. Null and empty texts have
all features zero and get a score like any other. Without labels of both kinds every score is 0.5.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loanscope.llm.samples import held_out, labelled
from loanscope.llm.shared import bloom, in_bloom, lean, written
from loanscope.llm.words import blocks, find_words, hash_words, text_bytes

#: Documents that are compared with each other, on average.
BLOCK = 512
#: Ranges per step of the search for a quantile.
BINS = 4096
CUT = 0.3

_GROUP = np.empty(256, np.int64)
_GROUP[:] = 0  # control characters
_GROUP[0x21:0x7F] = np.arange(1, 95)  # every sign for now
_GROUP[0x30:0x3A], _GROUP[0x41:0x5B], _GROUP[0x61:0x7B] = 95, 96, 97
_GROUP[0x20], _GROUP[0x0A], _GROUP[0x80:0xC0], _GROUP[0xC0:] = 98, 99, 100, 101
_USED = np.unique(_GROUP)
_GROUP = np.searchsorted(_USED, _GROUP)
N_GROUPS = len(_USED)
N_FEATURES = 2 * N_GROUPS + 8


def features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """Blocks (i, j, matrix) with a row of features for each text."""
    data, offsets = text_bytes(column)
    for i, j in blocks(offsets):
        piece, own = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        n, size = j - i, np.diff(own)
        doc = np.repeat(np.arange(n), size)
        share = np.bincount(doc * N_GROUPS + _GROUP[piece], minlength=n * N_GROUPS).reshape(n, N_GROUPS) / np.maximum(size, 1)[:, None]
        starts, ends, first = find_words(piece, own)
        words = np.diff(first)
        owner = np.repeat(np.arange(n), words)
        hashes = hash_words(piece, starts, ends, lower=True)
        again = np.zeros(len(hashes), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
        order = np.lexsort((hashes, owner))
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
        per_word = np.maximum(words, 1)
        length = np.bincount(owner, ends - starts, n) / per_word
        upper = (piece[starts] >= 0x41) & (piece[starts] <= 0x5A) if len(starts) else np.zeros(0, bool)
        single = ends - starts == 1
        more = np.column_stack([
            np.log1p(size), length, np.bincount(owner, again, n) / per_word, np.bincount(owner[order], fresh, n) / per_word,
            np.bincount(owner, upper, n) / per_word, np.bincount(owner, single, n) / per_word, words == 0, np.log1p(words),
        ])
        yield i, j, np.hstack([share, np.sqrt(share), more])


@dataclass
class Model:
    """score = logistic(weights . features - threshold) with CUT at the threshold."""

    weights: np.ndarray
    threshold: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(x @ self.weights - self.threshold + np.log(CUT / (1 - CUT)), -40, 40)
        return 1 / (1 + np.exp(-z))


def pair_sums(x: np.ndarray, label: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Number, slope and curvature at w of the logistic loss over all pairs (good, bad) of some documents, as one vector."""
    size = x.shape[1]
    good, bad = x[label == 1], x[label == 0]
    if not len(good) or not len(bad):
        return np.zeros(1 + size + size * size)
    z = np.clip((good @ w)[:, None] - (bad @ w)[None, :], -40, 40)
    p = 1 / (1 + np.exp(z))  # how surprising each preference still is
    slope = good.T @ p.sum(axis=1) - bad.T @ p.sum(axis=0)
    q = p * (1 - p)
    cross = good.T @ (q @ bad)
    curve = (good * q.sum(axis=1)[:, None]).T @ good + (bad * q.sum(axis=0)[:, None]).T @ bad - cross - cross.T
    return np.concatenate([[len(good) * len(bad)], slope, curve.ravel()])


def newton(sums: Callable[[np.ndarray], np.ndarray], scale: np.ndarray, ridge: float = 1e-3, steps: int = 25) -> np.ndarray:
    """Weights at the least loss; `sums` gives pair_sums over all blocks, of features divided by scale."""
    w = np.zeros(len(scale))
    for _ in range(steps):
        total = sums(w)
        n = max(total[0], 1.0)
        slope = total[1 : 1 + len(w)] / n - ridge * w
        curve = total[1 + len(w) :].reshape(len(w), -1) / n + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w = w + step * min(1.0, 30.0 / max(np.abs(step).sum(), 1e-9))
        if np.abs(step).max() < 1e-4:
            break
    return w / scale


def _scale(spread: np.ndarray) -> np.ndarray:
    return np.where(spread > 1e-9, spread, np.inf)


def fit_pairs(x: np.ndarray, label: np.ndarray, bad_share: float) -> Model:
    """The fit over all pairs of documents in memory; the threshold is the quantile bad_share."""
    if not (label == 1).any() or not (label == 0).any():
        return Model(np.zeros(x.shape[1]), float(np.log(CUT / (1 - CUT))))
    scale = _scale(x.std(axis=0))
    w = newton(lambda w: pair_sums(x / scale, label, w), scale)
    strength = np.sort(x @ w)
    at = min(max(int(np.ceil(bad_share * len(strength))) - 1, 0), len(strength) - 2)
    return Model(w, float((strength[at] + strength[at + 1]) / 2))


def _summed(rows: DataFrame, width: int, act: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of act(features, labels) over the blocks, each a run of rows in one task; a vector per task comes to the driver."""

    def task(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, block = np.zeros(width), [], None

        def add() -> None:
            nonlocal total
            y, x = (np.concatenate(part) for part in zip(*held))
            for k in range(0, len(y), 2 * BLOCK):  # a block with more rows holds documents of one identifier
                total = total + act(x[k : k + 2 * BLOCK].astype(float), y[k : k + 2 * BLOCK])
            held.clear()

        for batch in source:
            blocks_, y = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)
            for a, b in itertools.pairwise([0, *(np.flatnonzero(np.diff(blocks_)) + 1), len(y)]):
                if held and blocks_[a:b].tolist()[:1] != [block]:
                    add()
                if b > a:
                    block = int(blocks_[a])
                    held.append((y[a:b], x[a:b]))
        if held:
            add()
        yield pa.record_batch([pa.array([total], pa.list_(pa.float64()))], names=["v"])

    found = rows.select("block", "label", "x").mapInArrow(lean(task), "v array<double>").toArrow().column("v")
    return sum((np.asarray(v) for v in found.to_pylist()), np.zeros(width))


def quantile_between(strengths: DataFrame, rank: int) -> float:
    """Middle between the rank-th and the next smallest `s`, counted from 1; ranges are narrowed until few rows are left."""

    def value(k: int) -> float:
        low, high, below = *strengths.agg(F.min("s"), F.max("s")).first(), 0
        while high > low:
            inside = strengths.filter(F.col("s").between(low, high))
            step = (high - low) / BINS
            place = F.least(F.floor((F.col("s") - low) / step), F.lit(BINS - 1))
            counts = inside.groupBy(place.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("low"), F.max("s").alias("high"))
            for row in sorted(counts.collect(), key=lambda row: row.b):
                if below + row.n >= k:
                    if (row.low, row.high) == (low, high):
                        return low  # neighbouring doubles
                    low, high = row.low, row.high
                    break
                below += row.n
        return low

    return (value(rank) + value(rank + 1)) / 2


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    known = written(labelled(labels, "quality").select(F.col("doc_id").cast("long").alias("doc_id"), "label"))
    table = bloom(known.select(F.xxhash64("doc_id").alias("h"))).table
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def task(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            batch = batch.filter(pa.array(in_bloom(table.value, batch.column(2).to_numpy().view(np.uint64))))
            for i, j, x in features(batch.column(1)):
                cells = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel().astype(np.float32)), N_FEATURES).cast(pa.list_(pa.float32()))
                yield pa.record_batch([batch.column(0).slice(i, j - i), cells], names=["doc_id", "x"])

    # texts stay where they are: what passes the filter is joined by its features; the filter runs inside the task, as a
    # second Python step would double the workers of every later stage
    read = rows.select("*", F.xxhash64("doc_id")).mapInArrow(lean(task), "doc_id long, x array<float>").join(known, "doc_id")
    # a block is one row, so no task gets a part of it
    block = F.pmod(F.xxhash64("doc_id"), F.lit(max(1, known.count() // BLOCK))).alias("block")
    stored = written(read.groupBy(block).agg(F.sort_array(F.collect_list(F.struct("doc_id", "label", "x"))).alias("rows")))
    seen = stored.select("block", F.inline("rows"))
    counts = {r.label: r["count"] for r in seen.groupBy("label").count().collect()}
    if len(counts) < 2:
        return Model(np.zeros(N_FEATURES), float(np.log(CUT / (1 - CUT))))
    n = sum(counts.values())
    moments = _summed(seen, 2 * N_FEATURES, lambda x, y: np.concatenate([x.sum(axis=0), (x * x).sum(axis=0)])) / n
    mean, square = moments[:N_FEATURES], moments[N_FEATURES:]
    spread = np.maximum(square - mean * mean, 0)
    scale = _scale(np.sqrt(np.where(spread > 1e-9 * square, spread, 0)))  # less is rounding
    w = newton(lambda w: _summed(seen, 1 + N_FEATURES + N_FEATURES**2, lambda x, y: pair_sums(x / scale, y, w)), scale)

    def strength(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)
            yield pa.record_batch([pa.array(x.astype(float) @ w)], names=["s"])

    strengths = written(seen.select("x").mapInArrow(lean(strength), "s double"))
    return Model(w, quantile_between(strengths, counts[0]))


def scored(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""

    def task(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            out = np.empty(batch.num_rows)
            for i, j, x in features(batch.column(1)):
                out[i:j] = model.scores(x)
            yield pa.record_batch([batch.column(0), pa.array(out)], names=["doc_id", "score"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = rows.mapInArrow(lean(task), "doc_id long, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of `docs` that score at least CUT, in one pass over them."""

    @F.pandas_udf("boolean")
    def good(texts):
        import pandas as pd

        out = np.empty(len(texts), bool)
        for i, j, x in features(pa.array(texts, pa.string())):
            out[i:j] = model.scores(x) >= CUT
        return pd.Series(out)

    return docs.filter(good(F.col(text).cast("string")))
