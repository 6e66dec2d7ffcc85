"""Benchmark decontamination by spaced-seed hashing.

Tokens are runs of letters and digits in lower case. A mask hashes the tokens at its marked positions and ignores the
others, so a window still matches after substitutions there. Seeds of all benchmark items and of all document positions
are joined on their hashes; around each hit the tokens are laid side by side, and a document is reported with an item
if some WINDOW aligned tokens (or all of a shorter item) agree in at least SHARE of their positions.

The masks were chosen by enumeration for each item length up to WINDOW: whatever positions are substituted in a window
that is still good enough, some mask at some place of the window ignores them all. Longer items hold such a window.

A Bloom filter of fixed size with the items' seeds keeps other positions out of the join, whose matches are exact.
Equal items are one, named by the smallest item_id. Items of 5 to 7 tokens are found at every place where all their
tokens stand, shorter ones only as a document's whole token sequence, since less can't be told from chance. Items and documents without tokens match nothing. Null texts count
as empty. Repeated rows give one row. Rows without identifier keep a null; each item without one is an item of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from loanscope.llm.shared import bloom, in_bloom, lean, split_by_ids, whole, written
from loanscope.llm.words import NO_SIGN, blocks, find_words, hash_words, mix, odd_numbers, text_bytes

#: Items of fewer tokens are found only as a whole document, those of fewer than EXACT tokens only without substitutions.
SHORT, EXACT = 5, 8
WINDOW = 13
SHARE = 0.8
#: Fixed masks by item length, the last for all longer ones: 1 takes part, 0 is ignored.
MASKS = {
    5: ("11111",),
    6: ("111111",),
    7: ("1111111",),
    8: ("110111", "11011001"),
    9: ("1110111", "11011101"),
    10: ("110111", "1101011", "10100111"),
    11: ("1101111", "111100011", "1100011011"),
    12: ("11010111", "1110001011", "10011010011"),
    13: ("111010111", "11010011011", "110011100101"),
}
_TIMES = odd_numbers(64, 31)


def token_hashes(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks (i, j, hashes, first): text i + k has the tokens hashes[first[k] : first[k + 1]]."""
    data, offsets = text_bytes(column)
    for i, j in blocks(offsets):
        piece, own = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, first = find_words(piece, own, NO_SIGN)
        yield i, j, hash_words(piece, starts, ends, lower=True), first


def seeds(hashes: np.ndarray, mask: str) -> np.ndarray:
    """The mask's hash at every position where it fits into the array."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, int(mask, 2) | 1 << 40, np.uint64)
    for k, c in enumerate(mask):
        if c == "1":
            total += hashes[k : k + n] * _TIMES[k]
    return mix(total)


def whole_seed(hashes: np.ndarray) -> np.uint64:
    """Hash of a short text as a whole."""
    return mix(np.array([(hashes * _TIMES[: len(hashes)]).sum() + np.uint64(len(hashes)) + np.uint64(1 << 50)], np.uint64))[0]


def _items(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in source:
        for i, j, hashes, first in token_hashes(batch.column(1)):
            found = [hashes[first[k] : first[k + 1]] for k in range(j - i)]
            yield pa.record_batch(
                [
                    batch.column(0).slice(i, j - i), pa.array([len(h) for h in found], pa.int32()),
                    pa.array([h.tobytes() for h in found], pa.binary()),
                ],
                names=["item_id", "n_tokens", "tokens"],
            )


def _item_seeds(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in source:
        for item, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            h = np.frombuffer(raw, np.uint64)
            masks = MASKS.get(min(len(h), WINDOW), ())
            found = [(seeds(h, m), np.arange(len(h) - len(m) + 1)) for m in masks] or [(np.array([whole_seed(h)]), np.zeros(1, np.int64))]
            out, at = (np.concatenate(x) for x in zip(*found))
            yield pa.record_batch(
                [pa.array(out.astype(np.uint64).view(np.int64)), pa.array(np.full(len(out), item)), pa.array(at.astype(np.int32))], names=["seed", "number", "item_at"]
            )


def _segments(table, lengths: tuple[int, ...]):
    """Stretches of documents around positions whose seeds the filter holds: tokens, seeds and their places.

    lengths: of the items, WINDOW for all that are not shorter.
    """
    masks = sorted({m for n in lengths for m in MASKS.get(n, ())})
    short = any(n < SHORT for n in lengths)

    def task(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            out = []
            for i, j, hashes, first in token_hashes(batch.column(1)):
                doc = np.repeat(np.arange(j - i), np.diff(first))
                hits, places = [], []
                for m in masks:
                    h = seeds(hashes, m)
                    at = np.flatnonzero(in_bloom(table.value, h))
                    at = at[doc[at] == doc[at + len(m) - 1]]
                    hits.append(h[at])
                    places.append(at)
                for k in np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < SHORT)) if short else ():
                    hits.append(np.array([whole_seed(hashes[first[k] : first[k + 1]])]))
                    places.append(first[k : k + 1])
                hits, places = (np.concatenate([np.zeros(0, t), *x]) for t, x in ((np.uint64, hits), (np.int64, places)))
                order = np.argsort(places, kind="stable")
                hits, places = hits[order], places[order]
                new = np.ones(len(places), bool)
                new[1:] = (doc[places[1:]] != doc[places[:-1]]) | (places[1:] - places[:-1] > 3 * WINDOW)
                for a, b in zip(*(lambda s: (s, [*s[1:], len(places)]))(np.flatnonzero(new).tolist())):
                    k = int(doc[places[a]])
                    low, high = max(first[k], places[a] - WINDOW), min(first[k + 1], places[b - 1] + 2 * WINDOW)
                    out.append((batch.column(0)[i + k].as_py(), batch.column(2)[i + k].as_py(), int(low - first[k]), hashes[low:high].tobytes(), hits[a:b].view(np.int64), (places[a:b] - low).astype(np.int32)))
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())))],
                names=["doc_id", "content", "start", "tokens", "seeds", "places"],
            )

    return task


def agreement(doc: np.ndarray, item: np.ndarray, diagonal: int) -> tuple[int, int, int] | None:
    """(agreeing, aligned, first aligned place of the document) of the best window on a diagonal, if good enough.

    diagonal: the document's place minus the item's. The best window is grown by what else agrees next to it.
    """
    need = min(WINDOW, len(item))
    low, high = max(0, diagonal), min(len(doc), diagonal + len(item))
    if high - low < need:
        return None
    same = doc[low:high] == item[low - diagonal : high - diagonal]
    sums = np.concatenate([[0], np.cumsum(same)])
    window = sums[need:] - sums[:-need]
    at = int(window.argmax())
    if window[at] < (need if need < EXACT else np.ceil(SHARE * need)):
        return None
    end = at + need
    while at > 0 and same[at - 1]:
        at -= 1
    while end < len(same) and same[end]:
        end += 1
    return int(same[at:end].sum()), end - at, int(low + at)


def _verify(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in source:
        out = []
        for doc_id, content, start, doc, number, item_id, item, diagonal in zip(*(c.to_pylist() for c in batch.columns)):
            h = np.frombuffer(item, np.uint64)
            found = agreement(np.frombuffer(doc, np.uint64), h, diagonal)
            if found:
                out.append((doc_id, content, number, item_id, found[0], found[1], start + found[2], len(h)))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32())
        yield pa.record_batch(
            [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 8, kinds)],
            names=["doc_id", "content", "number", "item_id", "agreeing", "aligned", "token_at", "item_tokens"],
        )


def _content(key: str, text: str) -> Column:
    """A hash of a row's identifier and text; rows that share it leak alike."""
    return F.xxhash64(whole(text), F.col(key).cast("long"))


def _overlaps(docs: DataFrame, benchmark: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, content, number, item_id, agreeing, aligned, token_at, item_tokens of every overlap, on every diagonal."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.mapInArrow(lean(_items), "item_id long, n_tokens int, tokens binary").filter("n_tokens > 0")
    items = items.groupBy("tokens", "n_tokens").agg(F.min("item_id").alias("item_id"))
    items = written(items.withColumn("number", F.monotonically_increasing_id()))
    lengths = tuple(r.n for r in items.select(F.least("n_tokens", F.lit(WINDOW)).alias("n")).distinct().collect())
    marks = written(items.select("number", "tokens").mapInArrow(lean(_item_seeds), "seed long, number long, item_at int"))
    table = bloom(marks.select("seed").distinct()).table
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), _content(key, text).alias("content"))
    kind = "doc_id long, content long, start long, tokens binary, seeds array<long>, places array<int>"
    segments = written(
        rows.mapInArrow(lean(_segments(table, lengths)), kind).withColumn("segment", F.xxhash64("content", "start", "tokens"))
    )
    hits = segments.select("segment", F.explode(F.arrays_zip("seeds", "places")).alias("h")).select("segment", F.col("h.seeds").alias("seed"), F.col("h.places").alias("place"))
    pairs = hits.join(marks, "seed").select("segment", "number", (F.col("place") - F.col("item_at")).alias("diagonal")).distinct()
    texts = segments.select("segment", "doc_id", "content", "start", "tokens").dropDuplicates(["segment"])
    laid = pairs.join(items.select("number", "item_id", F.col("tokens").alias("item")), "number").join(texts, "segment")
    return laid.select("doc_id", "content", "start", "tokens", "number", "item_id", "item", "diagonal").mapInArrow(
        lean(_verify), "doc_id long, content long, number long, item_id long, agreeing int, aligned int, token_at long, item_tokens int"
    )


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per (document, item) that overlap: doc_id, item_id, agreeing, aligned, token_at, item_tokens."""
    found = _overlaps(docs, benchmark, key, text)
    best = F.max(F.struct("agreeing", (-F.col("aligned")).alias("less"), (-F.col("token_at")).alias("early"), "item_tokens")).alias("x")
    unnamed = F.when(F.col("item_id").isNull(), F.col("number")).alias("unnamed")
    return found.groupBy("doc_id", "item_id", unnamed).agg(best).select(
        "doc_id", "item_id", "x.agreeing", (-F.col("x.less")).alias("aligned"), (-F.col("x.early")).alias("token_at"), "x.item_tokens"
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` without the rows that overlap an item; others with the same identifier or none stay."""
    found = _overlaps(docs, benchmark, key, text).select("content")
    return split_by_ids(docs.withColumn("__llm_content", _content(key, text)), found, "__llm_content")[0].drop("__llm_content")
