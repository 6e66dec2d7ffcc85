"""Near-duplicates by an inverted join over MinHash signature coordinates, confirmed on full shingle sets.

A document's set are the distinct word shingles of its whole text (A-Z as a-z); equal sets form a class (told by two 64-bit
hashes), and classes are what is compared. Each class has K MinHash coordinates. Every (coordinate, value) pair is a token with a posting
list of the classes that have it, and two classes are candidates if at least T coordinates collide. T lies five standard
deviations below the number to be expected at the threshold, so a link is missed with a chance of about 1e-6.

* Prefix: two classes with T common tokens share one of their K - T + 1 rarest, so only those are posted. Rarity comes
  from a sketch of fixed size over all tokens (any common order is right, a rough one only costs time). Passages that
  many documents share have frequent tokens, which are posted by documents that consist of them.
* Skip: each posting list links its members to one hub (the smallest) first. That compares all pairs of the hub, so the
  hub goes, and with it every list of two. Once these links are confirmed, a list whose other members are all in one
  component has nothing left to find, as only components are asked for. In the rest all pairs from different components
  and of near sizes are counted, a pair only in the first of its common lists, and confirmed unless their components have
  met. Long lists are dealt out by pairs of blocks.

Nulls count as empty texts; texts without words have no set and are linked with nothing. Repeated rows are one class.
A row without identifier counts as the largest one, so it never stays while another does. An empty table gives no rows.
Columns of other names are not looked at; `drop_near_copies` returns them as they are.
"""

from __future__ import annotations

import math
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from loanscope.llm.components import smallest
from loanscope.llm.shared import batches, bloom, in_bloom, lean, row_hash, without_rows, written
from loanscope.llm.words import mix, odd_numbers, shingle_sets

K = 128
#: Counters of the sketch; the broadcast has four bytes of each.
SKETCH = 1 << 21
SLICE = 8192
#: Members of a posting list that are compared within one group.
BLOCK = 4096
#: Of a group, pairs of members that are looked at, and pairs of signatures that are compared at once.
CELLS, PAIRS = 1 << 18, 1 << 12
LAST_ID = (1 << 63) - 1

_TIMES = odd_numbers(K, 23)
_SALT = odd_numbers(K, 29)
_UP = np.arange(K, dtype=np.uint64)


@dataclass(frozen=True)
class Rule:
    """Link sets of `width`-word shingles with 100 * intersection >= percent * union."""

    width: int = 5
    percent: int = 80

    @property
    def least(self) -> int:
        share = self.percent / 100
        return max(1, math.floor(K * share - 5 * math.sqrt(K * share * (1 - share))))

    @property
    def prefix(self) -> int:
        return K - self.least + 1


def signatures(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """K 32-bit MinHash values of each non-empty set hashes[at[k] : at[k + 1]]."""
    out = np.empty((len(at) - 1, K), np.uint32)
    if len(out):
        for c in range(K):
            out[:, c] = np.minimum.reduceat(hashes * _TIMES[c], at[:-1]) >> np.uint64(32)
    return out


def set_keys(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set."""
    out, size = [], np.diff(at).astype(np.uint64)
    for salt in _SALT[:2]:
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(mix(hashes ^ salt), out=sums[1:])
        out.append(mix(sums[at[1:]] - sums[at[:-1]] + size).view(np.int64))
    return out[0], out[1]


def _profiles(rule: Rule, keys=set_keys):
    def task(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for i, j, hashes, at in shingle_sets(batch.column(1), rule.width):
                size = np.diff(at)
                high, low = keys(hashes, at)
                full = size > 0
                sig = signatures(hashes, np.concatenate([at[:-1][full], at[-1:]]))
                flat = pa.py_buffer(np.ascontiguousarray(sig))
                ends = np.concatenate([[0], np.cumsum(full)]).astype(np.int32) * (K * 4)
                cells = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(ends), flat])
                yield pa.record_batch(
                    [batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array(size), pa.array(high), pa.array(low), cells],
                    names=["doc_id", "content", "n_shingles", "high", "low", "sig"],
                )

    return task


def _sig(column: pa.Array) -> np.ndarray:
    """The signatures of a binary column as a matrix."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(np.uint32).reshape(-1, K) if len(column) else np.zeros((0, K), np.uint32)


def _tokens(sig: np.ndarray) -> np.ndarray:
    return mix((sig.astype(np.uint64) << np.uint64(8) | _UP) * np.uint64(0x9E3779B97F4A7C15))


def _sketch(classes: DataFrame) -> np.ndarray:
    """Counts of all tokens by SKETCH hash buckets, summed by slices on the executors."""

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, np.int64)
        for batch in source:
            total += np.bincount((_tokens(_sig(batch.column(0))).ravel() & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
        yield from pieces(total.reshape(-1, SLICE), range(SKETCH // SLICE))

    def pieces(rows: np.ndarray, names) -> Iterator[pa.RecordBatch]:
        used = [k for k in range(len(rows)) if rows[k].any()]
        yield pa.record_batch(
            [pa.array([names[k] for k in used], pa.int32()), pa.array([np.minimum(rows[k], 2**31 - 1).astype(np.int32).tobytes() for k in used], pa.binary())],
            names=["slice", "counts"],
        )

    def add(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in source:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[k] = sums.get(k, 0) + np.frombuffer(raw, np.int32).astype(np.int64)
        names = sorted(sums)
        if names:
            yield from pieces(np.stack([sums[k] for k in names]), names)

    kind = "slice int, counts binary"
    out = np.zeros(SKETCH, np.int32).reshape(-1, SLICE)
    for row in classes.select("sig").mapInArrow(lean(count), kind).repartition("slice").mapInArrow(lean(add), kind).collect():
        out[row.slice] = np.frombuffer(row.counts, np.int32)
    return out.ravel()


def _ordered(sig: np.ndarray, sketch: np.ndarray, prefix: int) -> np.ndarray:
    """The `prefix` rarest tokens of each signature, rarest first, equal counts by token."""
    tokens = _tokens(sig)
    order = np.lexsort((tokens, sketch[(tokens & np.uint64(SKETCH - 1)).astype(np.int64)]), axis=1)[:, :prefix]
    return np.take_along_axis(tokens, order, 1)


def _rarer(sig: np.ndarray, sketch: np.ndarray, token: np.uint64) -> np.ndarray:
    """Which tokens of each signature come before the given one in the order of `_ordered`."""
    out, last = np.empty(sig.shape, bool), np.uint64(SKETCH - 1)
    own = sketch[int(token & last)]
    for k in range(0, len(sig), 1024):
        tokens = _tokens(sig[k : k + 1024])
        counts = sketch[(tokens & last).astype(np.int64)]
        out[k : k + 1024] = (counts < own) | (counts == own) & (tokens < token)
    return out


def _postings(classes: DataFrame, sketch, prefix: int, shared=None) -> DataFrame:
    """(token, cls, n_shingles) of the tokens in each prefix; with a filter's table only of those that it may hold."""

    def task(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for one in (batch.slice(k, 1024) for k in range(0, batch.num_rows, 1024)):
                tokens = _ordered(_sig(one.column(2)), sketch.value, prefix).ravel()
                cls, size = (np.repeat(one.column(k).to_numpy(), prefix) for k in (0, 1))
                if shared is not None:
                    some = in_bloom(shared.value, tokens)
                    tokens, cls, size = tokens[some], cls[some], size[some]
                yield pa.record_batch([pa.array(tokens.view(np.int64)), pa.array(cls), pa.array(size)], names=["token", "cls", "n_shingles"])

    return classes.select("cls", "n_shingles", "sig").mapInArrow(lean(task), "token long, cls long, n_shingles long")


def _near_size(a: str, b: str, rule: Rule):
    return F.least(a, b) * 100 >= F.greatest(a, b) * rule.percent


def _colliding(pairs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) with at least T equal coordinates."""
    left, right = (classes.select(F.col("cls").alias(k), F.col("sig").alias(v)) for k, v in (("a", "s"), ("b", "t")))

    def task(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            same = (_sig(batch.column(2)) == _sig(batch.column(3))).sum(axis=1) >= rule.least
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(same)) for c in batch.columns[:2]], names=["a", "b"])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "s", "t").mapInArrow(lean(task), "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def task(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            pairs = zip(*([np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column(k)] for k in (2, 3)))
            keep = [_similar(x, y, rule) for x, y in pairs]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    left, right = (sets.select(F.col("cls").alias(k), F.col("shingles").alias(v)) for k, v in (("a", "x"), ("b", "y")))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(lean(task), "a long, b long")


def _id_hash() -> Column:
    return F.xxhash64("doc_id")


def _sets(rows: DataFrame, wanted: DataFrame, shared: DataFrame, rule: Rule, keys=set_keys) -> DataFrame:
    """(cls, shingles) of the classes in `wanted` (cls, doc_id), from the text of one document of each, dealt by class."""

    wanted = written(wanted)
    table = bloom(wanted.select(_id_hash().alias("h")), stored=True).table

    def task(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            batch = batch.filter(pa.array(in_bloom(table.value, batch.column(1).to_numpy().view(np.uint64))))
            for i, j, hashes, at in shingle_sets(batch.column(0), rule.width):
                high, low = keys(hashes, at)
                ends = pa.py_buffer((at * 8).astype(np.int32))
                cells = pa.Array.from_buffers(pa.binary(), j - i, [None, ends, pa.py_buffer(hashes)])
                yield pa.record_batch([pa.array(high), pa.array(low), cells], names=["high", "low", "shingles"])

    found = rows.select("text", _id_hash()).mapInArrow(lean(task), "high long, low long, shingles binary")
    # a class has one set, whichever of its rows that passed the filter it comes from
    return _named_classes(found, shared).select("cls", "shingles").dropDuplicates(["cls"]).join(wanted.select("cls"), "cls", "left_semi")


GROUP = ["token", "step", "i", "j"]


def _groups(source: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of each group, from batches sorted by the four columns of GROUP."""
    held: list[tuple] = []
    for batch in source:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and row[:4] != held[0][:4]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _candidates(sketch, rule: Rule):
    """For each group of a posting list the members that have candidates in other components, and with whom.

    Rows (token, step, i, j, block, bucket, cls, comp, n_shingles, sig) in, a row for each such member out.
    """

    def partners(group: list[tuple]) -> dict[int, list[int]]:
        token, step, i, j = group[0][:4]
        block, bucket, cls, comp, size = (np.array([r[k] for r in group], np.int64) for k in range(4, 9))
        kinds, counts = np.unique(comp, return_counts=True)
        if len(kinds) < 2:
            return {}
        sig = np.frombuffer(b"".join(r[9] for r in group), np.uint32).reshape(-1, K)
        # a pair counts in the first of its common lists: prefixes hold all rarer tokens, so in the one that has none before it
        rarer = _rarer(sig, sketch.value, np.uint64(token & (2**64 - 1)))
        major = comp == kinds[counts.argmax()]
        place, minor, found = np.arange(len(cls)), np.flatnonzero(~major), {}
        wide = max(1, CELLS // len(cls))
        for some in (minor[k : k + wide, None] for k in range(0, len(minor), wide)):
            # and there in the lower of its steps
            other = (comp != comp[some]) & (major | (place > some)) & (np.minimum(bucket, bucket[some]) == step)
            other &= np.minimum(size, size[some]) * 100 >= np.maximum(size, size[some]) * rule.percent
            if i != j:
                other &= block != block[some]
            us, vs = np.nonzero(other)
            us = some[us, 0]
            for u, v in ((us[k : k + PAIRS], vs[k : k + PAIRS]) for k in range(0, len(us), PAIRS)):
                same = sig[u] == sig[v]
                here = (same.sum(axis=1) >= rule.least) & ~(same & rarer[u]).any(axis=1)
                for a, b in zip(cls[u[here]].tolist(), cls[v[here]].tolist()):
                    found.setdefault(a, []).append(b)
        return found

    def task(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for group in _groups(source):
                if len(group) > 1 and (found := partners(group)):
                    comp = {r[6]: r[7] for r in group}
                    for c in found.keys() | {v for vs in found.values() for v in vs}:
                        yield *group[0][:4], c, comp[c], found.get(c, [])

        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        schema = pa.schema(list(zip([*GROUP, "cls", "comp", "partners"], kinds)))
        yield from batches(rows(), schema, lambda row: 64 + 8 * len(row[6]))

    return task


#: Bytes of sets that a task holds of a group; what comes on top goes to a file of the task.
HELD_SETS = 32 << 20


class _Sets:
    """Shingle sets by class, the first ones in memory and the others in a temporary file."""

    def __init__(self) -> None:
        self.held, self.places, self.size, self.file = {}, {}, 0, None

    def __setitem__(self, cls: int, raw: bytes) -> None:
        if self.size < HELD_SETS:
            self.held[cls] = raw
            self.size += len(raw)
            return
        self.file = self.file or tempfile.TemporaryFile()
        self.places[cls] = self.file.seek(0, 2), len(raw)
        self.file.write(raw)

    def __getitem__(self, cls: int) -> np.ndarray:
        raw = self.held.get(cls)
        if raw is None:
            at, n = self.places[cls]
            self.file.seek(at)
            raw = self.file.read(n)
        return np.frombuffer(raw, np.uint64)


def _late_links(rule: Rule):
    """Links (a, b) between components from rows (token, step, i, j, cls, comp, partners, shingles).

    Within a group a pair whose components have met already is passed over: only components are asked for.
    """

    def links(group: Iterator[tuple]) -> Iterator[tuple[int, int]]:
        sets, comp, asked = _Sets(), {}, []
        for *_, cls, of, partners, raw in group:
            sets[cls] = raw
            comp[cls] = of
            if partners:
                asked.append((cls, partners))
        root = {c: c for c in comp.values()}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        for cls, partners in asked:
            for v in partners:
                a, b = find(comp[cls]), find(comp[v])
                if a != b and _similar(sets[cls], sets[v], rule):
                    root[a] = b
                    yield cls, v

    def task(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in source for row in zip(*(c.to_pylist() for c in batch.columns)))
        found = (pair for _, group in groupby(rows, lambda row: row[:4]) for pair in links(group))
        yield from batches(found, pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return task


def _similar(x: np.ndarray, y: np.ndarray, rule: Rule) -> bool:
    """Whether two full sets, ascending and not empty, are similar enough."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return 100 * both >= rule.percent * (len(x) + len(y) - both)


def _mixed_groups(members: DataFrame, comps: DataFrame, rule: Rule) -> DataFrame:
    """Members of posting lists in groups that can hold a pair from two components: of near sizes, block by block.

    Hubs are left out, as all their pairs have been compared. Sizes fall into steps of the threshold, so that near ones
    are in the same step or the next. A group has the members of a step and of the next; which groups are worth it is told
    by counts, before any signature moves.
    """
    step = F.floor(F.log("n_shingles") / F.lit(-math.log(rule.percent / 100) + 1e-9)).cast("int")
    named = members.filter("size > 2 and cls != hub").select("token", "cls", "n_shingles").join(comps.toDF("cls", "component"), "cls", "left")
    named = named.select("token", "cls", "n_shingles", F.coalesce("component", "cls").alias("comp"), step.alias("bucket"))
    named = named.withColumn("step", F.explode(F.array(F.col("bucket"), F.col("bucket") - 1)))
    own = F.count_if(F.col("bucket") == F.col("step"))
    alive = named.groupBy("token", "step").agg(own.alias("own"), F.count(F.lit(1)).alias("all"), F.min("comp").alias("c"), F.max("comp").alias("d"))
    alive = alive.filter("own > 0 and c != d").select("token", "step", F.greatest(F.ceil(F.col("all") / BLOCK), F.lit(1)).cast("int").alias("n"))
    dealt = named.join(alive, ["token", "step"]).withColumn("block", F.pmod(F.xxhash64("cls"), F.col("n")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return dealt.select(
        "token", "step", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "bucket", "cls", "comp", "n_shingles"
    )


def _named_classes(sets: DataFrame, shared: DataFrame) -> DataFrame:
    """`sets` (high, low and others) with cls, the identifier of a class.

    That is its first hash; where sets share it, which `shared` tells (high, first), all but one get a hash of both.
    """
    other = F.when(F.col("low") != F.col("first"), F.xxhash64("high", "low"))
    return sets.join(shared, "high", "left").withColumn("cls", F.coalesce(other, "high")).drop("first")


def _classes(profiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per set, told apart by both hashes: high, low, cls, the smallest identifier and the row that has it.

    And which first hashes sets share.
    """
    classes = written(
        profiles.filter("n_shingles > 0").groupBy("high", "low")
        .agg(
            F.min("doc_id").alias("min_id"), F.min(F.struct("doc_id", "content")).alias("least"), F.first("n_shingles").alias("n_shingles"),
            F.first("sig").alias("sig"),
        )
    )
    shared = classes.groupBy("high").agg(F.min("low").alias("first"), F.max("low").alias("last")).filter("first != last")
    shared = written(shared.select("high", "first"))
    return _named_classes(classes, shared), shared


def _grouped(docs: DataFrame, rule: Rule, key: str, text: str, keys=set_keys) -> DataFrame:
    """doc_id, content, n_shingles of every row, and the doc_id and content of the row that stays of its component.

    LAST_ID stands for a missing identifier. Rows without shingles have no component.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(LAST_ID)).alias("doc_id"), F.col(text).cast("string").alias("text"), row_hash(text).alias("content")
    )
    kind = "doc_id long, content long, n_shingles long, high long, low long, sig binary"
    profiles = written(rows.mapInArrow(lean(_profiles(rule, keys)), kind))
    classes, one_hash = _classes(profiles)
    sketch = spark.sparkContext.broadcast(_sketch(classes))
    postings = _postings(classes, sketch, rule.prefix)
    lists = written(
        postings.groupBy("token")
        .agg(F.count(F.lit(1)).alias("size"), F.min("cls").alias("hub"), F.min_by("n_shingles", "cls").alias("hub_shingles"))
        .filter("size > 1")
    )
    shared = bloom(lists.select("token"), stored=True).table
    members = written(_postings(classes, sketch, rule.prefix, shared).join(lists, "token"))

    near = members.filter("cls != hub").filter(_near_size("n_shingles", "hub_shingles", rule))
    stars = near.select(F.col("cls").alias("a"), F.col("hub").alias("b")).distinct()
    stars = written(_colliding(stars, classes, rule))
    touched = stars.select(F.col("a").alias("cls")).unionAll(stars.select(F.col("b").alias("cls"))).distinct()
    ids = classes.select("cls", F.col("min_id").alias("doc_id"))
    # sets aren't stored: those that are looked at again later are few, and made anew
    comps = smallest(_confirmed(stars, _sets(rows, ids.join(touched, "cls"), one_hash, rule, keys), rule))

    mixed = _mixed_groups(members, comps, rule).join(classes.select("cls", "sig"), "cls")
    mixed = mixed.select(*GROUP, "block", "bucket", "cls", "comp", "n_shingles", "sig").repartition(*GROUP).sortWithinPartitions(*GROUP)
    kind = "token long, step int, i int, j int, cls long, comp long, partners array<long>"
    candidates = written(mixed.mapInArrow(lean(_candidates(sketch, rule)), kind))
    if candidates.take(1):
        late = _sets(rows, ids.join(candidates.select("cls").distinct(), "cls"), one_hash, rule, keys)
        laid = candidates.join(late, "cls").select(*GROUP, "cls", "comp", "partners", "shingles").repartition(*GROUP).sortWithinPartitions(*GROUP)
        comps = smallest(comps.unionAll(laid.mapInArrow(lean(_late_links(rule)), "a long, b long")))

    found = classes.select("cls", "high", "low", "least").join(comps.toDF("cls", "component"), "cls", "left")
    found = found.withColumn("component", F.coalesce("component", "cls"))
    stays = found.groupBy("component").agg(F.min("least").alias("stays"))
    found = found.join(stays, "component").select("high", "low", "stays")
    return profiles.select("doc_id", "content", "n_shingles", "high", "low").join(found, ["high", "low"], "left").drop("high", "low")


def _named(c: Column) -> Column:
    return F.when(c != LAST_ID, c)


def near_groups(docs: DataFrame, rule: Rule = Rule(), key: str = "doc_id", text: str = "text", keys=set_keys) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of `docs`."""
    component = F.when(F.col("n_shingles") > 0, F.col("stays.doc_id")).otherwise(F.col("doc_id"))
    return _grouped(docs, rule, key, text, keys).select(
        _named(F.col("doc_id")).alias("doc_id"), "n_shingles", _named(component).alias("component_id"), (F.col("doc_id") == component).alias("kept")
    )


def drop_near_copies(docs: DataFrame, rule: Rule = Rule(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with one row of each group, the one with the smallest identifier, whatever other rows share that."""
    rows = _grouped(docs, rule, key, text).filter("n_shingles > 0").groupBy("doc_id", "content", "stays").agg(F.count(F.lit(1)).alias("n"))
    stays = (F.col("doc_id") == F.col("stays.doc_id")) & (F.col("content") == F.col("stays.content"))
    verdicts = rows.select(_named(F.col("doc_id")).alias("doc_id"), "content", stays.alias("stays"), "n").filter("n > 1 or not stays")
    return without_rows(docs, verdicts, key, text)
