"""Exact deduplication: Patricia tries own the full normalised byte strings.

Texts are equal when identical after deleting white space ([\\x20\\x09-\\x0D]). Partitions are dealt by length and
content hash; each inserts whole byte strings into a compressed radix trie whose terminal nodes hold the count, the
longest original and the smallest identifier. Map tasks first combine their own copies in a trie, so a group with a
third of all rows reaches its owner as one row per task. A trie above its memory spills whole subtrees to files and
finishes them one after the other.

Nulls count as empty texts, empty texts are equal to each other. Equal lengths are told apart by the smaller
identifier, a null identifier comes last. Of fully repeated rows exactly one is marked as kept.
"""

from __future__ import annotations

import hashlib
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from loanscope.llm.shared import batches, lean, split_by_ids, whole, written
from loanscope.llm.words import text_bytes

#: Bytes that a trie may hold before a subtree is spilled, and before a map task hands on what it has combined.
TRIE_BYTES, COMBINE_BYTES = 64 << 20, 16 << 20
#: Bytes that a node takes besides its label.
NODE_BYTES = 300

SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
NO_ID = 1 << 63


class Owner:
    """Terminal of a text: rows so far, code points and identifier of the row that stays, content hash."""

    __slots__ = ("rows", "points", "ident", "digest")

    def __init__(self, rows: int, points: int, ident: int, digest: bytes):
        self.rows, self.points, self.ident, self.digest = rows, points, ident, digest

    def add(self, other: Owner) -> None:
        self.rows += other.rows
        if (-other.points, other.ident) < (-self.points, self.ident):
            self.points, self.ident = other.points, other.ident

    def pack(self) -> bytes:
        return struct.pack("<QQ", self.rows, self.points) + self.ident.to_bytes(9, "little", signed=True) + self.digest

    @classmethod
    def unpack(cls, raw: bytes) -> Owner:
        rows, points = struct.unpack("<QQ", raw[:16])
        return cls(rows, points, int.from_bytes(raw[16:25], "little", signed=True), raw[25:])


class Node:
    __slots__ = ("label", "below", "owner", "file")

    def __init__(self, label: bytes, owner: Owner | None = None):
        self.label, self.owner, self.below, self.file = label, owner, {}, None


class PatriciaTrie:
    """A compressed radix trie of byte strings with at most about `most` bytes in memory."""

    def __init__(self, most: int = TRIE_BYTES):
        self.root, self.most, self.held = Node(b""), most, 0

    def insert(self, key: bytes, owner: Owner) -> None:
        node, at = self.root, 0
        while True:
            if node.file is not None:
                _append(node.file, key[at:], owner)
                return
            if at == len(key):
                if node.owner is None:
                    node.owner = owner
                else:
                    node.owner.add(owner)
                return
            child = node.below.get(key[at])
            if child is None:
                node.below[key[at]] = Node(key[at:], owner)
                self.held += len(key) - at + NODE_BYTES
                break
            label = child.label
            if not key.startswith(label, at):
                same = _common(label, key, at)
                upper = Node(label[:same])
                child.label = label[same:]
                upper.below[child.label[0]] = child
                node.below[key[at]] = child = upper
                self.held += NODE_BYTES
                label = upper.label
            node, at = child, at + len(label)
        if self.held > self.most:
            self._spill()

    def _spill(self) -> None:
        """Write the largest subtree below the first branch to a file of its own; later keys of it follow there."""
        node = self.root
        while True:
            inner = [x for x in node.below.values() if x.file is None]
            if not inner:
                return
            if len(inner) > 1 or node.owner or len(node.below) > 1:
                break
            node = inner[0]
        node = max(inner, key=_weight)
        freed, file = _weight(node), tempfile.TemporaryFile()
        for suffix, owner in _walk(node, node.label[1:]):
            _append(file, suffix, owner)
        # its first byte leads to the file; a long key of its own doesn't stay either
        node.label, node.below, node.owner, node.file = node.label[:1], {}, None, file
        self.held -= freed - NODE_BYTES - 1

    def owners(self) -> Iterator[tuple[bytes, Owner]]:
        """All (text, owner), spilled subtrees after the others."""
        later = []
        yield from _walk(self.root, b"", later)
        self.root, self.held = Node(b""), 0
        for prefix, file in later:
            inner = PatriciaTrie(self.most)
            for suffix, owner in _records(file):
                inner.insert(suffix, owner)
            file.close()
            for suffix, owner in inner.owners():
                yield prefix + suffix, owner


def _common(label: bytes, key: bytes, at: int) -> int:
    """Length of the common start of label and key[at:], found by halving."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if key.startswith(label[low:mid], at + low):
            low = mid
        else:
            high = mid - 1
    return low


def _weight(node: Node) -> int:
    todo, total = [node], 0
    while todo:
        x = todo.pop()
        total += len(x.label) + NODE_BYTES
        todo.extend(x.below.values())
    return total


def _walk(node: Node, prefix: bytes, later: list | None = None) -> Iterator[tuple[bytes, Owner]]:
    todo = [(node, prefix)]
    while todo:
        x, at = todo.pop()
        if x.file is not None:
            if later is None:
                for suffix, owner in _records(x.file):
                    yield at + suffix, owner
                x.file.close()
            else:
                later.append((at, x.file))
            continue
        if x.owner is not None:
            yield at, x.owner
        todo.extend((y, at + y.label) for y in x.below.values())


def _append(file, suffix: bytes, owner: Owner) -> None:
    raw = owner.pack()
    file.write(struct.pack("<II", len(suffix), len(raw)) + suffix + raw)


def _records(file) -> Iterator[tuple[bytes, Owner]]:
    file.seek(0)
    while head := file.read(8):
        n, m = struct.unpack("<II", head)
        yield file.read(n), Owner.unpack(file.read(m))


MEMBERS = pa.schema([("doc_id", pa.int64()), ("points", pa.int64()), ("n_bytes", pa.int64()), ("digest", pa.binary())])
TEXTS = pa.schema([("n_bytes", pa.int64()), ("digest", pa.binary()), ("text", pa.binary()), ("rows", pa.int64()), ("points", pa.int64()), ("ident", pa.int64())])
OWNERS = pa.schema([("n_bytes", pa.int64()), ("digest", pa.binary()), ("keep_id", pa.int64()), ("keep_points", pa.int64()), ("group_size", pa.int64())])


def _normalised(batch: pa.RecordBatch) -> Iterator[tuple[int, int, bytes]]:
    """(identifier, code points of the original, text without white space) of each row."""
    column = batch.column(1)
    points = pc.fill_null(pc.utf8_length(column), 0).to_pylist()
    data, offsets = text_bytes(column)
    raw, offsets = memoryview(data), offsets.tolist()
    for k, ident in enumerate(batch.column(0).to_pylist()):
        yield NO_ID if ident is None else ident, points[k], bytes(raw[offsets[k] : offsets[k + 1]]).translate(None, SPACE)


def _members(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in source:
        yield from batches(
            ((None if i == NO_ID else i, p, len(t), hashlib.sha256(t).digest()) for i, p, t in _normalised(batch)), MEMBERS
        )


def _combine(most: int):
    def task(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaTrie(1 << 62)

        def texts() -> Iterator[pa.RecordBatch]:
            rows = (
                (len(t), o.digest, t, o.rows, o.points, None if o.ident == NO_ID else o.ident) for t, o in trie.owners()
            )
            return batches(rows, TEXTS, lambda row: row[0] + 100)

        for batch in source:
            for ident, points, text in _normalised(batch):
                trie.insert(text, Owner(1, points, ident, hashlib.sha256(text).digest()))
                if trie.held > most:  # the copies of this much text are combined; the next ones start anew
                    yield from texts()
        yield from texts()

    return task


def _own(most: int):
    def task(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaTrie(most)
        for batch in source:
            for _, digest, text, rows, points, ident in zip(*(c.to_pylist() for c in batch.columns)):
                trie.insert(text, Owner(rows, points, NO_ID if ident is None else ident, digest))
        seen: set[bytes] = set()

        def rows() -> Iterator[tuple]:
            for text, o in trie.owners():
                if o.digest in seen:
                    raise RuntimeError("two different texts have one SHA-256 digest")
                seen.add(o.digest)
                yield len(text), o.digest, None if o.ident == NO_ID else o.ident, o.points, o.rows

        yield from batches(rows(), OWNERS)

    return task


def _spark_schema(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'binary' if pa.types.is_binary(f.type) else 'long'}" for f in schema)


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per row of `docs`: doc_id, points, keep_id, group_size, kept, text_sha256."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    owners = (
        rows.mapInArrow(lean(_combine(min(trie_bytes, COMBINE_BYTES))), _spark_schema(TEXTS))
        .repartition("n_bytes", "digest")
        .mapInArrow(lean(_own(trie_bytes)), _spark_schema(OWNERS))
    )
    members = (
        rows.mapInArrow(lean(_members), _spark_schema(MEMBERS)).groupBy(*MEMBERS.names).agg(F.count(F.lit(1)).alias("repeats"))
    )
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("keep_points"))
    return (
        members.join(owners, ["n_bytes", "digest"])
        .select("*", F.explode(F.sequence(F.lit(1), F.col("repeats"))).alias("nth"))
        .select(
            "doc_id", "points", "keep_id", "group_size", (stays & (F.col("nth") == 1)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` without exact copies, all columns kept; only texts whose identifier has a dropped row are shuffled."""
    groups = written(exact_groups(docs, key, text).select("doc_id", "points", "kept", "text_sha256"))
    rest, touched = split_by_ids(docs, groups.filter("not kept").select("doc_id"), key)
    squeezed = F.regexp_replace(whole(text), "[\\x20\\x09-\\x0D]", "")
    marked = touched.withColumns({"__llm_sha": F.sha2(squeezed.cast("binary"), 256), "__llm_points": F.length(whole(text))})
    marked = marked.dropDuplicates([key, "__llm_sha", "__llm_points"])
    best = groups.filter("kept").select(
        F.col("doc_id").alias("__llm_id"), F.col("text_sha256").alias("__llm_keep"), F.col("points").alias("__llm_most")
    )
    same = F.col(key).cast("long").eqNullSafe(F.col("__llm_id")) & F.expr("__llm_sha = __llm_keep and __llm_points = __llm_most")
    return rest.unionAll(marked.join(best, same, "left_semi").select(*docs.columns))
