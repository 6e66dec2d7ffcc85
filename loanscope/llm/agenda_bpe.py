"""Encoding and decoding with a merge-type piece vocabulary: a score-ordered agenda of adjacent symbol pairs.

The symbols of a text start as its characters. The pair with the best-scored piece, leftmost among equals, is merged
until no adjacent pair forms a piece; characters without a piece become bytes. No piece has a space mark behind another
character, so a text falls into segments (spaces and the word behind them, or a line break that no longer piece has)
whose agendas don't touch. Equal segments of a block are encoded once; short ones run their agendas side by side as numpy
rows, long ones have a heap each.

Every text is also encoded and decoded by the sentencepiece library, and a difference ends the job; ``check_every`` n
checks one text in n of each Arrow batch, 0 none. A null is an empty text; it has only the begin and end ids and decodes
to an empty text. Repeated rows are rows of their own, an empty table gives no rows, and other columns, whatever their
names, are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loanscope.llm.shared import hand_back, lean
from loanscope.llm.words import blocks, hash_words, text_bytes

#: Symbols up to which segments run side by side; longer ones have a heap each.
SIDE_BY_SIDE = 40
#: Bytes of text whose equal segments are encoded once.
BLOCK = 1 << 20
#: Distinct segments whose ids a task keeps from block to block.
CACHED = 400_000
EMPTY = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32))
NONE = np.int32(2**31 - 1)
MARK = "▁"


class PairTable:
    """(left symbol, right symbol) -> merged symbol, an open-addressing table for whole arrays of pairs."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        self.bits = max(4, (8 * len(pairs)).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int32)
        for (left, right), merged in pairs.items():
            key = left << 32 | right
            at = self._slot(np.array([key], np.int64))[0]
            while self.keys[at] != -1:
                at = (at + 1) & ((1 << self.bits) - 1)
            self.keys[at], self.values[at] = key, merged

    def _slot(self, key: np.ndarray) -> np.ndarray:
        x = key.astype(np.uint64)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged symbols, -1 where a pair forms no piece."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64) & 0xFFFFFFFF
        at = self._slot(key)
        there = self.keys[at]
        out = np.where(there == key, self.values[at], np.int32(-1))
        out[(left < 0) | (right < 0)] = -1
        todo = np.flatnonzero((there != key) & (there != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
            there = self.keys[at[todo]]
            same = there == key[todo]
            out[todo[same]] = self.values[at[todo[same]]]
            todo = todo[~same & (there != -1)]
        return out


class PieceCodec:
    """Encoder and decoder of one sentencepiece model file."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = lib.vocab_size()
        pieces = [lib.id_to_piece(i) for i in range(n)]
        if lib.encode("a  b") == lib.encode("a b") or any(lib.is_unused(i) for i in range(n)):
            raise ValueError("only models that keep all spaces and use all pieces are supported")
        self.bos, self.eos = lib.bos_id(), lib.eos_id()
        byte_ids = {int(p[3:5], 16): i for i, p in enumerate(pieces) if lib.is_byte(i)}
        if len(byte_ids) != 256:
            raise ValueError("only models with byte fallback are supported")
        self.byte_ids = np.array([byte_ids[b] for b in range(256)], np.int32)
        normal = {p: i for i, p in enumerate(pieces) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i))}
        inside = {c for p in normal if len(p) > 1 for c in p}
        if any(MARK in p.lstrip(MARK) for p in normal):
            raise ValueError("a piece joins words")
        self.alone = np.zeros(256, bool)  # control characters that no longer piece has
        self.alone[[ord(c) for c in "\n\t\r" if c not in inside]] = True
        symbols = dict(normal)
        for c in sorted(inside - normal.keys()):  # characters that only occur in longer pieces
            symbols[c] = n + len(symbols)
        self.cache = EMPTY
        self.n, self.characters = n, np.full(0x110000, -1, np.int32)
        for p, i in symbols.items():
            if len(p) == 1:
                self.characters[ord(" " if p == MARK else p)] = i
        self.characters[ord(MARK)] = -1
        pairs = {
            (symbols[p[:k]], symbols[p[k:]]): i
            for p, i in normal.items() for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols
        }
        self.pairs, self.pair_dict = PairTable(pairs), pairs
        order = sorted({-lib.get_score(i) for i in normal.values()})
        place = {s: k for k, s in enumerate(order)}
        self.rank = np.full(n + 1, NONE, np.int32)
        for i in normal.values():
            self.rank[i] = place[-lib.get_score(i)]
        decoded = [
            b"" if lib.is_control(i) else bytes([int(p[3:5], 16)]) if lib.is_byte(i) else p.replace(MARK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        decoded[lib.unk_id()] = " ⁇ ".encode()
        self.piece_at = np.concatenate([[0], np.cumsum([len(b) for b in decoded])])
        self.piece_bytes = np.frombuffer(b"".join(decoded), np.uint8)

    # ---- agendas

    def _side_by_side(self, rows: np.ndarray) -> np.ndarray:
        """Merge each row's best pair until none is left; what a row loses in length is filled with NONE."""
        rows, (k, width) = rows.copy(), rows.shape
        merged = self.pairs.find(rows[:, :-1].ravel(), rows[:, 1:].ravel()).reshape(k, width - 1)
        rank = self.rank[merged]  # the last entry of rank stands for "no piece"
        active = np.arange(k)
        columns = np.arange(width)
        while width > 1 and len(active):
            at = rank[active].argmin(axis=1)
            live = rank[active, at] != NONE
            active, at = active[live], at[live]
            if not len(active):
                break
            rows[active, at] = merged[active, at]
            source = columns[None, :] + (columns[None, :] > at[:, None])
            shifted = np.full((len(active), width + 1), NONE, np.int32)
            shifted[:, :-1] = rows[active]
            rows[active] = now = np.take_along_axis(shifted, source, 1)
            for values, nothing in ((merged, np.int32(-1)), (rank, NONE)):
                wide = np.full((len(active), width), nothing, np.int32)
                wide[:, :-1] = values[active]
                values[active] = np.take_along_axis(wide, source[:, :-1], 1)
            for step in (-1, 0):
                left = at + step
                ok = (left >= 0) & (left + 1 < width)
                r, c = active[ok], left[ok]
                right = now[ok, c + 1]
                merged[r, c] = found = self.pairs.find(now[ok, c], np.where(right == NONE, -1, right))
                rank[r, c] = self.rank[found]
        return rows

    def _heap(self, symbols: list[int]) -> list[int]:
        """The same agenda for one long segment, with a heap and linked neighbours."""
        n = len(symbols)
        before, after, agenda = list(range(-1, n - 1)), [*range(1, n), -1], []

        def add(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (m := self.pair_dict.get((symbols[i], symbols[j]))) is not None:
                heapq.heappush(agenda, (int(self.rank[m]), i, j, symbols[i], symbols[j], m))

        for i in range(n - 1):
            add(i, i + 1)
        gone = [False] * n
        while agenda:
            _, i, j, left, right, m = heapq.heappop(agenda)
            if gone[i] or gone[j] or after[i] != j or symbols[i] != left or symbols[j] != right:
                continue
            symbols[i], gone[j], after[i] = m, True, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            add(before[i], i)
            add(i, after[i])
        return [s for s, g in zip(symbols, gone) if not g]

    def _segments(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct segments, one after the other, and where each one's begin."""
        sizes = ends - starts
        at = np.concatenate([[0], np.cumsum(sizes)])
        flat = data[np.repeat(starts - at[:-1], sizes) + np.arange(at[-1])]
        lead = (flat & 0xC0) != 0x80
        begin = np.flatnonzero(lead)
        points = np.frombuffer(flat.tobytes().decode().encode("utf-32-le"), np.uint32)
        symbols = self.characters[points]
        unknown = (symbols < 0) | (symbols > self.n)
        symbols = np.where(symbols < 0, -1 - np.arange(len(symbols), dtype=np.int32), symbols)
        first = np.searchsorted(begin, at)
        counts = np.diff(first)
        done_symbols, done_owner = [], []
        for width in np.unique(counts):
            own = np.flatnonzero(counts == width)
            if width <= SIDE_BY_SIDE:
                rows = symbols[first[own][:, None] + np.arange(width)]
                rows = self._side_by_side(rows) if width > 1 else rows
                keep = rows != NONE
                done_symbols.append(rows[keep])
                done_owner.append(np.repeat(own, keep.sum(axis=1)))
            else:
                for o in own:
                    ids = self._heap(symbols[first[o] : first[o + 1]].tolist())
                    done_symbols.append(np.array(ids, np.int32))
                    done_owner.append(np.full(len(ids), o))
        symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        symbols, owner = symbols[order], owner[order]
        odd = (symbols < 0) | (symbols > self.n)
        if odd.any():
            symbols, owner = self._as_bytes(symbols, owner, odd, flat, begin, points, unknown)
        return symbols, np.searchsorted(owner, np.arange(len(sizes) + 1))

    def _cached(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, begins and sizes of distinct segments with ascending hashes; those of earlier blocks are looked up."""
        keys, begin, size, pool = self.cache
        at = np.minimum(np.searchsorted(keys, hashes), max(len(keys) - 1, 0))
        new = keys[at] != hashes if len(keys) else np.ones(len(hashes), bool)
        if new.any():
            if len(keys) + new.sum() > CACHED:
                new[:] = True
                keys, begin, size, pool = EMPTY
            found, first = self._segments(data, starts[new], ends[new])
            keys, begin, size = (
                np.concatenate(pair) for pair in ((keys, hashes[new]), (begin, first[:-1] + len(pool)), (size, np.diff(first)))
            )
            order = np.argsort(keys, kind="stable")
            self.cache = keys, begin, size, pool = keys[order], begin[order], size[order], np.concatenate([pool, found])
            at = np.searchsorted(keys, hashes)
        return pool, begin[at], size[at]

    def _as_bytes(self, symbols, owner, odd, flat, begin, points, unknown):
        """Characters without a piece of their own become the ids of their bytes."""
        size = np.diff(np.concatenate([begin, [len(flat)]]))
        which = np.where(symbols < 0, -1 - symbols, 0)
        for i in np.flatnonzero(symbols > self.n):  # a character known only inside longer pieces
            which[i] = np.flatnonzero(self.characters[points] == symbols[i])[0]
        reps = np.where(odd, size[which], 1)
        at = np.concatenate([[0], np.cumsum(reps)])
        out = np.repeat(symbols, reps)
        nth = np.arange(at[-1]) - np.repeat(at[:-1], reps)
        wide = np.repeat(odd, reps)
        out[wide] = self.byte_ids[flat[np.repeat(begin[which], reps)[wide] + nth[wide]]]
        return out, np.repeat(owner, reps)

    # ---- whole texts

    def encode_block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts with begin and end ids, and the n + 1 indexes of each text's first id."""
        n = len(offsets) - 1
        full = np.diff(offsets) > 0
        shift = np.concatenate([[0], np.cumsum(full)])
        buffer = np.empty(len(data) + shift[-1], np.uint8)
        marks = (offsets[:-1] + shift[:-1])[full]
        rest = np.ones(len(buffer), bool)
        rest[marks] = False
        buffer[marks], buffer[rest] = 0x20, data
        offsets = offsets + shift
        space = buffer == 0x20
        bar = self.alone[buffer]
        start = bar.copy()
        start[1:] |= (space[1:] & ~space[:-1]) | bar[:-1]
        start[offsets[:-1][full]] = True
        starts = np.flatnonzero(start)
        ends = np.concatenate([starts[1:], [len(buffer)]]).astype(np.int64)
        out_at = np.zeros(n + 1, np.int64)
        ids = np.zeros(0, np.int32)
        if len(starts):
            hashes, chosen, inverse = np.unique(hash_words(buffer, starts, ends), return_index=True, return_inverse=True)
            pool, begin, size = self._cached(hashes, buffer, starts[chosen], ends[chosen])
            size = size[inverse]
            seg_at = np.concatenate([[0], np.cumsum(size)])
            ids = pool[np.repeat(begin[inverse] - seg_at[:-1], size) + np.arange(seg_at[-1])]
            out_at = seg_at[np.searchsorted(starts, offsets)]
        final_at = out_at + 2 * np.arange(n + 1)
        final = np.empty(len(ids) + 2 * n, np.int32)
        rest = np.ones(len(final), bool)
        rest[final_at[:-1]] = rest[final_at[1:] - 1] = False
        final[rest] = ids
        final[final_at[:-1]], final[final_at[1:] - 1] = self.bos, self.eos
        return final, final_at

    def decode_block(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of all texts and their n + 1 offsets; the space put before a text goes again."""
        size = np.diff(self.piece_at)[ids]
        byte_at = np.concatenate([[0], np.cumsum(size)])
        data = self.piece_bytes[np.repeat(self.piece_at[ids] - byte_at[:-1], size) + np.arange(byte_at[-1])]
        offsets = byte_at[at]
        first = np.concatenate([data, [0]])[offsets[:-1]]
        drop = (np.diff(offsets) > 0) & (first == 0x20)
        keep = np.ones(len(data), bool)
        keep[offsets[:-1][drop]] = False
        return data[keep], offsets - np.concatenate([[0], np.cumsum(drop)])

    def encode(self, text: str) -> list[int]:
        return self.encode_block(*text_bytes(plain(pa.array([text]))))[0].tolist()

    def decode(self, ids: list[int]) -> str:
        return self.decode_block(np.array(ids, np.int64), np.array([0, len(ids)]))[0].tobytes().decode(errors="replace")


def plain(column: pa.Array) -> pa.Array:
    """Space marks that stand in a text itself count as spaces."""
    import pyarrow.compute as pc

    return pc.replace_substring(column, MARK, " ")


def encoded(column: pa.Array, codec: PieceCodec, check_every: int) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """(row, ids, decoded bytes) of every text of an Arrow column."""
    data, offsets = text_bytes(plain(column))
    for i, j in blocks(offsets, BLOCK):
        ids, at = codec.encode_block(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        hand_back()  # what a block took isn't held beside what the next step takes
        back, back_at = codec.decode_block(ids, at)
        hand_back()
        raw = memoryview(back)
        for k in range(i, j):
            own = ids[at[k - i] : at[k - i + 1]]
            text = bytes(raw[back_at[k - i] : back_at[k - i + 1]])
            if check_every and k % check_every == 0:
                theirs = codec.library.encode(column[k].as_py() or "", add_bos=True, add_eos=True)
                if theirs != own.tolist() or codec.library.decode(theirs).encode() != text:
                    raise RuntimeError(f"row {k} of a batch differs from the library")
            yield k, own, text


_codecs: dict[str, PieceCodec] = {}


def codec_of(path: str) -> PieceCodec:
    """The worker's codec with an empty cache: a task doesn't hold what others before it have met."""
    if path not in _codecs:
        _codecs[path] = PieceCodec(path)
    _codecs[path].cache = EMPTY
    return _codecs[path]


DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def token_digests(docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text", check_every: int = 1) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row."""

    def task(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model_file)
        for batch in source:
            counts, ids_sha, text_sha = [], [], []
            for _, ids, back in encoded(batch.column(1), codec, check_every):
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                text_sha.append(hashlib.sha256(back).hexdigest())
            yield pa.record_batch([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], schema=DIGESTS)

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(lean(task), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def tokens(docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text", check_every: int = 1) -> DataFrame:
    """doc_id, ids (with begin and end ids) and decoded text of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def task(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model_file)
        for batch in source:
            for one in (batch.slice(k, 256) for k in range(0, batch.num_rows, 256)):
                found = [(ids, back.decode()) for _, ids, back in encoded(one.column(1), codec, check_every)]
                yield pa.record_batch([one.column(0), pa.array([x for x, _ in found], pa.list_(pa.int32())), pa.array([x for _, x in found], pa.string())], schema=schema)

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(lean(task), "doc_id long, ids array<int>, decoded string")
