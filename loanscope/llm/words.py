"""Words, word hashes and shingle sets of whole Arrow text columns, computed with numpy on the text bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; only a single longer text or word makes a block larger.
BLOCK_BYTES = 1 << 19

_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
#: Bytes outside letter runs: all of ASCII but A-Z and a-z.
NO_LETTER = np.arange(256) < 128
NO_LETTER[0x41:0x5B] = NO_LETTER[0x61:0x7B] = False
#: Bytes outside runs of letters and digits.
NO_SIGN = NO_LETTER.copy()
NO_SIGN[0x30:0x3A] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit multipliers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)


_BYTE = odd_numbers(256, 7)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse, modulo 2**64."""
    if n > len(_powers.up):
        size = max(n, 1 << 16)
        _powers.up, _powers.down = np.full((2, size), _BASE, np.uint64)
        _powers.down[:] = pow(_BASE, -1, 1 << 64)
        for table in (_powers.up, _powers.down):
            table[0] = 1
            np.cumprod(table, out=table)
    return _powers.up, _powers.down


_powers.up = _powers.down = np.zeros(0, np.uint64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its texts; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most so many bytes, or of one longer text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


def find_words(data: np.ndarray, offsets: np.ndarray, apart: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words [^\\x20\\x09-\\x0D]+, and the n + 1 indexes of each text's first word.

    apart: for each byte whether it stands between words.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~apart[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word's bytes, equal for equal words wherever they stand."""
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK_BYTES, "right")))
        piece = data[starts[i] : ends[j - 1]]
        up, down = _powers(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_BYTE[_LOWER[piece] if lower else piece] * up[: len(piece)], out=sums[1:])
        s, e = starts[i:j] - starts[i], ends[i:j] - starts[i]
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def windows(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` words, and the n + 1 indexes of each text's first run.

    A text of fewer words has its whole sequence as one run, a text without words none.
    """
    times = odd_numbers(width, 11)
    count = np.diff(first)
    runs = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    at = np.concatenate([[0], np.cumsum(runs)])
    begin = np.repeat(first[:-1] - at[:-1], runs) + np.arange(at[-1])
    words = np.minimum(np.repeat(count, runs), width)
    out = words.astype(np.uint64)
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    for k in range(width):
        out += np.where(k < words, padded[begin + k], np.uint64(0)) * times[k]
    return mix(out), at


def shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks (i, j, hashes, at): text i + k has the distinct, ascending hashes[at[k] : at[k + 1]]; A-Z count as a-z."""
    data, offsets = text_bytes(column)
    for i, j in blocks(offsets):
        piece, own = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        starts, ends, first = find_words(piece, own)
        runs, at = windows(hash_words(piece, starts, ends, lower=True), first, width)
        for k in range(j - i):
            runs[at[k] : at[k + 1]].sort()
        fresh = np.ones(len(runs), bool)
        fresh[1:] = runs[1:] != runs[:-1]
        fresh[at[:-1][np.diff(at) > 0]] = True
        kept = np.concatenate([[0], np.cumsum(fresh)])
        yield i, j, runs[fresh], kept[at]
