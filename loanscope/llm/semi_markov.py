"""Personal data by a semi-Markov conditional random field over whole spans, beside fixed base patterns.

Words with a digit or an @ and their neighbours form short windows. Within a window every run of up to LONGEST words is
a candidate segment, scored per type by features of the whole span (counts and order of signs, digit counts, checksum,
octets, brackets, the word before); a segment model needs no word-by-word tags. Training maximises the likelihood of the
base spans' segmentation (forward and backward sums over all segmentations); decoding is a dynamic programme over
(end, type) with segments of bounded length, choosing boundaries and types together. Decoded spans that overlap no base
span are added; base spans always stay.

The fit takes at most WINDOWS windows of the corpus by order of a hash (a parameter); each text is scanned whole.
Offsets count code points. Null texts count as empty. Repeated rows and ties have the same result each; without any
window nothing is added.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loanscope.llm.words import text_bytes

WINDOWS = 800
LONGEST = 5
EPOCHS = 4
KINDS = ("email", "ip", "card", "phone")
OUTSIDE = len(KINDS)

# Fixed base patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_TRIGGER = np.zeros(256, bool)
_TRIGGER[0x30:0x3A] = _TRIGGER[0x40] = True
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MARK = re.compile("[0-9@]")


def luhn(digits: str) -> bool:
    """Whether the check digit is right."""
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the email pattern, found from their @ signs."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_SIGNS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(end, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)]
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) < 256 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def windows(text: str) -> Iterator[list[tuple[int, int]]]:
    """Word bounds of each window: words with a mark, those between near ones, and one more at either side."""
    bounds, last = [], -9
    words = [m.span() for m in _WORD.finditer(text)]
    for k, (a, b) in enumerate(words):
        if _MARK.search(text, a, b):
            if k - last > 2 and bounds:
                yield words[max(bounds[0] - 1, 0) : bounds[-1] + 2]
                bounds = []
            bounds.append(k)
            last = k
    if bounds:
        yield words[max(bounds[0] - 1, 0) : bounds[-1] + 2]


def _trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    """Without the signs that end a sentence or quote."""
    while b > a and text[b - 1] in ".,;:!?\"'>":
        b -= 1
    while a < b and text[a] in "\"'<":
        a += 1
    return a, b


def _bucket(n: int, edges: tuple[int, ...]) -> int:
    return sum(n >= e for e in edges)


N_FEATURES = 96


def span_features(text: str, words: list[tuple[int, int]], i: int, j: int) -> list[int]:
    """Numbers of the features that hold for the segment of words i to j - 1 as a whole."""
    a, b = _trimmed(text, words[i][0], words[j - 1][1])
    s = text[a:b]
    d = _digits(s)
    letters = sum(c.isalpha() for c in s)
    parts = s.split(".")
    on = [0, j - i, 8 + _bucket(len(d), (1, 4, 8, 16, 20)), 16 + min(s.count("@"), 2), 20 + min(s.count("."), 4), 26 + min(s.count("-"), 4)]
    on += [32 + _bucket(letters, (1, 3, 8, 20)), 40 + _bucket(len(s), (1, 5, 9, 14, 20, 30))]
    on += [48 + n for n, c in enumerate("+([#/=$%") if s.startswith(c)]
    on.append(56 + (s[-1:].isdigit() + 2 * s[-1:].isalpha()))
    on.append(60 + (len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts)))
    on.append(62 + (16 <= len(d) <= 19 and luhn(d)))
    on.append(64 + (letters == 0 and 8 <= len(d) <= 15 and s.count("(") == s.count(")")))
    on.append(66 + ("@" in s and "." in s[s.find("@") :]))
    on += [68 + bool(_MARK.search(text, *words[i])), 70 + bool(_MARK.search(text, *words[j - 1]))]
    on.append(72 + all(_MARK.search(text, *w) is not None for w in words[i:j]))
    before = text[words[i - 1][0] : words[i - 1][1]].lower().strip(".,;:!?") if i else ""
    on.append(80 + int(hashlib.md5(before.encode()).hexdigest()[:4], 16) % 16)
    return on


@dataclass
class Lattice:
    """All segments (i, j) of a window with their features."""

    n: int
    segments: list[tuple[int, int]]
    on: list[list[int]]

    @classmethod
    def of(cls, text: str, words: list[tuple[int, int]]) -> Lattice:
        segments = [(i, j) for j in range(1, len(words) + 1) for i in range(max(0, j - LONGEST), j)]
        return cls(len(words), segments, [span_features(text, words, i, j) for i, j in segments])

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """A row of type scores for each segment; longer segments can't be outside."""
        out = np.array([weights[:, f].sum(axis=1) for f in self.on])
        for k, (i, j) in enumerate(self.segments):
            if j - i > 1:
                out[k, OUTSIDE] = -1e9
        return out


def _sum(x: np.ndarray) -> float:
    top = x.max()
    return top + np.log(np.exp(x - top).sum())


@dataclass
class Model:
    weights: np.ndarray  # type, feature
    moves: np.ndarray  # type before, type

    def expected(self, lattice: Lattice) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of (segment, type) and expected counts of moves, by forward and backward sums."""
        s, n, types = lattice.scores(self.weights), lattice.n, OUTSIDE + 1
        ahead, back = np.full((n + 1, types), -np.inf), np.full((n + 1, types), -np.inf)
        start = np.zeros(types)
        arrive = {}
        by_end: dict[int, list[float]] = {}
        for k, (i, j) in enumerate(lattice.segments):
            into = start if i == 0 else np.array([_sum(ahead[i] + self.moves[:, t]) for t in range(types)])
            arrive[k] = into
            by_end.setdefault(j, []).append(into + s[k])
            if k + 1 == len(lattice.segments) or lattice.segments[k + 1][1] != j:
                stack = np.array(by_end[j])
                ahead[j] = [_sum(stack[:, t]) for t in range(types)]
        total = _sum(ahead[n])
        back[n] = 0
        for i in range(n - 1, 0, -1):
            out = [(s[k] + back[j]) for k, (a, j) in enumerate(lattice.segments) if a == i]
            reach = np.array([_sum(np.array(out)[:, t]) for t in range(types)])
            back[i] = [_sum(self.moves[t] + reach) for t in range(types)]
        p, moved = np.zeros_like(s), np.zeros_like(self.moves)
        for k, (i, j) in enumerate(lattice.segments):
            p[k] = np.exp(arrive[k] + s[k] + back[j] - total)
            if i:
                moved += np.exp(ahead[i][:, None] + self.moves + (s[k] + back[j])[None, :] - total)
        return p, moved

    def best(self, lattice: Lattice) -> list[tuple[int, int, int]]:
        """(i, j, type) of the best segmentation's spans."""
        s, n = lattice.scores(self.weights), lattice.n
        value, came = np.full((n + 1, OUTSIDE + 1), -np.inf), {}
        for k, (i, j) in enumerate(lattice.segments):
            for t in range(OUTSIDE + 1):
                options = value[i] + self.moves[:, t] if i else np.zeros(1)
                u = int(options.argmax())
                if options[u] + s[k, t] > value[j, t]:
                    value[j, t], came[j, t] = options[u] + s[k, t], (i, u)
        out, j, t = [], n, int(value[n].argmax())
        while j:
            i, u = came[j, t]
            if t != OUTSIDE:
                out.append((i, j, t))
            j, t = i, u
        return out[::-1]


def gold(text: str, words: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The segmentation of a window into base spans of at most LONGEST words and single words outside."""
    out, k = [], 0
    starts = {}
    for kind, a, b in spans:
        inside = [n for n, (c, d) in enumerate(words) if c < b and a < d]
        if inside and len(inside) <= LONGEST and inside[0] not in starts:
            starts[inside[0]] = (inside[-1] + 1, kind)
    while k < len(words):
        j, kind = starts.get(k, (k + 1, OUTSIDE))
        out.append((k, j, kind))
        k = j
    return out


def train(texts: list[str]) -> Model:
    """Adagrad on the likelihood of the base segmentation of each window's text."""
    model = Model(np.zeros((OUTSIDE + 1, N_FEATURES)), np.zeros((OUTSIDE + 1, OUTSIDE + 1)))
    model.weights[OUTSIDE, 0] = 1e-3  # what nothing speaks for is outside
    cases = []
    for text in texts:
        words = [m.span() for m in _WORD.finditer(text)]
        for a in range(0, len(words), 24):  # a longer window is cut for the fit only
            part = words[a : a + 24]
            lattice = Lattice.of(text, part)
            place = {seg: k for k, seg in enumerate(lattice.segments)}
            steps = gold(text, part, base_spans(text))
            cases.append((lattice, [(place[i, j], t) for i, j, t in steps]))
    squares = np.full_like(model.weights, 1e-6), np.full_like(model.moves, 1e-6)
    for _ in range(EPOCHS):
        for lattice, steps in cases:
            p, moved = model.expected(lattice)
            p, moved = -p, -moved
            for n, (k, t) in enumerate(steps):
                p[k, t] += 1
                if n:
                    moved[steps[n - 1][1], t] += 1
            slope = np.zeros_like(model.weights)
            for k, f in enumerate(lattice.on):
                slope[:, f] += p[k][:, None]
            slope -= 1e-4 * model.weights
            for theta, g, sq in ((model.weights, slope, squares[0]), (model.moves, moved, squares[1])):
                sq += g * g
                theta += 0.3 * g / np.sqrt(sq)
    return model


def _marked(batch: pa.RecordBatch) -> Iterator[tuple[int, str]]:
    """Row and text of those with a digit or an @."""
    data, offsets = text_bytes(batch.column(1))
    marks = np.concatenate([[0], np.cumsum(np.bincount(np.searchsorted(offsets, np.flatnonzero(_TRIGGER[data]), "right") - 1, minlength=batch.num_rows))])
    for k in np.flatnonzero(np.diff(marks)):
        yield int(k), bytes(data[offsets[k] : offsets[k + 1]]).decode()


def _window_texts(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in source:
        out = [text[words[0][0] : words[-1][1]] for _, text in _marked(batch) for words in windows(text)]
        yield pa.record_batch([pa.array(out, pa.string())], names=["text"])


def fit(docs: DataFrame, most: int = WINDOWS, key: str = "doc_id", text: str = "text") -> Model:
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = rows.mapInArrow(_window_texts, "text string").filter(F.length("text") < 2000).distinct()
    return train([r.text for r in found.orderBy(F.xxhash64("text"), "text").limit(most).collect()])


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def personal_data(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_added of every row."""
    empty = hashlib.sha256(b"").hexdigest()
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]

    def task(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            counts = np.zeros((batch.num_rows, len(KINDS) + 1), np.int64)
            digests, lists = [empty] * batch.num_rows, [""] * batch.num_rows
            for k, s in _marked(batch):
                base = base_spans(s)
                taken = sorted((a, b) for _, a, b in base)
                starts = np.array([a for a, _ in taken], np.int64)
                upto = np.maximum.accumulate([b for _, b in taken]) if taken else starts
                added = []
                for words in windows(s):
                    for i, j, t in model.best(Lattice.of(s, words)):
                        a, b = _trimmed(s, words[i][0], words[j - 1][1])
                        n = int(np.searchsorted(starts, b))
                        if a < b and (n == 0 or upto[n - 1] <= a):
                            added.append((t, a, b))
                for kind, _, _ in base:
                    counts[k, kind] += 1
                counts[k, -1] = len(added)
                digests[k] = hashlib.sha256(_listed(base).encode()).hexdigest()
                lists[k] = _listed(base + added)
            columns = [batch.column(0), *(pa.array(counts[:, n]) for n in range(len(KINDS))), pa.array(digests), pa.array(lists), pa.array(counts[:, -1])]
            yield pa.record_batch(columns, names=names)

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_added long"
    return rows.mapInArrow(task, kind)
