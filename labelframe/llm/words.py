"""Texts of an Arrow batch as arrays: bytes, words, lines, windows and their hashes.

A word is a maximal run of characters other than U+0020 and U+0009 to U+000D.  A null
text has no words.  Hashes are 64 bits of the content alone, so that they agree between
tasks; two unequal words or windows share one with a chance of about 2^-64.

Work goes on in slices of a few megabytes of text, so the memory of a task does not
depend on the size of its batches; only a single longer text makes a larger slice.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)


def process_state(name: str, make: Callable[[], object]) -> object:
    """An object kept by the Python worker between its tasks.

    Functions reach the executors by value, so a module of this package is new in each
    task; the state hangs on a module that is made once per process.
    """
    home = sys.modules.setdefault("labelframe_worker_state", types.ModuleType("labelframe_worker_state"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)


def large_state(name: str, make: Callable[[], object]) -> object:
    """Like ``process_state`` for what takes much memory: a worker keeps one such object, that of the operator at work."""
    kept = process_state("large", lambda: {})
    if name not in kept:
        kept.clear()
        kept[name] = make()
    return kept[name]


def forget_others(name: str | None) -> None:
    """Drop the large state unless it has this name."""
    kept = process_state("large", lambda: {})
    if name not in kept:
        kept.clear()


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def seeds(n: int, seed: int = 1) -> np.ndarray:
    """n odd 64-bit multipliers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * BASE + np.uint64(seed)) | np.uint64(1)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string array; null is empty."""
    texts = pc.fill_null(texts, "")
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, places, data = texts.buffers()
    if places is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(places, width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


@dataclass
class Slice:
    """Some rows of a batch: rows [first, last), their bytes, offsets from 0."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    def text(self, row: int) -> str:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes().decode("utf-8", "replace")

    @property
    def rows(self) -> int:
        return self.last - self.first


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a column into slices of at most ``most`` bytes, a longer text alone."""
    data, offsets = buffers(texts)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(n, max(last, first + 1))
        lo, hi = int(offsets[first]), int(offsets[last])
        yield Slice(first, last, data[lo:hi], offsets[first : last + 1] - lo)
        first = last


@dataclass
class Spans:
    """Runs of bytes: begin and end places, row of the slice, hash of the content."""

    begins: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    hashes: np.ndarray

    def __len__(self) -> int:
        return len(self.begins)

    def per_row(self, n: int) -> np.ndarray:
        """Offsets of the rows among the spans."""
        return np.concatenate([[0], np.cumsum(np.bincount(self.rows, minlength=n))]).astype(np.int64)


def powers(base: np.uint64, n: int) -> np.ndarray:
    """The first n powers, kept by the process up to the usual slice."""

    def make(size: int) -> np.ndarray:
        out = np.full(size, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    if n > SLICE_BYTES + 1:
        return make(n)
    return process_state(f"powers_{int(base):x}", lambda: make(SLICE_BYTES + 1))[:n]


def span_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of each run, by differences of prefix sums."""
    n = len(data)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=prefix[1:])
    return mix((prefix[ends] - prefix[begins]) * powers(INVERSE, n + 1)[begins])


def row_of(places: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.searchsorted(offsets, places, "right") - 1


def split_words(part: Slice, lower: bool = False, apart: np.ndarray = SPACES) -> Spans:
    """Words of a slice in order; ``lower`` folds A-Z before hashing, ``apart`` marks the bytes between words."""
    n = len(part.data)
    data = LOWER[part.data] if lower else part.data
    edge = np.zeros(n + 1, bool)
    edge[part.offsets] = True
    inside = ~apart[data]
    first, last = inside.copy(), inside
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    begins, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Spans(begins, ends, row_of(begins, part.offsets), span_hashes(data, begins, ends))


def split_lines(part: Slice, words: Spans) -> tuple[Spans, np.ndarray]:
    """Lines with at least one word, cut at \\n, and the first word of each line."""
    cut = np.flatnonzero(part.data == 10) + 1
    begins = np.union1d(part.offsets[:-1], cut)
    line = np.searchsorted(begins, words.begins, "right") - 1
    used, first_word = np.unique(line, return_index=True)
    limit = np.append(begins, len(part.data))
    lo, hi = begins[used], limit[used + 1]
    if len(hi):
        newline = part.data[hi - 1] == 10
        hi = hi - newline
    return Spans(lo, hi, row_of(lo, part.offsets) if len(lo) else lo, span_hashes(part.data, lo, hi)), first_word


def windows(words: Spans, k: int = 5, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every window of k words inside one row."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j, m in enumerate(seeds(k, seed)):
        h += words.hashes[j : j + n] * m
    at = np.flatnonzero(words.rows[:n] == words.rows[k - 1 :])
    return at, mix(h[at])


def in_row(rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Hash of (row, content)."""
    return mix(hashes ^ (rows.astype(np.uint64) + np.uint64(1)) * BASE)


def repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each key occurs, and whether an equal one stands before it."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    order = np.argsort(keys)
    ordered = keys[order]
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    sizes = np.diff(np.append(starts, len(keys)))
    count, before = np.empty(len(keys), np.int64), np.ones(len(keys), bool)
    count[order] = np.repeat(sizes, sizes)
    before[np.minimum.reduceat(order, starts)] = False
    return count, before


def repeated_words(words: Spans, k: int = 5, least: int = 2) -> np.ndarray:
    """True for each word in a window of k words that its row has ``least`` times or more."""
    at, h = windows(words, k)
    count, _ = repeats(in_row(words.rows[at], h))
    change = np.zeros(len(words) + 1, np.int64)
    hit = at[count >= least]
    change[hit] += 1
    change[hit + k] -= 1
    return np.cumsum(change)[:-1] > 0


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values over [offsets[i], offsets[i + 1])."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64 if values.dtype.kind in "bui" else np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def spans_of(places: np.ndarray, spans: Spans) -> np.ndarray:
    """How many of the ordered places fall into each span."""
    return np.searchsorted(places, spans.ends) - np.searchsorted(places, spans.begins)


def distinct_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the place of one occurrence of each, and which of them each key is."""
    order = np.argsort(keys)
    ordered = keys[order]
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(keys) else np.zeros(0, np.int64)
    inverse = np.empty(len(keys), np.int64)
    inverse[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(keys))))
    return ordered[starts], order[starts], inverse


class KnownWords:
    """Numbers of the words met so far, in the order of their arrival, by hash.

    New words go to a small table, which joins the large one from time to time, so that
    a slice does not copy all that is known.
    """

    JOIN = 60_000

    def __init__(self) -> None:
        self.count = 0
        self.tables = [(np.zeros(0, np.uint64), np.zeros(0, np.int64)) for _ in range(2)]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 where it is new."""
        out = np.full(len(hashes), -1, np.int64)
        for known, numbers in self.tables:
            if len(known):
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = known[at] == hashes
                out[hit] = numbers[at[hit]]
        return out

    def add(self, hashes: np.ndarray) -> None:
        """Number new hashes, given in order."""
        (large, large_numbers), (small, small_numbers) = self.tables
        at = np.searchsorted(small, hashes)
        small = np.insert(small, at, hashes)
        small_numbers = np.insert(small_numbers, at, self.count + np.arange(len(hashes)))
        self.count += len(hashes)
        if len(small) > self.JOIN:
            at = np.searchsorted(large, small)
            large, large_numbers = np.insert(large, at, small), np.insert(large_numbers, at, small_numbers)
            small, small_numbers = small[:0], small_numbers[:0]
        self.tables = [(large, large_numbers), (small, small_numbers)]


class Growing:
    """An array that is appended to, with room to spare."""

    def __init__(self, kind: type) -> None:
        self.data, self.size = np.zeros(1024, kind), 0

    def append(self, values: np.ndarray) -> None:
        end = self.size + len(values)
        if end > len(self.data):
            more = np.zeros(max(end, 3 * len(self.data) // 2), self.data.dtype)
            more[: self.size] = self.data[: self.size]
            self.data = more
        self.data[self.size : end] = values
        self.size = end
