"""Packing of token sequences into windows of fixed length, best fit decreasing.

A document is its token ids and one closing id.  A document longer than a window is
first cut into full windows; each rest then goes, longest first, into the open window
with the least remaining capacity that still holds it.  A segment tree over the
remaining capacities finds that window in log2(window) steps.

Tokens come word by word: the tokenizer's pieces never cross white space, so a word is
encoded once per worker and its ids are looked up afterwards (emptied beyond a fixed
number of words).  Packing works on groups of documents that follow one another in a
partition, each of about ``GROUP_TOKENS`` tokens; nothing is shuffled, and a task holds
one group.  Padding is left at the ends of windows only, under one per cent of a group
where its texts are short against a window.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from labelframe.llm.batches import bounded, tidy
from labelframe.llm.words import Growing, KnownWords, Slice, Spans, distinct_of, large_state, process_state, slices, split_words

WINDOW = 2048
CLOSING_ID = 1
GROUP_TOKENS = 4_000_000
KEPT_WORDS = 1_000_000
ENCODED_AT_ONCE = 4096
COLUMNS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


class CapacityTree:
    """Open windows by remaining capacity; ``take`` finds the tightest that fits."""

    def __init__(self, window: int) -> None:
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def _change(self, capacity: int, by: int) -> None:
        i = capacity + self.leaves
        while i:
            self.count[i] += by
            i >>= 1

    def put(self, capacity: int, window: int) -> None:
        self.open[capacity].append(window)
        self._change(capacity, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """(capacity, window) with the smallest capacity >= least, removed; None without one."""
        count, i = self.count, least + self.leaves
        if not count[i]:
            while i & 1 or not count[i + 1]:  # up until a right neighbour has an open window
                i >>= 1
                if i <= 1:
                    return None
            i += 1
            while i < self.leaves:
                i *= 2
                if not count[i]:
                    i += 1
        capacity = i - self.leaves
        self._change(capacity, -1)
        return capacity, self.open[capacity].pop()


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int], int]:
    """Window and offset of each piece (1 <= length <= window), and the number of windows."""
    tree, n = CapacityTree(window), 0
    place, offset = [0] * len(lengths), [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size = lengths[i]
        found = tree.take(size)
        if found is None:
            found, n = (window, n), n + 1
        capacity, place[i] = found
        offset[i] = window - capacity
        if capacity > size:
            tree.put(capacity - size, place[i])
    return place, offset, n


class WordIds:
    """Token ids of the words met so far."""

    def __init__(self) -> None:
        self.known = KnownWords()
        self.begins, self.lengths, self.pool = Growing(np.int64), Growing(np.int64), Growing(np.uint32)

    def look_up(self, part: Slice, words: Spans, encode) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words of a slice in order, and their number by word."""
        if self.known.count > KEPT_WORDS:
            self.__init__()
        distinct, example, inverse = distinct_of(words.hashes)
        at = self.known.find(distinct)
        new = np.flatnonzero(at < 0)
        if len(new):
            raw = part.data.tobytes()
            begins, ends = words.begins[example[new]].tolist(), words.ends[example[new]].tolist()
            strings = [raw[b:e].decode("utf-8", "replace") for b, e in zip(begins, ends)]
            # an encoding is far larger than its ids
            coded = [x.ids for k in range(0, len(strings), ENCODED_AT_ONCE) for x in encode(strings[k : k + ENCODED_AT_ONCE])]
            lengths = np.array([len(x) for x in coded], np.int64)
            at[new] = self.known.count + np.arange(len(new))
            self.known.add(distinct[new])
            self.begins.append(self.pool.size + np.cumsum(lengths) - lengths)
            self.lengths.append(lengths)
            self.pool.append(np.array([i for x in coded for i in x], np.uint32))
        lengths, begins = self.lengths.data[at][inverse], self.begins.data[at][inverse]
        shift = np.repeat(begins - (np.cumsum(lengths) - lengths), lengths)
        return self.pool.data[shift + np.arange(len(shift))], lengths


def token_ids(part: Slice, state: WordIds, encode, closing: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a slice, each with its closing id, and the offsets of the texts."""
    words = split_words(part)
    ids, lengths = state.look_up(part, words, encode)
    ends = np.concatenate([[0], np.cumsum(lengths)])[words.per_row(part.rows)]
    ids = np.insert(ids, ends[1:], closing).astype("<u4")
    return ids, ends + np.arange(len(ends))


def encoder(tokenizer: str, special_as_text: bool = False):
    """A function from words to their encodings, by a tokenizer's JSON, without added special ids."""
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    made = Tokenizer.from_str(tokenizer)
    made.encode_special_tokens = special_as_text
    return lambda words: made.encode_batch_fast(words, add_special_tokens=False)


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    closing: int = CLOSING_ID,
    with_ids: bool = False,
    special_as_text: bool = False,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of all documents and their places: (id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]).

    ``tokenizer`` is the JSON of a fast tokenizer whose pieces do not cross white space;
    special words in a text give their special ids unless ``special_as_text``.  ``start`` counts the document's ids
    before the piece, ``offset`` those before it in its sequence, without gaps.
    ``ids_crc32`` is the unsigned CRC-32 of the ids as little-endian 32-bit integers.
    A null or empty text is its closing id alone.  Repeated rows and null ids are packed
    each; other columns are not read.  Sequence ids are unique, not consecutive.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)
    name = f"packing_{zlib.crc32(tokenizer.encode())}_{special_as_text}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = process_state(f"{name}_encode", lambda: encoder(shared.value, special_as_text))
        state = large_state(name, WordIds)
        first_id = TaskContext.get().partitionId() << 40
        keys, pieces, kept, tokens = [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal first_id, tokens
            start, length, crc, total = (np.concatenate(c) for c in zip(*pieces))
            full = length == window
            sequence, offset = np.empty(len(start), np.int64), np.zeros(len(start), np.int64)
            sequence[full] = np.arange(full.sum())
            place, where, n = best_fit(length[~full].tolist(), window)
            sequence[~full], offset[~full] = np.array(place, np.int64) + full.sum(), where
            columns = [pa.concat_arrays(keys), *map(pa.array, (start, length, crc, total, sequence + first_id, offset))]
            if with_ids:
                lists = np.concatenate(kept).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(np.append(0, np.cumsum(length)).astype(np.int32), lists))
            first_id += int(full.sum()) + n
            tokens = 0
            keys.clear(), pieces.clear(), kept.clear()
            return pa.RecordBatch.from_arrays(columns, names=[id_column, *COLUMNS, "ids"][: len(columns)])

        for batch in batches:
            for part in slices(batch.column(1)):
                ids, ends = token_ids(part, state, encode, closing)
                total = np.diff(ends)
                cuts = -(-total // window)  # pieces of each document
                row = np.repeat(np.arange(part.rows), cuts)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * window
                length = np.minimum(total[row] - start, window)
                at = (ends[row] + start).tolist()
                raw = memoryview(ids.tobytes())
                crc = np.array([zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at, length.tolist())], np.int64)
                keys.append(batch.column(0).slice(part.first, part.rows).take(pa.array(row)))
                pieces.append((start, length, crc, total[row]))
                if with_ids:
                    kept.append(ids)
                tokens += len(ids)
                if tokens >= GROUP_TOKENS:
                    yield flush()
        if pieces:
            yield flush()

    kind = docs.schema[id_column].dataType.simpleString()
    schema = ", ".join([f"`{id_column}` {kind}", *(f"{c} long" for c in COLUMNS), *["ids array<int>"] * with_ids])
    return bounded(docs).select(id_column, text).mapInArrow(tidy(run, name), schema)
