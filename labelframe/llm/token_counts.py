"""Token counts under a unigram segmentation, computed on a trie of distinct words.

Each word is written with a leading word mark and cut into vocabulary pieces so that the
sum of their log probabilities is greatest (on a tie: into fewer pieces).  A distinct
word is inserted into a trie once; a trie node holds the best score and piece count of
its prefix, so words with a common beginning share that work, and the node where a word
ends holds its count.  The trie grows level by level over all words at once.  Words of
more than ``LONG`` characters share few prefixes; each is scored alone by the same rule.

The pieces come from a public vocabulary file in merge order.  Their probabilities
follow Zipf's law over that order, p(r) = 1 / ((r + 1) H); nothing is trained.  A
character that no piece holds costs one byte piece, of the last rank, per UTF-8 byte.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from labelframe.llm.batches import bounded
from labelframe.llm.words import Growing, KnownWords, distinct_of, process_state, row_sums, slices, split_words

MARK = "▁"
POINT = 0x110000
MULTIPLIER = 0xD1342543DE82EF95
MASK = (1 << 64) - 1
KEPT_WORDS = 2_000_000
LONG = 256
LONG_BLOCK = 1 << 15


@dataclass
class Pieces:
    """Piece hashes in order, log probabilities beside them, the longest piece."""

    hashes: np.ndarray
    scores: np.ndarray
    longest: int
    byte_score: float

    def find(self, h: np.ndarray) -> np.ndarray:
        """Score of each hash, -inf where no piece has it."""
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.scores[at], -np.inf)


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def zipf_scores(n: int) -> np.ndarray:
    ranks = np.arange(1, n + 1, dtype=np.float64)
    return -np.log(ranks * (1 / ranks).sum())


def make_pieces(pieces: list[str]) -> Pieces:
    """Lookup of pieces given in rank order; one further rank is the byte piece."""
    scores = zipf_scores(len(pieces) + 1)
    hashes = np.empty(len(pieces), np.uint64)
    for i, piece in enumerate(pieces):
        h = 0
        for c in points(piece).tolist():
            h = (h * MULTIPLIER + c + 1) & MASK
        hashes[i] = h
    order = np.argsort(hashes)
    return Pieces(hashes[order], scores[:-1][order], max(map(len, pieces), default=1), float(scores[-1]))


def vocabulary(path: str) -> list[str]:
    """Ordinary pieces of a sentencepiece file in rank order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    skip = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    ids = [i for i in range(model.get_piece_size()) if not any(f(i) for f in skip)]
    return [model.id_to_piece(i) for i in sorted(ids, key=lambda i: (-model.get_score(i), i))]


def count_long(word: str, pieces: Pieces) -> int:
    """Pieces of one word by the same forward scores, without a trie: few words share so long a prefix.

    The pieces that end at each character are looked up for a block of characters at once.
    """
    chars = points(word).astype(np.uint64)
    longest = min(pieces.longest, len(chars))
    power = [pow(MULTIPLIER, k, 1 << 64) for k in range(longest + 1)]
    scores, counts = deque([0.0], maxlen=longest), deque([0], maxlen=longest)  # of the last ends, the latest last
    prefix = np.zeros(0, np.uint64)  # hash of what precedes each of the last characters
    hash_ = np.uint64(0)
    for begin in range(0, len(chars), LONG_BLOCK):
        block = chars[begin : begin + LONG_BLOCK]
        ends = np.empty(len(block) + 1, np.uint64)
        ends[0] = hash_
        value = int(hash_)
        for k, c in enumerate(block.tolist()):
            value = (value * MULTIPLIER + c + 1) & MASK
            ends[k + 1] = value
        before = np.concatenate([prefix, ends[:-1]])  # before[len(prefix) + i]: the hash before character i
        shift, hits = len(prefix), [[] for _ in block]
        for size in range(1, longest + 1):
            first = max(0, size - 1 - shift)
            if first >= len(block):
                break
            found = pieces.find(ends[1 + first :] - before[shift + first - size + 1 : shift + len(block) - size + 1] * np.uint64(power[size]))
            for i in np.flatnonzero(found > -np.inf).tolist():
                hits[i + first].append((size, float(found[i])))
        for i, c in enumerate(block.tolist()):
            here = hits[i]
            if not here or here[0][0] != 1:
                size = 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
                score, count = scores[-1] + size * pieces.byte_score, counts[-1] + size
            else:
                score, count = -np.inf, 0
            for size, s in here:
                value, total = scores[-size] + s, counts[-size] + 1
                if value > score or (value == score and total < count):
                    score, count = value, total
            scores.append(score)
            counts.append(count)
        hash_ = ends[-1]
        prefix = before[len(before) - min(len(before), longest - 1) :] if longest > 1 else before[:0]
    return counts[-1]


def count_pieces(words: list[str], pieces: Pieces) -> np.ndarray:
    """Pieces of each distinct word, by forward scores on the trie of all of them; words over ``LONG`` alone."""
    long = [i for i, w in enumerate(words) if len(w) > LONG]
    if long:
        out = np.zeros(len(words), np.int64)
        out[long] = [count_long(MARK + words[i], pieces) for i in long]
        short = np.flatnonzero(np.array([len(w) <= LONG for w in words]))
        out[short] = count_pieces([words[i] for i in short.tolist()], pieces)
        return out
    marked = [MARK + w for w in words]
    flat = points("".join(marked))
    lengths = np.array([len(w) for w in marked], np.int64)
    begins = np.cumsum(lengths) - lengths
    out = np.zeros(len(words), np.int64)
    # the last levels of the trie: parent places, prefix hashes, best scores, piece counts
    levels = deque([(None, np.zeros(1, np.uint64), np.zeros(1), np.zeros(1, np.int64))], maxlen=pieces.longest + 1)
    alive, node, depth = np.arange(len(words)), np.zeros(len(words), np.int64), 0
    while len(alive):
        chars = flat[begins[alive] + depth]
        keys, node = np.unique(node * POINT + chars, return_inverse=True)
        parent, char = keys // POINT, keys % POINT
        hashes = levels[-1][1][parent] * np.uint64(MULTIPLIER) + char.astype(np.uint64) + np.uint64(1)
        best, count = np.full(len(keys), -np.inf), np.zeros(len(keys), np.int64)
        place, power = parent, MULTIPLIER
        for back in range(1, len(levels) + 1):
            above, before, scores, counts = levels[-back]
            found = pieces.find(hashes - before[place] * np.uint64(power))
            step = np.ones(len(keys), np.int64)
            if back == 1:
                size = 1 + (char >= 0x80) + (char >= 0x800) + (char >= 0x10000)
                unknown = np.isneginf(found)
                found = np.where(unknown, size * pieces.byte_score, found)
                step = np.where(unknown, size, 1)
            score, total = scores[place] + found, counts[place] + step
            better = (score > best) | ((score == best) & (total < count))
            best, count = np.where(better, score, best), np.where(better, total, count)
            if above is None or back == len(levels):
                break
            place, power = above[place], power * MULTIPLIER & MASK
        levels.append((parent, hashes, best, count))
        depth += 1
        ended = lengths[alive] == depth
        out[alive[ended]] = count[node[ended]]
        alive, node = alive[~ended], node[~ended]
    return out


class WordCounts:
    """Counts of words met so far, by hash; emptied when it holds too many."""

    def __init__(self) -> None:
        self.known, self.counts = KnownWords(), Growing(np.int64)

    def look_up(self, part, words, pieces: Pieces) -> np.ndarray:
        if self.known.count > KEPT_WORDS:
            self.__init__()
        distinct, example, inverse = distinct_of(words.hashes)
        at = self.known.find(distinct)
        new = np.flatnonzero(at < 0)
        if len(new):
            begins, ends = words.begins[example[new]].tolist(), words.ends[example[new]].tolist()
            raw = part.data.tobytes()
            fresh = count_pieces([raw[b:e].decode("utf-8", "replace") for b, e in zip(begins, ends)], pieces)
            at[new] = self.known.count + np.arange(len(new))
            self.known.add(distinct[new])
            self.counts.append(fresh)
        return self.counts.data[at][inverse]


def token_counts(docs: DataFrame, pieces: list[str], id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Words and tokens of every text: (id, n_words, n_tokens).

    A null or empty text has none.  Repeated rows are counted each; a null id stays.
    Other columns are not read.  The pieces travel as one broadcast: their number is
    that of a vocabulary, not of the data.  Nothing is shuffled; the words that a worker
    has counted are kept for its next batches, up to a fixed number.
    """
    made = make_pieces(pieces)
    shared = docs.sparkSession.sparkContext.broadcast((made.hashes, made.scores, made.longest, made.byte_score))

    name = f"token_counts_{hash(made.hashes.tobytes()) & MASK:x}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Pieces(*shared.value)
        state = process_state(name, WordCounts)
        for batch in batches:
            for part in slices(batch.column(1)):
                words = split_words(part)
                offsets = words.per_row(part.rows)
                tokens = row_sums(state.look_up(part, words, table), offsets)
                ids = batch.column(0).slice(part.first, part.rows)
                yield pa.RecordBatch.from_arrays([ids, pa.array(np.diff(offsets)), pa.array(tokens)], names=[id_column, "n_words", "n_tokens"])

    kind = docs.schema[id_column].dataType.simpleString()
    return bounded(docs).select(id_column, text).mapInArrow(run, f"`{id_column}` {kind}, n_words long, n_tokens long")
