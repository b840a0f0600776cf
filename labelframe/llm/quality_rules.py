"""Line labelling by a linear-chain conditional random field, and rules on top of it.

Every line with a word is described by a few yes/no features.  Viterbi decoding over the
lines of a text marks each as content or boilerplate; the share of words in content
lines decides whether the text is kept.  All lines of a slice are decoded together, one
place in the text at a time.

The weights are learned from texts with a quality label, each of whose lines takes the
label of its text, by gradient ascent on the conditional log likelihood (forward and
backward sums).  Training takes at most ``MOST`` texts with a word of each quality, those with the
least hash of the id, and of each at most ``MOST_LINES`` lines: a text of more gives runs
of ``RUN`` consecutive lines, drawn by hash.  Decoding takes all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelframe.llm.batches import bounded
from labelframe.llm.words import (
    BASE,
    Slice,
    in_row,
    mix,
    repeated_words,
    repeats,
    row_of,
    row_sums,
    slices,
    spans_of,
    split_lines,
    split_words,
)

MOST = 1500
MOST_LINES = 256
RUN = 64
LEAST_WORDS = 10
MOST_REPEATED = 20  # per cent
LEAST_CONTENT = 0.5
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
CAPITALS = (np.arange(256) >= 65) & (np.arange(256) <= 90)
SMALLS = (np.arange(256) >= 97) & (np.arange(256) <= 122)
MARKS = np.arange(256) == ord("!")
STOPS = np.isin(np.arange(256), list(b".!?:;"))
FEATURES = ("always", "symbols", "many symbols", "capitals", "marks", "same word again", "few distinct words", "line again", "windows again", "short", "no full stop")


@dataclass
class Lines:
    """Lines with a word: rows, words of each, features."""

    rows: np.ndarray
    words: np.ndarray
    features: np.ndarray
    duplicate: np.ndarray


def describe_lines(part: Slice, words) -> Lines:
    lines, first_word = split_lines(part, words)
    offsets = np.append(first_word, len(words))
    n = np.diff(offsets)
    data, ends = part.data, lines.ends
    symbols, capitals, smalls, marks = (spans_of(np.flatnonzero(bits[data]), lines) for bits in (SYMBOLS, CAPITALS, SMALLS, MARKS))
    line = np.repeat(np.arange(len(n)), n)
    same = np.zeros(len(words), bool)
    same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (line[1:] == line[:-1])
    _, again = repeats(mix(words.hashes ^ (line.astype(np.uint64) + np.uint64(7)) * np.uint64(0x9E3779B97F4A7C15)))
    windowed = repeated_words(words, least=3)
    _, duplicate = repeats(in_row(lines.rows, lines.hashes))
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    features = np.stack(
        [
            np.ones(len(n), bool),
            symbols > 0.1 * n,
            symbols > 0.6 * n,
            capitals > 0.5 * (capitals + smalls),
            marks > 0.3 * n,
            row_sums(same, offsets) > 0.2 * n,
            row_sums(~again, offsets) < 0.5 * n,
            duplicate,
            row_sums(windowed, offsets) > 0.5 * n,
            n < 4,
            ~STOPS[last],
        ],
        axis=1,
    )
    return Lines(lines.rows, n, features, duplicate)


@dataclass
class Field:
    """Weights: emission (feature, label) and transition (label, next label); label 1 is content."""

    emission: np.ndarray
    transition: np.ndarray


def grid(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each line in its text, and the order of lines by that place."""
    if not len(rows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    place = np.arange(len(rows)) - np.repeat(start, np.diff(np.append(start, len(rows))))
    return place, np.argsort(place, kind="stable")


def steps(rows: np.ndarray) -> list[np.ndarray]:
    """Lines at the first place of their texts, at the second, and so on."""
    place, order = grid(rows)
    return np.split(order, np.cumsum(np.bincount(place))[:-1]) if len(rows) else []


def decode(rows: np.ndarray, features: np.ndarray, field: Field) -> np.ndarray:
    """Viterbi labels of all lines; a tie goes to content."""
    score = features @ field.emission
    back = np.zeros((len(rows), 2), np.int8)
    levels = steps(rows)
    for level in levels[1:]:
        before = score[level - 1]
        for label in (0, 1):
            into = before + field.transition[:, label]
            back[level, label] = into[:, 1] >= into[:, 0]
            score[level, label] += into.max(axis=1)
    out = (score[:, 1] >= score[:, 0]).astype(np.int8)
    for level in levels[:0:-1]:
        out[level - 1] = back[level, out[level]]
    return out


def train(rows: np.ndarray, features: np.ndarray, labels: np.ndarray, rounds: int = 150, penalty: float = 1e-3) -> Field:
    """Field with the greatest penalised conditional likelihood, by Adam steps."""
    x = features.astype(np.float64)
    levels, n = steps(rows), len(rows)
    theta, m, v = np.zeros(2 * x.shape[1] + 4), 0.0, 0.0
    target = np.eye(2)[labels]
    inner = np.flatnonzero(np.append(False, rows[1:] == rows[:-1]))
    seen = np.zeros((2, 2))
    np.add.at(seen, (labels[inner - 1], labels[inner]), 1)
    for step in range(1, rounds + 1):
        emission, transition = theta[:-4].reshape(-1, 2), theta[-4:].reshape(2, 2)
        score = x @ emission
        forward, backward = score.copy(), np.zeros((n, 2))
        for level in levels[1:]:
            forward[level] += np.logaddexp.reduce(forward[level - 1][:, :, None] + transition, axis=1)
        for level in levels[:0:-1]:
            backward[level - 1] = np.logaddexp.reduce(transition + (score[level] + backward[level])[:, None, :], axis=2)
        single = forward + backward
        norm = np.logaddexp.reduce(single, axis=1)
        pair = forward[inner - 1][:, :, None] + transition + (score[inner] + backward[inner])[:, None, :] - norm[inner][:, None, None]
        gradient = np.concatenate([(x.T @ (target - np.exp(single - norm[:, None]))).ravel(), (seen - np.exp(pair).sum(axis=0)).ravel()]) / max(n, 1)
        gradient -= penalty * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        theta = theta + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return Field(theta[:-4].reshape(-1, 2).copy(), theta[-4:].reshape(2, 2).copy())


def draw_lines(rows: np.ndarray, seeds: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines to learn from, at most ``most`` of each text, and the run that each is in.

    A text of no more lines is one run; of another, the runs with the least hash of the
    text's seed and their number are taken.
    """
    place, _ = grid(rows)
    size = min(RUN, most)
    run = np.where(np.bincount(rows)[rows] > most, place // size, 0) if len(rows) else place
    keep = np.ones(len(rows), bool)
    for row in np.unique(rows[run > 0]):
        own = np.flatnonzero(rows == row)
        number = np.arange(run[own[-1]] + 1)
        with np.errstate(over="ignore"):
            drawn = np.argsort(mix(seeds[row] ^ (number.astype(np.uint64) + np.uint64(1)) * BASE))[: most // size]
        keep[own] = np.isin(run[own], drawn)
    at = np.flatnonzero(keep)
    return at, run[at]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    most: int = MOST,
    id_column: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
    most_lines: int = MOST_LINES,
) -> Field:
    """Learn the weights from at most ``most`` labelled texts of each quality, ``most_lines`` lines of each.

    Labels that are null are left out, and so are texts without a word.  Lines are
    described in the tasks; two bytes a line reach the driver.  An id that repeats gives
    one text.  Without two kinds of label all lines count as content, so that the rules
    alone decide.
    """
    if most_lines < 1:
        raise ValueError("most_lines must be 1 at least")
    known = labels.select(F.col(id_column).alias("key"), F.col(quality).cast("int").alias("label"))
    known = known.where("label IS NOT NULL AND key IS NOT NULL").groupBy("key").agg(F.max("label").alias("label"))
    own = bounded(docs).select(F.col(id_column).alias("key"), F.col(text).alias("text"))
    own = own.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    known = known.join(own.select("key").where("key IS NOT NULL").distinct(), "key", "left_semi")
    wanted = None
    for value in (0, 1):
        some = known.where(F.col("label") == value).orderBy(F.xxhash64("key"), "key").limit(most)
        wanted = some if wanted is None else wanted.unionAll(some)
    drawn = wanted.toArrow()
    if len(drawn.column("label").unique()) < 2:
        return Field(np.zeros((len(FEATURES), 2)), np.zeros((2, 2)))
    wanted = docs.sparkSession.createDataFrame(drawn, schema=wanted.schema)
    bits = 1 << np.arange(len(FEATURES))

    def lines_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(3)):
                some = batch.slice(part.first, part.rows)
                lines = describe_lines(part, split_words(part))
                at, run = draw_lines(lines.rows, some.column(2).to_numpy().view(np.uint64), most_lines)
                ends = pa.array(np.append(0, np.cumsum(np.bincount(lines.rows[at], minlength=part.rows))), pa.int32())
                lists = (pa.ListArray.from_arrays(ends, pa.array(x, k)) for x, k in ((lines.features[at] @ bits, pa.int16()), (run, pa.int32())))
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), *lists], names=["key", "label", "lines", "runs"])

    kind = wanted.schema["key"].dataType.simpleString()
    joined = own.join(F.broadcast(wanted), "key").select("key", "label", F.xxhash64("key").alias("seed"), "text")
    described = joined.mapInArrow(lines_of, f"key {kind}, label int, lines array<smallint>, runs array<int>")
    found = described.dropDuplicates(["key"]).orderBy("key").select("label", "lines", "runs").toArrow().combine_chunks()
    if found.num_rows < drawn.num_rows:
        raise ValueError("labelled texts are gone at the second reading; store the documents first")
    lengths = pa.compute.list_value_length(found.column("lines")).to_numpy()
    codes, runs = (np.concatenate([c.flatten().to_numpy() for c in found.column(n).chunks]).astype(np.int64) for n in ("lines", "runs"))
    of = np.repeat(np.arange(len(lengths)), lengths)
    change = (of[1:] != of[:-1]) | (runs[1:] != runs[:-1])
    target = found.column("label").to_numpy().astype(np.int64)[of]
    return train(np.append(0, np.cumsum(change)), (codes[:, None] & bits) > 0, target)


def quality_rules(docs: DataFrame, field: Field, least_content: float = LEAST_CONTENT, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Base counts of every text, the rules on them, and the verdict of the line labels.

    Columns: id, n_words, word_chars (code points in words), n_symbols (of #*$%&|<>),
    n_dup_lines (lines with a word equal to an earlier line of the text),
    n_repeat_words (words in windows of 5 that the text has twice or more),
    base_failed (under 10 words, or over 20 % repeated words), content_share, kept.
    A null text is empty: it has no words, fails the rules, and its content share is 0.
    Repeated rows are judged each; a null id stays.  Nothing is shuffled.
    """

    def judge(part: Slice) -> list[np.ndarray]:
        words = split_words(part)
        offsets, n = words.per_row(part.rows), part.rows
        inner = np.flatnonzero((part.data & 0xC0) == 0x80)  # bytes after the first of a code point
        lines = describe_lines(part, words)
        content = decode(lines.rows, lines.features, field)
        n_words = np.diff(offsets)
        repeat = row_sums(repeated_words(words), offsets)
        failed = (n_words < LEAST_WORDS) | (100 * repeat > MOST_REPEATED * n_words)
        share = np.bincount(lines.rows, content * lines.words, n) / np.maximum(n_words, 1)
        return [
            n_words,
            row_sums(words.ends - words.begins - spans_of(inner, words), offsets),
            np.bincount(row_of(np.flatnonzero(SYMBOLS[part.data]), part.offsets), minlength=n).astype(np.int64),
            np.bincount(lines.rows, lines.duplicate, n).astype(np.int64),
            repeat,
            failed,
            share,
            ~failed & (share >= least_content),
        ]

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "content_share", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                ids = batch.column(0).slice(part.first, part.rows)
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, judge(part))], names=[id_column, *names])

    kind = docs.schema[id_column].dataType.simpleString()
    kinds = ["long"] * 5 + ["boolean", "double", "boolean"]
    schema = ", ".join([f"`{id_column}` {kind}", *(f"{n} {k}" for n, k in zip(names, kinds))])
    return bounded(docs).select(id_column, text).mapInArrow(run, schema)
