"""A quality classifier from heuristic labellers, without given labels.

Each labeller measures one share of a text and votes keep, reject or nothing.
Expectation-maximisation over the counts of vote patterns estimates how each labeller
votes on good and on bad texts, and with that the probability that a text of each
pattern is good.  The pattern counts cover all texts; there are at most 3^k of them.

These posterior labels train a linear scorer on hashed word features.  It is fitted on
a sample of at most ``SAMPLE`` texts (a documented bound of fitting alone) and scores all
texts; its score decides.  Equal rows are drawn as one, in proportion to their number, by
priority: a hash of id and text divided by that number.  What is drawn stands for as many
rows as its weight says, so a group that makes up a third of the table has a third of the
weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelframe.llm.batches import bounded, tidy
from labelframe.llm.words import Slice, in_row, mix, repeated_words, repeats, row_sums, slices, spans_of, split_words

SAMPLE = 6000
BUCKETS = 512
ROUNDS = 200
SPARE = 1.2  # part of the sample ranked, so that it is full
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
CAPITALS = (np.arange(256) >= 65) & (np.arange(256) <= 90)
LETTERS = CAPITALS | ((np.arange(256) >= 97) & (np.arange(256) <= 122)) | (np.arange(256) >= 128)
MARKS = np.arange(256) == ord("!")

# (share, keep at or below, reject at or above); the shares overlap, so that several speak on each kind of junk
LABELLERS = (
    ("symbols by word", 0.05, 0.25),
    ("words with a symbol", 0.05, 0.2),
    ("exclamation marks by word", 0.1, 0.5),
    ("bytes equal to the one before", 0.06, 0.12),
    ("capitals by letter", 0.2, 0.6),
    ("words equal to the one before", 0.1, 0.3),
    ("words met before", 0.45, 0.55),
    ("words in windows met 3 times or more", 0.2, 0.5),
)


@dataclass
class Described:
    """Words by text, labeller shares (text, labeller), hashed feature shares (text, bucket)."""

    n_words: np.ndarray
    shares: np.ndarray
    features: np.ndarray


def describe(part: Slice, hashed: bool = True) -> Described:
    words = split_words(part)
    offsets, rows = words.per_row(part.rows), part.rows
    data, begins, ends = part.data, words.begins, words.ends
    n_words = np.diff(offsets)
    n = np.maximum(n_words, 1)
    symbols, marks, capitals, letters = (spans_of(np.flatnonzero(bits[data]), words) for bits in (SYMBOLS, MARKS, CAPITALS, LETTERS))
    twice = np.flatnonzero(data[1:] == data[:-1]) + 1
    twice = np.setdiff1d(twice, part.offsets)  # the byte before a text is another text's
    same = np.zeros(len(words), bool)
    same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (words.rows[1:] == words.rows[:-1])
    _, before = repeats(in_row(words.rows, words.hashes))
    window = repeated_words(words, least=3)
    parts = (symbols, symbols > 0, marks, spans_of(twice, words), capitals, same, before, window)
    below = [n, n, n, np.maximum(row_sums(ends - begins, offsets), 1), np.maximum(row_sums(letters, offsets), 1), n, n, n]
    shares = np.stack([row_sums(x, offsets) / d for x, d in zip(parts, below)], axis=1)
    if not hashed:
        return Described(n_words, shares, np.zeros((rows, 0)))
    length = np.minimum(np.searchsorted([4, 8, 13, 30], ends - begins, "right"), 4)
    shouted = (capitals > 1) & (letters == capitals)
    shape = length + 8 * np.minimum(symbols, 3) + 32 * shouted + 64 * np.minimum(marks, 3) + 256 * window + 512 * same
    tail = data[ends - 1].astype(np.int64) if len(ends) else np.zeros(0, np.int64)
    long = ends - begins > 1
    tail[long] += 256 * data[ends[long] - 2].astype(np.int64)
    features = np.zeros((rows, BUCKETS), np.float32)
    for kind, value in ((1, shape), (2, before * 1), (3, tail), (4, window + 2 * before + 4 * same)):
        bucket = (mix(value.astype(np.uint64) + np.uint64(kind << 32)) % np.uint64(BUCKETS)).astype(np.int64)
        features += np.bincount(words.rows * BUCKETS + bucket, minlength=rows * BUCKETS).reshape(rows, BUCKETS)
    return Described(n_words, shares, features / n[:, None].astype(np.float32))


def votes(shares: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """1 keep, 0 nothing, -1 reject, by text and labeller; texts without words get none."""
    low, high = (np.array([x[i] for x in LABELLERS]) for i in (1, 2))
    out = (shares <= low).astype(np.int8) - (shares >= high)
    out[n_words == 0] = 0
    return out


def patterns(v: np.ndarray) -> np.ndarray:
    return ((v + 1).astype(np.int64) * 3 ** np.arange(v.shape[1])).sum(axis=1)


@dataclass
class Labels:
    """What expectation-maximisation found: prior of good, P(vote | class), P(good) by pattern."""

    prior: float
    accuracy: np.ndarray  # (labeller, class, vote + 1), class 1 is good
    posterior: np.ndarray


def weak_labels(codes: np.ndarray, counts: np.ndarray, k: int, rounds: int = 200) -> Labels:
    """Estimate the labellers from the counts of vote patterns.

    It starts from "good unless some labeller rejects"; counts are smoothed by one.
    """
    v = codes[:, None] // 3 ** np.arange(k) % 3  # 0 reject, 1 nothing, 2 keep
    good = np.where((v == 0).any(axis=1), 0.1, 0.9)
    prior, accuracy = 0.5, np.full((k, 2, 3), 1 / 3)
    for _ in range(rounds):
        weight = np.stack([(1 - good) * counts, good * counts])
        prior = (weight[1].sum() + 1) / (weight.sum() + 2)
        for vote in range(3):
            accuracy[:, :, vote] = ((v == vote).T @ weight.T + 1) / (weight.sum(axis=1) + 3)
        odds = np.log(prior) - np.log1p(-prior)
        for j in range(k):
            odds = odds + np.log(accuracy[j, 1, v[:, j]]) - np.log(accuracy[j, 0, v[:, j]])
        before, good = good, 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        if np.abs(good - before).max(initial=0) < 1e-9:
            break
    everything = np.arange(3**k)
    table = everything[:, None] // 3 ** np.arange(k) % 3
    odds = np.log(prior) - np.log1p(-prior)
    for j in range(k):
        odds = odds + np.log(accuracy[j, 1, table[:, j]]) - np.log(accuracy[j, 0, table[:, j]])
    return Labels(float(prior), accuracy, 1 / (1 + np.exp(-np.clip(odds, -500, 500))))


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, penalty: float = 1e-5, times: np.ndarray | None = None) -> np.ndarray:
    """Weights and a bias for soft labels y of rows that count ``times``, both classes with equal weight in all; Adam steps."""
    x = x.astype(np.float64)
    times = np.ones(len(y)) if times is None else times * (len(y) / times.sum())
    good, bad = (times * y).sum(), (times * (1 - y)).sum()
    weight = times * (y / max(good, 1e-9) + (1 - y) / max(bad, 1e-9)) if good > 0.5 and bad > 0.5 else times / max(len(y), 1)
    target = np.where(weight > 0, (times * y / max(good, 1e-9)) / weight, y) if good > 0.5 and bad > 0.5 else y
    w, m, v = np.zeros(x.shape[1] + 1), 0.0, 0.0
    for step in range(1, rounds + 1):
        error = weight * (1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -500, 500))) - target)
        gradient = np.append(x.T @ error + penalty * w[:-1], error.sum())
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        w -= 0.3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return w


@dataclass
class Model:
    labels: Labels
    weights: np.ndarray = field(repr=False)


def fit(docs: DataFrame, sample: int = SAMPLE, id_column: str = "doc_id", text: str = "text") -> Model:
    """Estimate the labellers on all texts, then train the scorer on a sample of at most ``sample``.

    An empty table gives a model that keeps every text with words.
    """
    k = len(LABELLERS)
    own = bounded(docs).select(F.col(text).alias("text"), F.xxhash64(F.col(id_column), F.col(text)).alias("draw"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(3**k, np.int64)
        for batch in batches:
            for part in slices(batch.column(0)):
                d = describe(part, hashed=False)
                total += np.bincount(patterns(votes(d.shares, d.n_words))[d.n_words > 0], minlength=3**k)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["pattern", "n"])

    found = own.select("text").mapInArrow(tidy(vote), "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).toArrow()
    codes, n = (found.column(c).to_numpy().astype(np.int64) for c in ("pattern", "n"))
    order = np.argsort(codes)
    labels = weak_labels(codes[order], n[order], k)
    if not n.sum():
        return Model(labels, np.append(np.zeros(BUCKETS), 1.0))
    # a group of equal rows is one row with its number; ranks below the limit suffice for a full sample
    limit = SPARE * sample / int(n.sum())
    real = own.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    rank = (F.shiftrightunsigned("draw", 11) + 0.5) / 2.0**53 / F.col("n")
    ranked = real.groupBy("draw").agg(F.count("*").alias("n")).withColumn("rank", rank).where(F.col("rank") < limit)
    first = ranked.orderBy("rank", "draw").limit(sample + 1).toArrow().sort_by("rank")
    if first.num_rows > sample:
        limit, first = first.column("rank")[sample].as_py(), first.slice(0, sample)
    if not first.num_rows:
        return Model(labels, np.append(np.zeros(BUCKETS), 1.0))
    times = np.maximum(first.column("n").to_numpy(), 1 / limit)
    drawn = docs.sparkSession.createDataFrame(pa.table({"draw": first.column("draw")}))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            new = []
            for i, key in enumerate(batch.column(1).to_pylist()):
                if key not in seen:
                    seen.add(key)
                    new.append(i)
            some = batch.take(pa.array(new, pa.int64()))
            for part in slices(some.column(0)):
                d = describe(part)
                code = patterns(votes(d.shares, d.n_words))
                flat = pa.FixedSizeListArray.from_arrays(pa.array(d.features.ravel()), BUCKETS).cast(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([some.column(1).slice(part.first, part.rows), pa.array(code), flat], names=["draw", "pattern", "features"])

    some = real.join(F.broadcast(drawn), "draw").select("text", "draw").mapInArrow(tidy(draw), "draw long, pattern long, features array<float>")
    some = some.dropDuplicates(["draw"]).toArrow().sort_by("draw")  # the same sums whatever the order of arrival
    x = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in some.column("features").chunks]).reshape(-1, BUCKETS)
    order = np.argsort(first.column("draw").to_numpy())
    return Model(labels, logistic(x, labels.posterior[some.column("pattern").to_numpy()], times=times[order]))


def score(part: Slice, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, posterior of the votes, probability of the scorer; 0 for a text without words."""
    d = describe(part)
    p = 1 / (1 + np.exp(-np.clip(d.features @ model.weights[:-1] + model.weights[-1], -500, 500)))
    return d.n_words, model.labels.posterior[patterns(votes(d.shares, d.n_words))], np.where(d.n_words > 0, p, 0.0)


def classify(docs: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, weak_label, p_quality, kept) of every text; kept if p_quality >= 0.5.

    A null, empty or blank text has p_quality 0 and is rejected.  Repeated rows are
    scored each; a null id stays.  Nothing is shuffled.
    """
    names = [id_column, "n_words", "weak_label", "p_quality", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                n, weak, p = score(part, model)
                ids = batch.column(0).slice(part.first, part.rows)
                yield pa.RecordBatch.from_arrays([ids, pa.array(n), pa.array(weak), pa.array(p), pa.array(p >= 0.5)], names=names)

    kind = docs.schema[id_column].dataType.simpleString()
    return bounded(docs).select(id_column, text).mapInArrow(tidy(run), f"`{id_column}` {kind}, n_words long, weak_label double, p_quality double, kept boolean")


def keep_good(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows that the scorer keeps, with all their columns."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(place)):
                yield batch.slice(part.first, part.rows).filter(pa.array(score(part, model)[2] >= 0.5))

    return bounded(docs).mapInArrow(tidy(run), docs.schema)
