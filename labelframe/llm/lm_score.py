"""Language-model scores by deleted interpolation of n-gram estimates.

The model mixes the maximum-likelihood estimates of bigram and unigram with a uniform
share for unknown words,

    P(w | v) = l2(b) c(v w) / c(v) + l1(b) c(w) / N + l0(b) / (V + 1),

where b is the bucket (binary logarithm) of the context's count c(v).  The weights are
learned by expectation-maximisation: a fifth of the training texts is deleted from the
counts, and its tokens are predicted from the rest.  The final counts take all of the
training texts.  A text begins in a start context and ends with an end token.

Counts are exact and cover all texts.  A task reads a block of texts, and sends each
distinct n-gram of the block once, with its counts, to the task that owns its range of
hashes; that task adds up and answers every block.  Texts and answers of a block meet in
a cogroup, which leaves two counts per token.  No n-gram, however frequent, is sent more
than once per block, and no task holds more than a block or a range; their number grows
with the texts.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelframe.functions.checkpoints import materialize
from labelframe.functions.memory import tidy_pair
from labelframe.llm.batches import bounded, tidy
from labelframe.llm.words import BASE, Slice, mix, row_sums, slices, split_words

FOLDS = 5
HELD_OUT = 1
DELETED = 2
BLOCK_BYTES = 8 << 20
ROW_BYTES = 16  # what a row counts in a block besides its text: null and empty texts have an end token too
RANGE_BYTES = 8 << 20
SENT_BYTES = 2 << 20  # lists of counts go to Spark in batches of about this size
BUCKETS = 64  # binary logarithms of a 64-bit count
BINS = 8  # bins of the weights' statistics in a factor of two
ROUNDS = 100
END = np.uint64(0x2545F4914F6CDD1D)
START = np.uint64(0x9FB21C651E98DF25)


def token_keys(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unigram keys, bigram keys and row offsets of the tokens of a slice: its words, then an end, by row."""
    words = split_words(part, lower=True)
    ends = words.per_row(part.rows)
    tokens = np.insert(words.hashes, ends[1:], END)
    offsets = ends + np.arange(len(ends))
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[offsets[:-1]] = START
    return tokens, mix(before * BASE + mix(tokens)), offsets


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the keys, where each distinct one starts in it, and how often it occurs."""
    order = np.argsort(keys)
    ordered = keys[order]
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(keys) else np.zeros(0, np.int64)
    return order, starts, np.diff(np.append(starts, len(keys)))


def sums(values: np.ndarray, order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values[order], starts) if len(starts) else np.zeros(0, np.int64)


def blocks(batches: Iterator[pa.RecordBatch], text_at: int, make: Callable | None = None) -> Iterator[tuple[int, list]]:
    """Consecutive rows of a partition in blocks of bounded text and number, with an id for each block.

    A block is a list of (rows, slice), or of what ``make`` takes from them as they come.
    """
    first, number, held, size = TaskContext.get().partitionId() << 28, 0, [], 0
    for batch in batches:
        for part in slices(batch.column(text_at)):
            rows = batch.slice(part.first, part.rows)
            held.append(make(rows, part) if make else (rows, part))
            size += len(part.data) + ROW_BYTES * part.rows
            if size >= BLOCK_BYTES:
                yield first + number, held
                number, held, size = number + 1, [], 0
    if held:
        yield first + number, held


def occurrences(some: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """How often each of the ordered distinct keys occurs among some of them."""
    return np.bincount(np.searchsorted(distinct, np.sort(some)), minlength=len(distinct))


def in_pieces(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """A batch of ``size`` bytes in consecutive batches of about ``SENT_BYTES``."""
    step = max(1, batch.num_rows * SENT_BYTES // max(1, size))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def count_requests(docs: DataFrame, ranges: int) -> DataFrame:
    """(block, range, size, keys, total, deleted): each distinct key of a block with its training counts."""

    def coded(rows: pa.RecordBatch, part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        unigrams, bigrams, offsets = token_keys(part)
        return unigrams, bigrams, np.repeat(rows.column(1).to_numpy().astype(np.int8), np.diff(offsets))

    def requests(block: int, size: int, keys: np.ndarray, fold: np.ndarray) -> Iterator[pa.RecordBatch]:
        held_out, left_out = keys[fold == HELD_OUT], keys[fold == DELETED]
        keys.sort()
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        distinct, total = keys[starts], np.diff(np.append(starts, len(keys)))
        del keys, starts
        total -= occurrences(held_out, distinct)
        deleted = occurrences(left_out, distinct)
        owner = ((distinct >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
        cut = np.append(np.flatnonzero(np.append(True, owner[1:] != owner[:-1])), len(owner))
        n = len(cut) - 1
        offsets = pa.array(cut, pa.int32())
        made = pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, block, np.int64)),
                pa.array(owner[cut[:-1]].astype(np.int32)),
                pa.array(np.full(n, size, np.int32)),
                *(pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (distinct.view(np.int64), total, deleted)),
            ],
            names=["block", "range", "size", "keys", "total", "deleted"],
        )
        yield from in_pieces(made, 24 * len(distinct))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, held in blocks(batches, 2, coded):
            *keys, fold = ([m[i] for m in held] for i in range(3))
            held.clear()  # each list goes once it is joined, all before the next block is read
            fold = np.concatenate(fold)
            for size in (1, 2):
                yield from requests(block, size, np.concatenate(keys.pop(0)), fold)

    schema = "block long, `range` int, size int, keys array<long>, total array<long>, deleted array<long>"
    return docs.select("id", "fold", "text").mapInArrow(tidy(run), schema)


def add_up(requests: DataFrame, ranges: int) -> DataFrame:
    """Answers (block, range, size, check, total, deleted) with the sums over all blocks.

    The first answer of a range also carries its
    distinct known tokens and its tokens, of all training texts and of the kept ones.
    """

    def added(own: pa.Table, size: int) -> Iterator[pa.RecordBatch]:
        about = [own.column(c).combine_chunks() for c in ("block", "range", "size")]
        ends = np.append(0, np.cumsum(pa.compute.list_value_length(own.column("keys")).to_numpy()))
        keys, total, deleted = (flat(own.column(c)) for c in ("keys", "total", "deleted"))
        del own
        order, starts, times = grouped(keys)
        with np.errstate(over="ignore"):
            check = row_check(keys, ends)
        del keys
        all_, gone = sums(total, order, starts), sums(deleted, order, starts)
        answer, absent = total, deleted  # whose place the sums take
        answer[order], absent[order] = np.repeat(all_, times), np.repeat(gone, times)
        offsets = pa.array(ends, pa.int32())
        stats = np.zeros((3, len(check)), np.int64)
        if size == 1:
            stats[:, 0] = (all_ > 0).sum(), all_.sum(), (all_ - gone).sum()
        made = pa.RecordBatch.from_arrays(
            [
                *about,
                pa.array(check),
                pa.ListArray.from_arrays(offsets, pa.array(answer)),
                pa.ListArray.from_arrays(offsets, pa.array(absent)),
                *map(pa.array, stats),
            ],
            names=["block", "range", "size", "check", "total", "deleted", "known", "tokens", "kept_tokens"],
        )
        yield from in_pieces(made, 16 * len(answer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        for size in (1, 2):
            own = pa.Table.from_batches([b.filter(pa.compute.equal(b.column("size"), size)) for b in held])
            if own.num_rows:
                yield from added(own, size)

    schema = "block long, `range` int, size int, check long, total array<long>, deleted array<long>, known long, tokens long, kept_tokens long"
    return requests.repartitionById(ranges, F.col("range")).mapInArrow(tidy(run), schema)


def flat(column: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy() for c in column.chunks] or [np.zeros(0, np.int64)])


def row_check(keys: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Wrapping sum of the keys of each row."""
    total = np.concatenate([[0], np.cumsum(keys.view(np.int64))])
    return total[ends[1:]] - total[ends[:-1]]


def counted(docs: DataFrame, answers: DataFrame) -> DataFrame:
    """Counts of every token: (id, fold, unigram, bigram, kept_unigram, kept_bigram); the kept ones of deleted texts only."""
    key = docs.schema["id"].dataType

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, held in blocks(batches, 2):
            for batch, _ in held:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, block, np.int64)), *batch.columns], names=["block", "id", "fold", "text"])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, folds = left.column("id"), left.column("fold").to_numpy()
        made = [token_keys(part) for chunk in left.column("text").chunks for part in slices(chunk)]
        n_tokens = np.concatenate([np.diff(m[2]) for m in made])
        by_size = {size: [m[size - 1] for m in made] for size in (1, 2)}
        del made
        ends = np.append(0, np.cumsum(n_tokens))
        deleted = np.repeat(folds == DELETED, n_tokens)
        kept_ends = np.append(0, np.cumsum(n_tokens * (folds == DELETED)))
        columns = {}
        for size, name in ((1, "unigram"), (2, "bigram")):
            keys = np.concatenate(by_size.pop(size))
            own = right.take(pa.array(np.flatnonzero(right.column("size").to_numpy() == size))).sort_by("range").combine_chunks()
            order, starts, times = grouped(keys)
            lengths = pa.compute.list_value_length(own.column("total")).to_numpy()
            cut = np.append(0, np.cumsum(lengths))
            if cut[-1] != len(starts) or (row_check(keys[order[starts]], cut) != own.column("check").to_numpy()).any():
                raise ValueError("the documents came in another order at the second reading; store them first")
            n, total = len(keys), flat(own.column("total"))
            del keys
            for sums_, prefix, offsets in ((total, "", ends), (total - flat(own.column("deleted")), "kept_", kept_ends)):
                of_token = np.empty(n, np.int64)
                of_token[order] = np.repeat(sums_, times)
                values = of_token[deleted] if prefix else of_token
                columns[prefix + name] = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))
        return pa.table({"id": ids, "fold": left.column("fold"), **columns})

    schema = f"id {key.simpleString()}, fold long, unigram array<long>, kept_unigram array<long>, bigram array<long>, kept_bigram array<long>"
    placed = docs.select("id", "fold", "text").mapInArrow(tidy(texts), f"block long, id {key.simpleString()}, fold long, text string")
    return placed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(tidy_pair(meet), schema)


def contexts(unigram: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Count of each token's context: of the token before, or of the start, which is as frequent as the end."""
    out = np.empty_like(unigram)
    out[1:] = unigram[:-1]
    out[offsets[:-1]] = unigram[offsets[1:] - 1]
    return out


def bucket_of(counts: np.ndarray) -> np.ndarray:
    """Bit length of each count."""
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def ratio(above: np.ndarray, below: np.ndarray | float) -> np.ndarray:
    return above / np.maximum(below, 1)


def evidence(counts: DataFrame, tokens: int, uniform: float) -> DataFrame:
    """(bucket, bigram_bin, unigram_bin, n, bigram_log, unigram_log) over the tokens of the deleted texts.

    The bins are logarithmic, so the table has a bounded number of rows; each keeps the
    sums of its logarithms of estimate / uniform.  Bin -1 is an estimate of zero.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uni, bi = (c.flatten().to_numpy() for c in batch.columns)
            offsets = np.append(0, np.cumsum(pa.compute.list_value_length(batch.column(0)).to_numpy()))
            context = contexts(uni, offsets)
            logs, bins = [], []
            for p in (ratio(bi, context), ratio(uni, tokens)):
                log = np.log2(np.maximum(p, 1e-300) / uniform)
                logs.append(np.where(p > 0, log, 0.0))
                bins.append(np.where(p > 0, np.clip(np.floor(log * BINS), -1000, 1000) + 1001, 0).astype(np.int64))
            cell = (bucket_of(context) * 2048 + bins[0]) * 2048 + bins[1]
            order, starts, times = grouped(cell)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell[order[starts]]), pa.array(times), *(pa.array(np.asarray(sums(x, order, starts), float)) for x in logs)],
                names=["cell", "n", "bigram_log", "unigram_log"],
            )

    own = counts.where(F.col("fold") == DELETED).select("kept_unigram", "kept_bigram")
    found = own.mapInArrow(tidy(run), "cell long, n long, bigram_log double, unigram_log double")
    return found.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("bigram_log").alias("bigram_log"), F.sum("unigram_log").alias("unigram_log"))


def learn_weights(cells: np.ndarray, n: np.ndarray, bigram_log: np.ndarray, unigram_log: np.ndarray) -> np.ndarray:
    """(bucket, 3) weights of bigram, unigram and uniform, by expectation-maximisation.

    Each weight starts equal and is smoothed by one event; a bucket without events takes
    the weights of all buckets together.  Context 0 has no bigram weight.
    """
    bucket, bi, uni = cells // (2048 * 2048), cells // 2048 % 2048, cells % 2048
    p = np.stack([np.where(bi > 0, np.exp2(bigram_log / n), 0.0), np.where(uni > 0, np.exp2(unigram_log / n), 0.0), np.ones(len(n))], axis=1)

    def estimate(rows: np.ndarray) -> np.ndarray:
        w = np.full(3, 1 / 3)
        for _ in range(ROUNDS):
            share = p[rows] * w
            share = share / share.sum(axis=1, keepdims=True) * n[rows][:, None]
            w = (share.sum(axis=0) + 1) / (n[rows].sum() + 3)
        return w

    pooled = estimate(np.arange(len(n)))
    out = np.tile(pooled, (BUCKETS + 1, 1))
    for b in np.unique(bucket).tolist():
        out[b] = estimate(np.flatnonzero(bucket == b))
    out[0, 0] = 0
    return out / out.sum(axis=1, keepdims=True)


def lm_score(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of every text: (id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Words are folded to lower case in A-Z.  Texts with crc32(id as text) mod 5 = 1 are
    held out, the others train; a null id trains.  ``n_known`` tokens occur in training;
    ``base_score`` is the sum of log10((c + 0.5) / (N + 0.5 (V + 1))), ``score`` the
    log10 probability under the model.  A null or empty text is an end token alone.
    Without training texts every token has the uniform share, which is 1.
    Repeated rows count and are scored each.

    ``docs`` is read twice and must come in the same order both times, as a stored table
    does; a checksum of each block finds an order that has changed.
    """
    fold = F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(FOLDS)), F.lit(0)).cast("long")
    own = bounded(docs).select(F.col(id_column).alias("id"), fold.alias("fold"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, math.ceil(size / RANGE_BYTES))
    answers = materialize(add_up(count_requests(own, ranges), ranges))
    known, tokens, kept_tokens = (x or 0 for x in answers.agg(F.sum("known"), F.sum("tokens"), F.sum("kept_tokens")).first())
    counts = materialize(counted(own, answers.drop("known", "tokens", "kept_tokens")))
    uniform = 1 / (known + 1)
    found = evidence(counts, kept_tokens, uniform).orderBy("cell").toArrow()
    weights = learn_weights(*(found.column(c).to_numpy() for c in ("cell", "n", "bigram_log", "unigram_log")))
    if not tokens:
        weights[:] = 0, 0, 1
    names = [id_column, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uni, bi = (batch.column(i).flatten().to_numpy() for i in (2, 3))
            offsets = np.append(0, np.cumsum(pa.compute.list_value_length(batch.column(2)).to_numpy()))
            context = contexts(uni, offsets)
            w = weights[bucket_of(context)]
            p = w[:, 0] * ratio(bi, context) + w[:, 1] * ratio(uni, tokens) + w[:, 2] * uniform
            base = np.log10((uni + 0.5) / (tokens + 0.5 * (known + 1)))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(batch.column(1).to_numpy() == HELD_OUT),
                    pa.array(np.diff(offsets)),
                    pa.array(row_sums(uni > 0, offsets)),
                    pa.array(np.full(n, tokens, np.int64)),
                    pa.array(np.add.reduceat(base, offsets[:-1])),
                    pa.array(np.add.reduceat(np.log10(p), offsets[:-1])),
                ],
                names=names,
            )

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return counts.select("id", "fold", "unigram", "bigram").mapInArrow(tidy(run), schema)
