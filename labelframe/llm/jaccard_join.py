"""Texts whose sets of word 5-grams have a Jaccard similarity of at least 0.8.

Texts with equal sets are one class, found by a 128-bit digest of the set.  Classes are
compared through MinHash signatures of 128 values:

1. A band is ``rows`` values of the signature; classes that agree in a band share a
   bucket.  ``rows`` is the greatest of 4, 2, 1 with which a pair at the threshold
   shares no bucket with a chance of 1e-6 at most.
2. A bucket is dealt into blocks of bounded size, and each pair of blocks is a cell, so
   a bucket of any size is spread over many tasks.  In a cell the pairs are compared 16
   values at a time, in the first band that they share only.  From m equal values of n
   and a uniform prior, the posterior chance that the similarity reaches the threshold
   is P(Binomial(n + 1, threshold) <= m); under ``TOLERANCE`` a pair is dropped.
3. Members of a cell with a pair left get their shingle sets, and the cell verifies its
   pairs by the sizes of the intersections.

Pairs live inside a task only: a cell gives, per member, the number of links and one
edge to the least member it is connected with there.  Edges join to components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelframe.functions.checkpoints import materialize
from labelframe.llm.batches import bounded, tidy
from labelframe.llm.components import components
from labelframe.llm.words import Slice, in_row, mix, repeats, seeds, slices, split_words, windows

WIDTH = 5
THRESHOLD = 0.8
VALUES = 128
STEP = 16
TOLERANCE = 1e-6
BLOCK_MEMBERS = 1024
BLOCK_SHINGLES = 2_000_000
PAIRS_AT_ONCE = 40_000
CELL = ("band", "value", "i", "j")


def band_rows(threshold: float) -> int:
    """Values in a band, so that a pair at the threshold is missed with a chance of 1e-6 at most."""
    for rows in (4, 2, 1):
        if (1 - threshold**rows) ** (VALUES // rows) <= 1e-6:
            return rows
    raise ValueError(f"{VALUES} values are too few for a threshold of {threshold}")


def least_matches(threshold: float, tolerance: float = TOLERANCE) -> list[int]:
    """For n = STEP, 2 STEP, ... values: the fewest equal ones that keep a pair."""
    out = []
    for n in range(STEP, VALUES + 1, STEP):
        tail = 0.0
        for m in range(n + 1):
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                break
        out.append(m)
    return out


def shingles(part: Slice, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of a slice, by row; a shorter text is one shingle."""
    words = split_words(part)
    n = np.diff(words.per_row(part.rows))
    at, hashes = windows(words, width)
    rows = words.rows[at]
    short = [(rows, hashes)]
    for m in range(1, width):
        if (n == m).any():
            at, h = windows(words, m, seed=1 + m)
            mine = n[words.rows[at]] == m
            short.append((words.rows[at][mine], h[mine]))
    if len(short) > 1:
        rows, hashes = (np.concatenate(c) for c in zip(*short))
        order = np.argsort(rows, kind="stable")
        rows, hashes = rows[order], hashes[order]
    _, before = repeats(in_row(rows, hashes))
    return rows[~before], hashes[~before]


def signatures(rows: np.ndarray, hashes: np.ndarray, rows_in_band: int) -> np.ndarray:
    """Band values (row, band) of the rows that have shingles, in order."""
    starts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])) if len(rows) else np.zeros(0, np.int64)
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    factors = seeds(VALUES, 7)
    out = np.empty((len(starts), VALUES), np.uint16)
    if len(starts):
        for k in range(VALUES):
            least = np.minimum.reduceat(low * np.uint32(factors[k] >> np.uint64(32) | np.uint64(1)) + np.uint32(factors[k] & np.uint64(0xFFFFFFFF)), starts)
            out[:, k] = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
    kind = {4: np.int64, 2: np.uint32, 1: np.uint16}[rows_in_band]
    return out.view(kind).astype(np.int64)


def values_of(bands: np.ndarray, rows_in_band: int) -> np.ndarray:
    """The signature's values again, as 16-bit numbers."""
    kind = {4: np.int64, 2: np.uint32, 1: np.uint16}[rows_in_band]
    return np.ascontiguousarray(bands.astype(kind)).view(np.uint16)


def digests(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """16 bytes for the set of each of n rows, independent of order; zeros for an empty set."""
    out = np.zeros((n, 2), np.uint64)
    for i in (0, 1):
        np.add.at(out[:, i], rows, mix(hashes + np.uint64(0x632BE59BD9B4E019 * (i + 1) & 0xFFFFFFFFFFFFFFFF)))
    return out


def binary_rows(data: np.ndarray, ends: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    """Binary array of consecutive bytes up to each end."""
    offsets = np.append(0, ends).astype(np.int32)
    made = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
    if valid is None:
        return made
    return pa.compute.if_else(pa.array(valid), made, pa.scalar(None, pa.binary()))


def sketch(docs: DataFrame, width: int, rows_in_band: int) -> DataFrame:
    """(id, text_hash, own, n, bands) of every row; own and bands are null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(2)):
                rows, hashes = shingles(part, width)
                n = np.bincount(rows, minlength=part.rows)
                has = n > 0
                own = binary_rows(digests(rows, hashes, part.rows), 16 * np.arange(1, part.rows + 1), has)
                made = signatures(rows, hashes, rows_in_band)
                bands = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(has * made.shape[1])), pa.int32()), pa.array(made.ravel())
                )
                first = (batch.column(c).slice(part.first, part.rows) for c in (0, 1))
                yield pa.RecordBatch.from_arrays([*first, own, pa.array(n), bands], names=["id", "text_hash", "own", "n", "bands"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(tidy(run), f"id {kind}, text_hash long, own binary, n long, bands array<long>")


def whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole cells, and the row where each cell begins; rows come sorted by cell."""
    held: list[pa.RecordBatch] = []

    def begins(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[:1] = True
        for c in CELL:
            v = table.column(c).to_numpy()
            new[1:] |= v[1:] != v[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch])
        starts = begins(table)
        if len(starts) > 1:
            yield table.slice(0, starts[-1]).combine_chunks(), starts[:-1]
        held = table.slice(starts[-1]).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, begins(table)


def pairs_left(table: pa.Table, starts: np.ndarray, least: list[int], rows_in_band: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows that survive the pruning, each in the first band that it shares.

    They come in the order of their first row, from some ``PAIRS_AT_ONCE`` candidates at a time.
    """
    n = table.num_rows
    column = table.column("bands").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    bands = column.flatten().to_numpy().reshape(n, -1)
    values = values_of(bands, rows_in_band)
    band, side = table.column("band").to_numpy(), table.column("side").to_numpy()
    cross = table.column("i").to_numpy() != table.column("j").to_numpy()
    ends = np.append(starts[1:], n)
    cell = np.repeat(np.arange(len(starts)), ends - starts)
    second = starts + np.bincount(cell[side == 0], minlength=len(starts))  # side 1 comes after side 0
    lo = np.where(cross, second[cell], np.arange(n) + 1)
    hi = np.where(cross & (side == 1), lo, ends[cell])
    count = np.maximum(hi - lo, 0)
    total = np.cumsum(count)
    row = 0
    while row < n:
        base = total[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(total, base + PAIRS_AT_ONCE, "right")))
        c = count[row:stop]
        a = np.repeat(np.arange(row, stop), c)
        b = np.arange(len(a)) - np.repeat(np.cumsum(c) - c, c) + np.repeat(lo[row:stop], c)
        row = stop
        if not len(a):
            continue
        first = (bands[a] == bands[b]).argmax(axis=1) == band[a]
        a, b = a[first], b[first]
        matches = np.zeros(len(a), np.int64)
        for step, fewest in enumerate(least):
            cut = slice(step * STEP, (step + 1) * STEP)
            matches += (values[a, cut] == values[b, cut]).sum(axis=1)
            keep = matches >= fewest
            a, b, matches = a[keep], b[keep], matches[keep]
            if not len(a):
                break
        if len(a):
            yield a, b


class CellSets:
    """Shingle sets of the members of one cell, and the sizes of their intersections, exactly."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sets, self.sizes = sets, np.array([len(s) for s in sets])
        self.inter: np.ndarray | None = None

    def _one_by_one(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.array([len(np.intersect1d(self.sets[x], self.sets[y], assume_unique=True)) for x, y in zip(a, b)], np.int64)

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of the pairs (a, b): one by one for few, by products of 0-1 matrices, kept for the cell, for many."""
        if self.inter is not None:
            return self.inter[a, b].astype(np.int64)
        if len(a) < 64:
            return self._one_by_one(a, b)
        n = len(self.sets)
        _, code, count = np.unique(np.concatenate(self.sets), return_inverse=True, return_counts=True)
        member = np.repeat(np.arange(n), self.sizes)
        common = count[code] > 1  # a shingle of one member is in no intersection
        place = np.cumsum(count > 1) - 1
        code, member, width = place[code[common]], member[common], int((count > 1).sum())
        if n**2 * width / 5e9 > len(a) * 2e-5:
            return self._one_by_one(a, b)
        order = np.argsort(code, kind="stable")
        code, member = code[order], member[order]
        inter = np.zeros((n, n), np.float32)  # counts stay exact below 2^24
        for begin in range(0, width, 4096):
            lo, hi = np.searchsorted(code, [begin, begin + 4096])
            x = np.zeros((n, 4096), np.float32)
            x[member[lo:hi], code[lo:hi] - begin] = 1
            inter += x @ x.T
        self.inter = inter
        return inter[a, b].astype(np.int64)


def local_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of the component of each member, given those so far and more edges (a, b)."""
    a, b = np.concatenate([a, np.arange(len(root))]), np.concatenate([b, root])
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def in_cells(members: DataFrame) -> DataFrame:
    """Members of a cell together and in order, side 0 before side 1."""
    return members.repartition(*CELL).sortWithinPartitions(*CELL, "side", "own")


def classes_of(sketches: DataFrame) -> DataFrame:
    """One row per distinct set: (own, first_id, copies, n, bands, rep)."""
    return (
        sketches.where("own IS NOT NULL")
        .groupBy("own")
        .agg(
            F.min("id").alias("first_id"),
            F.count("*").alias("copies"),
            F.max("n").alias("n"),
            F.first("bands").alias("bands"),
            F.min(F.struct("id", "text_hash")).alias("rep"),
        )
    )


def cells_of(classes: DataFrame) -> DataFrame:
    """(band, value, i, j, side, own): the cells of every class that shares a bucket."""
    placed = classes.select("own", "n", F.posexplode("bands").alias("band", "value"))
    buckets = placed.groupBy("band", "value").agg(F.count("*").alias("size"), F.sum("n").alias("weight")).where("size > 1")
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK_MEMBERS), F.ceil(F.col("weight") / BLOCK_SHINGLES)).cast("int")
    members = placed.join(buckets, ["band", "value"]).withColumn("blocks", blocks)
    members = members.withColumn("block", F.pmod(F.xxhash64("own"), F.col("blocks")).cast("int"))
    other = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.select(
        "band",
        "value",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        (F.col("block") > F.col("other")).cast("int").alias("side"),
        "own",
    )


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: (id, text_hash, class_id, n_links).

    ``class_id`` is the least id of the texts connected by links; ``n_links`` counts the
    other rows with a similarity of at least the threshold, copies included.  A text of
    fewer words than ``width`` is one shingle of them all.  A null, empty or blank text
    has no shingles: its class is its own id, without links.  Repeated rows are copies
    of each other.  A null id takes part and gets the least id of its class, null if
    there is none.  ``text_hash`` is xxhash64 of the text.

    Sketches, classes and cells are written to the shared folder; a job survives the
    loss of executors.
    """
    rows_in_band, least = band_rows(threshold), least_matches(threshold)
    own = bounded(docs).select(F.col(id_column).alias("id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    sketches = materialize(sketch(own, width, rows_in_band))
    classes = materialize(classes_of(sketches))

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_cells(batches):
            used = np.zeros(table.num_rows, bool)
            for a, b in pairs_left(table, starts, least, rows_in_band):
                used[a] = used[b] = True
            yield from table.drop_columns(["bands"]).filter(pa.array(used)).to_batches()

    cell_schema = "band int, value long, i int, j int, side int, own binary"
    cells = cells_of(classes).join(classes.select("own", "bands"), "own").select(*CELL, "side", "own", "bands")
    cells = materialize(in_cells(cells).mapInArrow(tidy(prune), cell_schema))

    wanted = materialize(classes.join(cells.select("own").distinct(), "own", "left_semi").select("own", "copies", "bands", "rep"))
    same = own["id"].eqNullSafe(F.col("rep.id")) & (own["text_hash"] == F.col("rep.text_hash"))
    texts = own.join(wanted, same).select("own", "copies", "bands", "text")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(3)):
                rows, hashes = shingles(part, width)
                sets = binary_rows(hashes, 8 * np.cumsum(np.bincount(rows, minlength=part.rows)))
                first = (batch.column(c).slice(part.first, part.rows) for c in (0, 1, 2))
                yield pa.RecordBatch.from_arrays([*first, sets], names=["own", "copies", "bands", "shingles"])

    sets = texts.mapInArrow(tidy(gather), "own binary, copies long, bands array<long>, shingles binary").dropDuplicates(["own"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_cells(batches):
            copies, names = table.column("copies").to_numpy(), table.column("own")
            held = [np.frombuffer(s.as_py(), np.uint64) for s in table.column("shingles")]
            links, root = np.zeros(table.num_rows, np.int64), np.arange(table.num_rows)
            ends = np.append(starts[1:], table.num_rows)
            at, sets = -1, None
            for a, b in pairs_left(table, starts, least, rows_in_band):
                for cell, run in zip(*runs(np.searchsorted(starts, a, "right") - 1)):
                    lo, hi = starts[cell], ends[cell]
                    if cell != at:
                        at, sets = cell, CellSets(held[lo:hi])
                    x, y = a[run] - lo, b[run] - lo
                    both = sets.shared(x, y)
                    good = both >= threshold * (sets.sizes[x] + sets.sizes[y] - both) - 1e-9
                    x, y = x[good], y[good]
                    np.add.at(links, lo + x, copies[lo + y])
                    np.add.at(links, lo + y, copies[lo + x])
                    root[lo:hi] = lo + local_roots(root[lo:hi] - lo, x, y)
            used = pa.array(np.flatnonzero(links))
            yield from pa.table({"own": names.take(used), "links": pa.array(links).take(used), "root": names.take(pa.array(root).take(used))}).to_batches()

    linked = in_cells(cells.join(sets, "own")).mapInArrow(tidy(verify), "own binary, links long, root binary")
    linked = materialize(linked)
    roots = components(linked.select(F.col("own").alias("a"), F.col("root").alias("b")))
    least_id = roots.join(classes.select(F.col("own").alias("node"), "first_id"), "node").groupBy("root").agg(F.min("first_id").alias("class_first"))
    groups = roots.join(least_id, "root").select(F.col("node").alias("own"), "class_first")
    counts = linked.groupBy("own").agg(F.sum("links").alias("links"))
    known = classes.select("own", "first_id", "copies").join(counts, "own", "left").join(groups, "own", "left")
    # texts without words are in no class; beside the join, not in it, since they all have the same null key
    rows = sketches.select("id", "text_hash", "own")
    joined = rows.where("own IS NOT NULL").join(known, "own").select(
        F.col("id").alias(id_column),
        "text_hash",
        F.coalesce("class_first", "first_id").alias("class_id"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
    )
    wordless = rows.where("own IS NULL").select(F.col("id").alias(id_column), "text_hash", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return joined.unionByName(wordless)


def runs(ordered: np.ndarray) -> tuple[list[int], list[slice]]:
    """Values of an ordered array and the slice of each."""
    if not len(ordered):
        return [], []
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    ends = np.append(starts[1:], len(ordered))
    return ordered[starts].tolist(), [slice(s, e) for s, e in zip(starts.tolist(), ends.tolist())]


def keep_first(docs: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class with all its columns: that with the least id.

    Rows are matched by id and text hash; of rows that repeat both, one stays.  Rows
    without an id stay only if their class has no id at all.
    """
    found = jaccard_join(docs, threshold, width, id_column, text)
    own = found.where(F.col(id_column).eqNullSafe(F.col("class_id"))).select(F.col(id_column).alias("kept_id"), "text_hash")
    kept = materialize(own.groupBy("kept_id", F.col("text_hash").alias("kept_hash")).agg(F.count("*").alias("times")))
    same = docs[id_column].eqNullSafe(F.col("kept_id")) & (F.xxhash64(docs[text]) == F.col("kept_hash"))
    once = docs.join(kept.where("times = 1"), same, "left_semi")
    again = docs.join(kept.where("times > 1"), same).dropDuplicates(["kept_id", "kept_hash"])
    return once.unionAll(again.select(*(docs[c] for c in docs.columns)))
