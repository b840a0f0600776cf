"""Packing of whole documents into as few sequences as possible, best two fit.

A document is its token ids and one closing id; only one longer than a window is cut,
into full windows and a rest.  A sequence is filled greedily: the longest unpacked piece
that still fits, again and again.  Then the shortest of its pieces is replaced by the two
unpacked pieces whose sum fits the gap so expanded most tightly, if that leaves less
room; this is repeated while the room shrinks.  As in Friesen and Langston (1991), pieces
of a sixth of the window or less come after all others, longest first, each where it
leaves least room.

Texts are read once, in tasks that keep only the lengths of their pieces.  A task packs
groups of a bounded number of pieces.  Sequences that a group could not fill well give
their pieces to a second round, in which pieces of many tasks meet in groups of the same
bound; that round moves rows of a few numbers, no text and no ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelframe.functions.checkpoints import materialize
from labelframe.llm.batches import bounded, tidy
from labelframe.llm.packing import CapacityTree, WordIds, encoder, token_ids
from labelframe.llm.words import large_state, process_state, slices

WINDOW = 4096
CLOSING_ID = 1
GROUP_PIECES = 200_000
FULL = 0.995
SHORT = 6
SECOND_ROUND = 1 << 62
COLUMNS = ("start", "length", "ids_crc32", "sequence_id", "offset")


class Lengths:
    """Unpacked pieces, 1 to ``window`` long, by their length.

    The lengths that are left are the bits of a number, and once more in reverse order,
    so that the longest piece below a bound and a pair with a given sum are found by a
    few operations on whole words.
    """

    def __init__(self, lengths: np.ndarray, window: int) -> None:
        self.window = window
        self.left = np.bincount(lengths, minlength=window + 1).tolist()
        self.bits = sum(1 << n for n, k in enumerate(self.left) if k)
        self.mirrored = sum(1 << (window - n) for n, k in enumerate(self.left) if k)

    def take(self, n: int, k: int = 1) -> None:
        self.left[n] -= k
        if not self.left[n]:
            self.bits ^= 1 << n
            self.mirrored ^= 1 << (self.window - n)

    def put(self, n: int) -> None:
        if not self.left[n]:
            self.bits ^= 1 << n
            self.mirrored ^= 1 << (self.window - n)
        self.left[n] += 1

    def longest(self, most: int) -> int:
        """The greatest length left that is at most ``most``; 0 without one."""
        return (self.bits & ((2 << most) - 1)).bit_length() - 1 if self.bits & ((2 << most) - 1) else 0

    def pair(self, more: int, most: int) -> tuple[int, int] | None:
        """Two lengths left with the greatest sum in (more, most]; of equal sums, that with the longest piece."""
        for total in range(min(most, 2 * self.window), more, -1):
            # bit n of the shifted mirror stands for the partner total - n
            shift = self.window - total
            partners = self.mirrored >> shift if shift >= 0 else self.mirrored << -shift
            found = self.bits & partners
            if not total & 1 and found >> (total // 2) & 1 and self.left[total // 2] < 2:
                found ^= 1 << (total // 2)
            if found:
                x = found.bit_length() - 1
                return x, total - x
        return None


def two_fit(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of each piece (1 <= length <= window), and the number of sequences."""
    short = window // SHORT
    free = Lengths(lengths[lengths > short], window)
    contents: list[list[int]] = []
    rooms, remaining = [], int((lengths > short).sum())
    while remaining:
        own, room = [], window
        while True:
            while room and (n := free.longest(room)):
                free.take(n)
                own.append(n)
                room -= n
            pair = free.pair(own[-1], own[-1] + room) if room and len(own) > 1 else None
            if pair is None:
                break
            small = own.pop()
            free.put(small)
            for n in pair:
                free.take(n)
                own.append(n)
            room -= sum(pair) - small
            own.sort(reverse=True)
        contents.append(own)
        rooms.append(room)
        remaining -= len(own)
    tree = CapacityTree(window)
    for place, room in enumerate(rooms):
        if room:
            tree.put(room, place)
    for n in np.sort(lengths[lengths <= short])[::-1].tolist():
        room, place = tree.take(n) or (window, len(contents))
        if place == len(contents):
            contents.append([])
        contents[place].append(n)
        if room > n:
            tree.put(room - n, place)
    sizes = [len(own) for own in contents]
    sequence = np.repeat(np.arange(len(contents)), sizes)
    placed = np.array([n for own in contents for n in own], np.int64)
    before = np.cumsum(placed) - placed
    offset = before - np.repeat(before[np.cumsum([0, *sizes[:-1]])], sizes) if sizes else before
    # the places of a length go to the pieces of that length in their order
    to, of = np.argsort(lengths, kind="stable"), np.argsort(placed, kind="stable")
    out = np.empty((2, len(lengths)), np.int64)
    out[0, to], out[1, to] = sequence[of], offset[of]
    return out[0], out[1], len(contents)


def pack_whole(
    docs: DataFrame,
    tokenizer: str,
    window: int = WINDOW,
    closing: int = CLOSING_ID,
    special_as_text: bool = False,
    group_pieces: int = GROUP_PIECES,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of all documents and their places: (id, piece, start, length, ids_crc32, sequence_id, offset).

    ``tokenizer`` is the JSON of a fast tokenizer whose pieces do not cross white space;
    special words in a text give their special ids unless ``special_as_text``.  A document
    of up to ``window`` ids is one piece; ``piece`` counts from 0, ``start`` counts the
    document's ids before the piece, ``offset`` those before it in its sequence, without
    gaps.  ``ids_crc32`` is the unsigned CRC-32 of the ids as little-endian 32-bit
    integers.  A null or empty text is its closing id alone.  Repeated rows and null ids
    are packed each; other columns are not read; an empty table gives no rows.  Sequence
    ids are unique, not consecutive.

    A group holds ``group_pieces`` pieces, some 40 bytes each.  Pieces of sequences under
    ``FULL`` of the window are dealt out anew once, evenly, by their place in the first round.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)
    name = f"two_fit_{zlib.crc32(tokenizer.encode())}_{special_as_text}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = process_state(f"{name}_encode", lambda: encoder(shared.value, special_as_text))
        state = large_state(name, WordIds)
        first_id = TaskContext.get().partitionId() << 40
        keys, pieces, held = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal first_id, held
            number, start, length, crc = (np.concatenate(c) for c in zip(*pieces))
            sequence, offset, n = two_fit(length, window)
            again = np.bincount(sequence, length, n)[sequence] < FULL * window
            columns = [pa.concat_arrays(keys), pa.array(number.astype(np.int32)), *map(pa.array, (start, length, crc, sequence + first_id, offset, again))]
            first_id, held = first_id + n, 0
            keys.clear(), pieces.clear()
            return pa.RecordBatch.from_arrays(columns, names=[id_column, "piece", *COLUMNS, "again"])

        for batch in batches:
            for part in slices(batch.column(1)):
                ids, ends = token_ids(part, state, encode, closing)
                total = np.diff(ends)
                cuts = -(-total // window)
                row = np.repeat(np.arange(part.rows), cuts)
                number = np.arange(len(row)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
                start = number * window
                length = np.minimum(total[row] - start, window)
                at, raw = (ends[row] + start).tolist(), memoryview(ids.tobytes())
                crc = np.array([zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at, length.tolist())], np.int64)
                keys.append(batch.column(0).slice(part.first, part.rows).take(pa.array(row)))
                pieces.append((number, start, length, crc))
                held += len(row)
                if held >= group_pieces:
                    yield flush()
        if pieces:
            yield flush()

    def repack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole groups, which come one after the other; a group is packed once all of it is there."""
        held: list[pa.RecordBatch] = []

        def packed() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            sequence, offset, _ = two_fit(table.column("length").to_numpy(), window)
            group = SECOND_ROUND + (table.column("cell")[0].as_py() << 24)
            out = {c: table.column(c) for c in (id_column, "piece", *COLUMNS)}
            out |= {"sequence_id": pa.array(sequence + group), "offset": pa.array(offset)}
            return pa.RecordBatch.from_pydict(out)

        for batch in batches:
            cells = batch.column("cell").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)]
            for lo, hi in zip(cuts, cuts[1:]):
                if held and hi > lo and held[0].column("cell")[0].as_py() != cells[lo]:
                    yield packed()
                    held.clear()
                if hi > lo:
                    held.append(batch.slice(lo, hi - lo))
        if held:
            yield packed()

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, piece int, " + ", ".join(f"{c} long" for c in COLUMNS)
    first = materialize(bounded(docs).select(id_column, text).mapInArrow(tidy(run, name), f"{schema}, again boolean"))
    poor = first.where("again").drop("again")
    groups = max(1, -(-poor.count() // group_pieces))
    cell = F.pmod(F.xxhash64("sequence_id", "offset"), F.lit(groups)).alias("cell")
    dealt = poor.select("*", cell).repartition(groups, "cell").sortWithinPartitions("cell", "sequence_id", "offset")
    return first.where("NOT again").drop("again").unionAll(dealt.mapInArrow(tidy(repack, name), schema))
