"""Benchmark items inside documents, by size-partitioned MinHash containment search.

An item is contained in a document if the document has at least ``THRESHOLD`` of the
item's distinct shingles of five words (an item of fewer words is one shingle of them).
Items are partitioned by size.  An item with n shingles keeps the n - ceil(t n) + 1
least hashes of them as its sketch: whatever share t a document holds, at least one of
these is among its own, so no contained item is missed, however long the document is.
(Banded signatures of whole documents cannot promise that: a 10-shingle item in a
20,000-word document has a Jaccard similarity of 0.0005.)  Within a size partition a
document looks up only hashes up to the greatest of the sketches; the candidates are
verified on the words themselves.

The items are the query set.  Equal texts are one; the ids of the items meet the hits in a
join.  The texts travel in blocks of at most ``BLOCK_BYTES`` by running sums of their
bytes, a longer text alone, and the documents are passed once per block.  With several
blocks the hits of each are stored before the next is fetched, so the driver holds one.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelframe.functions.checkpoints import materialize
from labelframe.llm.batches import bounded, tidy
from labelframe.llm.words import Slice, slices, split_words, windows

WIDTH = 5
THRESHOLD = 0.8
BLOCK_BYTES = 8 << 20
ROW_BYTES = 8  # what a text counts in a block besides its bytes
BUCKET_BLOCKS = 8


def shingles(words: list[bytes], width: int) -> set[tuple[bytes, ...]]:
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def words_of(part: Slice, words, row: int, offsets: np.ndarray) -> list[bytes]:
    lo, hi = offsets[row], offsets[row + 1]
    raw, base = part.data[part.offsets[row] : part.offsets[row + 1]].tobytes(), int(part.offsets[row])
    return [raw[b - base : e - base] for b, e in zip(words.begins[lo:hi].tolist(), words.ends[lo:hi].tolist())]


class Sketches:
    """Sketches of a block of items, by shingle width and size partition."""

    def __init__(self, texts: list[str | None], threshold: float, width: int) -> None:
        self.threshold, self.width = threshold, width
        self.sets: list[set] = []
        found: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        for part in slices(pa.array(texts, pa.string())):
            words = split_words(part)
            offsets = words.per_row(part.rows)
            by_width = {}
            for row in range(part.rows):
                own = words_of(part, words, row, offsets)
                w = min(width, len(own))
                self.sets.append(shingles(own, w) if w else set())
                if not w:
                    continue
                if w not in by_width:
                    by_width[w] = windows(words, w)
                at, h = by_width[w]
                least = np.unique(h[(at >= offsets[row]) & (at < offsets[row + 1])])
                keep = len(least) - math.ceil(threshold * len(least) - 1e-9) + 1
                item = part.first + row
                found[w, len(least).bit_length()] += [(int(x), item) for x in least[:keep]]
        self.parts = []
        for (w, _), pairs in sorted(found.items()):
            pairs.sort()
            self.parts.append((w, np.array([p[0] for p in pairs], np.uint64), np.array([p[1] for p in pairs], np.int64)))

    def search(self, part: Slice) -> Iterator[tuple[int, int, int, int]]:
        """(row, item, shared shingles, shingles of the item) of contained items."""
        words = split_words(part)
        offsets = words.per_row(part.rows)
        cut = {w: windows(words, w) for w in {p[0] for p in self.parts}}
        pairs = set()
        for w, hashes, items in self.parts:
            at, h = cut[w]
            low = h <= hashes[-1]
            h, row = h[low], words.rows[at[low]]
            lo, hi = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
            for i in np.flatnonzero(hi > lo):
                pairs.update((int(row[i]), int(k)) for k in items[lo[i] : hi[i]])
        last, own, cache = -1, [], {}
        for row, item in sorted(pairs):
            if row != last:
                last, own, cache = row, words_of(part, words, row, offsets), {}
            wanted = self.sets[item]
            w = len(next(iter(wanted)))
            if w not in cache:
                cache[w] = shingles(own, w)
            shared = len(wanted & cache[w])
            if shared >= self.threshold * len(wanted) - 1e-9:
                yield row, item, shared, len(wanted)


def keyed(items: DataFrame, id_column: str, text: str) -> DataFrame:
    """Items with a text: (item, key, text), the key telling texts apart."""
    own = items.select(F.col(id_column).alias("item"), F.col(text).alias("text")).where("text <> ''")
    return own.select("item", F.sha2("text", 256).alias("key"), "text")


def placed(items: DataFrame) -> DataFrame:
    """Distinct texts with their block: (key, text, large, bucket, block).

    A text of more than half a block is a block alone.  The others fall into a block by
    the half of the running sum at which they begin, so a block stays under one half and
    a last text of at most another.  The sums run in buckets of the key, of many blocks
    each, so that no task sorts all.
    """
    size = F.octet_length("text") + ROW_BYTES
    own = items.groupBy("key").agg(F.first("text").alias("text")).withColumn("size", F.octet_length("text") + ROW_BYTES)
    total = own.agg(F.sum("size")).first()[0] or 0
    buckets, half = max(1, math.ceil(total / (BUCKET_BLOCKS * BLOCK_BYTES))), BLOCK_BYTES // 2
    own = own.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    own = own.withColumn("large", F.when(F.col("size") > half, F.col("key")).otherwise(F.lit("")))
    before = Window.partitionBy("bucket", "large").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    own = own.withColumn("block", F.floor(F.coalesce(F.sum("size").over(before), F.lit(0)) / half))
    return own.select("key", "text", "large", "bucket", "block")


def blocks(items: DataFrame) -> Iterator[tuple[bool, pa.Array, list[str]]]:
    """Whether it is the only one, keys and texts of each block of bounded text, fetched on its own."""
    own = materialize(placed(items))
    of = ["large", "bucket", "block"]
    found = own.select(of).distinct().orderBy(of).collect()
    for where in found:
        some = own.where(" AND ".join(f"{n} = {where[n]!r}" for n in of)).select("key", "text").toArrow().combine_chunks()
        yield len(found) == 1, pa.concat_arrays(some.column("key").chunks), some.column("text").to_pylist()


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    width: int = WIDTH,
    id_column: str = "doc_id",
    text: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document row and contained item: (id, item, n_shared, n_shingles, containment).

    Null and empty texts contain nothing, and a null or empty item is in nothing.
    Repeated rows give their rows each; null ids stay.  Words are compared as they are.
    """
    key, item_key = docs.schema[id_column].dataType, items.schema[item_column].dataType
    own, found = keyed(items, item_column, item_text), None
    for only, keys, texts in blocks(own):
        sketches = Sketches(texts, threshold, width)

        def run(batches: Iterator[pa.RecordBatch], sketches=sketches, keys=keys) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hits = [(part.first + r, *rest) for part in slices(batch.column(1)) for r, *rest in sketches.search(part)]
                row, item, shared, size = (pa.array(c, pa.int64()) for c in (zip(*hits) if hits else [[]] * 4))
                share = pa.array(np.asarray(shared, float) / np.maximum(size, 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(row), keys.take(item), shared, size, share],
                    names=["id", "key", "n_shared", "n_shingles", "containment"],
                )

        some = bounded(docs).select(id_column, text).mapInArrow(tidy(run), f"id {key.simpleString()}, key string, n_shared long, n_shingles long, containment double")
        some = some if only else materialize(some)
        found = some if found is None else found.unionAll(some)
        del run, sketches, keys, texts
    if found is None:
        schema = f"id {key.simpleString()}, item {item_key.simpleString()}, n_shared long, n_shingles long, containment double"
        found = docs.sparkSession.createDataFrame([], schema)
    else:
        found = found.join(own.select("item", "key"), "key").select("id", "item", "n_shared", "n_shingles", "containment")
    return found.withColumnsRenamed({"id": id_column, "item": item_column})


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    width: int = WIDTH,
    text: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The documents that contain no item, with all their columns; see ``contained_items``."""
    place, hits = docs.columns.index(text), None
    for only, _, texts in blocks(keyed(items, item_column, item_text)):
        sketches = Sketches(texts, threshold, width)

        def run(batches: Iterator[pa.RecordBatch], sketches=sketches) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for part in slices(batch.column(place)):
                    keep[[part.first + hit[0] for hit in sketches.search(part)]] = False
                yield batch.filter(pa.array(keep))

        def mark(batches: Iterator[pa.RecordBatch], sketches=sketches) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = {part.first + hit[0] for part in slices(batch.column(1)) for hit in sketches.search(part)}
                yield batch.select([0]).take(pa.array(sorted(rows), pa.int64()))

        if only:
            return bounded(docs).mapInArrow(tidy(run), docs.schema)
        own = bounded(docs).select(F.sha2(text, 256).alias("key"), F.col(text).alias("text"))
        some = materialize(own.mapInArrow(tidy(mark), "key string").distinct())
        hits = some if hits is None else hits.unionAll(some)
        del run, mark, sketches, texts
    return docs if hits is None else docs.join(hits, F.sha2(docs[text], 256) == hits["key"], "left_anti")
