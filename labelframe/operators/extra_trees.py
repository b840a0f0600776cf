"""Extremely randomized trees (Geurts et al., 2006), grown level by level.

No bootstrap; at a node ``max_features`` features that vary there are drawn, each
gets one uniform cut between its smallest and largest value, and the cut with the
best Gini gain is kept.

The node that a row has reached in each tree is an array column of a stored table.  A
level reads it twice, whatever the number of trees: one pass counts the classes on both
sides of all drawn cuts; the next moves the rows by the cuts chosen, which are all that is
broadcast, writes them with their new nodes, and gives the ranges of the features there.
Rows in leaves of all trees are left behind.  Partial ranges and counts are merged by
Spark, by node and feature.  Finished nodes go to a table; the driver holds one level and at
most ``NODES_PER_WRITE`` finished nodes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelframe.functions.checkpoints import discard, materialize, store
from labelframe.functions.classes import class_counts
from labelframe.functions.hashing import draw_hex, draw_unit
from labelframe.functions.reshape import vector

CELLS_PER_PASS = 8_000_000
NODES_PER_BROADCAST = 1_000_000
NODES_PER_WRITE = 200_000
PAIRS_AT_ONCE = 1 << 15
MAX_DEPTH = 61
MODEL_SCHEMA = "tree int, node int, feature int, threshold double, child int, counts array<double>"
STATE = "y int, vec array<double>, at array<int>"
RANGES = "node int, tree int, path long, feature int, lo double, hi double"


@dataclass
class Tree:
    """Nodes in the order they were made; ``child`` is the left child, the right one follows."""

    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    child: list[int] = field(default_factory=list)
    counts: list[list[float]] = field(default_factory=list)

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.array(self.feature), np.array(self.threshold), np.array(self.child)


def _route(x: np.ndarray, arrays: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """The leaf that each row reaches."""
    feature, threshold, child = arrays
    at = np.zeros(len(x), dtype=np.int64)
    moving = np.arange(len(x)) if child[0] >= 0 else np.arange(0)
    while len(moving):
        here = at[moving]
        right = x[moving, feature[here]] >= threshold[here]
        at[moving] = child[here] + right
        moving = moving[child[at[moving]] >= 0]
    return at


def _features(vectors: pa.Array | list, width: int | None = None) -> np.ndarray:
    """Vectors as a matrix; a missing entry is an error."""
    if isinstance(vectors, pa.Array):
        if vectors.null_count:
            raise ValueError("missing values in a feature vector")
        x = vectors.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(vectors), width)
    else:
        x = np.array(vectors, dtype=float)
    if np.isnan(x).any():
        raise ValueError("missing values in a feature vector")
    return x


class ExtraTrees:
    """A fitted forest: ``classes`` in order, and a table of nodes (see ``MODEL_SCHEMA``)."""

    def __init__(self, classes: list, nodes: DataFrame):
        self.classes, self.nodes = classes, nodes

    def predict(self, df: DataFrame, features: Sequence[str] | str, output: str = "prediction") -> DataFrame:
        """Add the class with the highest mean leaf share; the first class wins ties."""
        spark = df.sparkSession
        n_classes = len(self.classes)
        scored = df.withColumn("_vec", vector(features)).withColumn(
            "_share", F.array_repeat(F.lit(0.0), n_classes)
        )
        for trees in self._groups():
            scored = self._score(spark, scored, trees)
        place = F.array_position(F.col("_share"), F.array_max("_share")).cast("int")
        kinds = F.array(*[F.lit(c) for c in self.classes])
        return scored.withColumn(output, F.element_at(kinds, place)).drop("_vec", "_share")

    def _groups(self) -> Iterator[list[Tree]]:
        """Trees in groups whose nodes stay below the bound of one broadcast, fetched one group at a time."""
        sizes = sorted(self.nodes.groupBy("tree").count().collect())
        group, nodes = [], 0
        for tree, n in sizes:
            if group and nodes + n > NODES_PER_BROADCAST:
                yield self._fetch(group)
                group, nodes = [], 0
            group.append(tree)
            nodes += n
        yield self._fetch(group)

    def _fetch(self, group: list[int]) -> list[Tree]:
        some = self.nodes.where(F.col("tree").between(group[0], group[-1])).toArrow().sort_by([("tree", "ascending"), ("node", "ascending")])
        of, feature, threshold, child = (some.column(c).to_numpy() for c in ("tree", "feature", "threshold", "child"))
        counts = some.column("counts").to_pylist()
        cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
        return [Tree(feature[a:b].tolist(), threshold[a:b].tolist(), child[a:b].tolist(), counts[a:b]) for a, b in zip(cuts, cuts[1:])]

    @property
    def trees(self) -> list[Tree]:
        """All trees on the driver, for inspection."""
        return [tree for group in self._groups() for tree in group]

    def _score(self, spark: SparkSession, scored: DataFrame, trees: list[Tree]) -> DataFrame:
        packed = []
        for tree in trees:
            counts = np.array(tree.counts)
            packed.append((tree.arrays(), counts / counts.sum(axis=1, keepdims=True)))
        model = spark.sparkContext.broadcast(packed)

        @F.pandas_udf("array<double>")
        def add_share(vec: pd.Series, share: pd.Series) -> pd.Series:
            x = _features(vec.tolist())
            total = np.array(share.tolist(), dtype=float)
            for arrays, shares in model.value:
                total += shares[_route(x, arrays)]
            return pd.Series(list(total))

        return scored.withColumn("_share", add_share("_vec", "_share"))

    def table(self, spark: SparkSession) -> DataFrame:
        """The forest as rows, one per node."""
        return self.nodes

    @classmethod
    def from_table(cls, classes: list, table: DataFrame) -> ExtraTrees:
        return cls(classes, table)


@dataclass
class Level:
    """The nodes of one depth, in the order of tree and path."""

    tree: np.ndarray
    path: np.ndarray
    node: np.ndarray
    counts: np.ndarray  # (node, class)

    def __len__(self) -> int:
        return len(self.tree)

    def where(self, keep: np.ndarray) -> Level:
        return Level(self.tree[keep], self.path[keep], self.node[keep], self.counts[keep])


@dataclass
class Cuts:
    """The chosen cut of each open node of a level: -1 and no children where none was found."""

    feature: np.ndarray
    threshold: np.ndarray
    after: np.ndarray  # (node, side): the number among the open nodes of the next level, -1 for a leaf


def fit_extra_trees(
    df: DataFrame,
    label: str,
    features: Sequence[str] | str,
    n_trees: int = 100,
    max_depth: int = 10,
    max_features: int | None = None,
    min_samples_split: int = 2,
    seed: int = 42,
) -> ExtraTrees:
    """Grow ``n_trees`` trees to ``max_depth``; ``max_features`` defaults to the square root.

    Rows without a label are left out.  A node's path is a number with one bit for each
    level, hence ``MAX_DEPTH``.  A level of more than ``CELLS_PER_PASS`` ranges or counts
    is measured in several passes, which bounds the memory of a task.
    """
    if max_depth > MAX_DEPTH:
        raise ValueError(f"max_depth is at most {MAX_DEPTH}")
    counts = {c: n for c, n in class_counts(df, label).items() if c is not None}
    if not counts:
        raise ValueError(f"{label} has no classes")
    classes = list(counts)
    known = df.where(F.col(label).isNotNull())
    number = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)).cast("int") - 1
    rows = known.select(number.cast("int").alias("y"), vector(features).alias("vec"))
    width = rows.select(F.size("vec")).first()[0]
    grower = _Grower(rows.sparkSession, len(classes), width, max_features or max(1, int(width**0.5)), seed)
    start = np.tile([float(counts[c]) for c in classes], (n_trees, 1))
    level = Level(np.arange(n_trees), np.ones(n_trees, np.int64), np.zeros(n_trees, np.int64), start)
    made, size = _Nodes(rows.sparkSession), np.ones(n_trees, np.int64)
    is_open = _can_split(level.counts, 0, max_depth, min_samples_split)
    state, path = rows.withColumn("at", F.array(*[F.lit(t if is_open[t] else -1) for t in range(n_trees)])), None
    cuts = None
    for depth in range(max_depth + 1):
        opened = level.where(is_open)
        if not len(opened):
            made.add(_node_table(level, is_open, None, None))
            break
        state, before = grower.move(state, cuts, opened), path
        state, path = state
        if before:
            discard(rows.sparkSession, before)
        feature, threshold, sides = grower.split(state, opened)
        cut = feature >= 0
        child = np.full(len(opened), -1)
        # children of a tree are numbered on, in the order of their parents
        for t in np.unique(opened.tree[cut]):
            mine = np.flatnonzero(cut & (opened.tree == t))
            child[mine] = size[t] + 2 * np.arange(len(mine))
            size[t] += 2 * len(mine)
        made.add(_node_table(level, is_open, (feature, threshold), child))
        both = np.repeat(np.flatnonzero(cut), 2)
        side = np.tile([0, 1], int(cut.sum()))
        level = Level(opened.tree[both], 2 * opened.path[both] + side, child[both] + side, sides[both, side])
        is_open = _can_split(level.counts, depth + 1, max_depth, min_samples_split)
        after = np.full((len(opened), 2), -1)
        after[both, side] = np.where(is_open, np.cumsum(is_open) - 1, -1)
        cuts = Cuts(feature, threshold, after)
    if path:
        discard(rows.sparkSession, path)
    return ExtraTrees(classes, made.table())


def _can_split(counts: np.ndarray, depth: int, max_depth: int, min_samples: int) -> np.ndarray:
    return (depth < max_depth) & (counts.sum(axis=1) >= min_samples) & ((counts > 0).sum(axis=1) > 1)


def _node_table(level: Level, is_open: np.ndarray, cuts: tuple | None, child: np.ndarray | None) -> pa.Table:
    """The nodes of a level as rows of the model."""
    feature, threshold, first = np.full(len(level), -1), np.zeros(len(level)), np.full(len(level), -1)
    if cuts is not None:
        feature[is_open], first[is_open] = cuts[0], child
        threshold[is_open] = np.where(cuts[0] >= 0, cuts[1], 0.0)
    width = level.counts.shape[1]
    return pa.table(
        {
            "tree": pa.array(level.tree, pa.int32()),
            "node": pa.array(level.node, pa.int32()),
            "feature": pa.array(feature, pa.int32()),
            "threshold": pa.array(threshold),
            "child": pa.array(first, pa.int32()),
            "counts": pa.ListArray.from_arrays(np.arange(0, level.counts.size + 1, width).astype(np.int32), level.counts.ravel()),
        }
    )


class _Nodes:
    """Finished nodes, written some levels at a time."""

    def __init__(self, spark: SparkSession):
        self.spark, self.held, self.stored = spark, [], []

    def add(self, nodes: pa.Table) -> None:
        self.held.append(nodes)
        if sum(t.num_rows for t in self.held) >= NODES_PER_WRITE:
            self._write()

    def _write(self) -> None:
        if self.held:
            self.stored.append(materialize(self.spark.createDataFrame(pa.concat_tables(self.held), schema=MODEL_SCHEMA)))
            self.held = []

    def table(self) -> DataFrame:
        self._write()
        return reduce(DataFrame.unionAll, self.stored)


class _Grower:
    def __init__(self, spark: SparkSession, n_classes: int, width: int, max_features: int, seed: int):
        self.spark, self.n_classes = spark, n_classes
        self.width, self.max_features, self.seed = width, min(max_features, width), seed
        self.nodes_per_pass = max(1, CELLS_PER_PASS // max(2 * width, self.max_features * 2 * n_classes))

    def move(self, state: DataFrame, cuts: Cuts | None, opened: Level) -> tuple[DataFrame, str]:
        """Rows with their nodes of the next level, stored; beside them the partial ranges, if they fit one pass."""
        cut = self.spark.sparkContext.broadcast(cuts) if cuts else None
        ranges = self._ranges(opened, 0, len(opened)) if len(opened) <= self.nodes_per_pass else None
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = ranges() if ranges else None
            for batch in batches:
                x = _features(batch.column(1), width)
                at = batch.column(2).flatten().to_numpy().reshape(len(x), -1)
                if cut:
                    c = cut.value
                    here = np.maximum(at, 0)
                    right = np.take_along_axis(x, np.maximum(c.feature, 0)[here], axis=1) >= c.threshold[here]
                    at = np.where(at >= 0, c.after[here, right.astype(np.int64)], -1).astype(np.int32)
                stay = (at >= 0).any(axis=1)
                if found:
                    found.add(x, at)
                if stay.any():
                    batch = batch.filter(pa.array(stay))
                    at = pa.ListArray.from_arrays((np.arange(stay.sum() + 1) * at.shape[1]).astype(np.int32), at[stay].ravel())
                    empty = [pa.nulls(len(at), kind) for kind in (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.float64(), pa.float64())]
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.list_(pa.float64())), at, *empty], names=names)
            if found:
                for columns in found.rows():
                    n = len(columns[0])
                    empty = [pa.nulls(n, kind) for kind in (pa.int32(), pa.list_(pa.float64()), pa.list_(pa.int32()))]
                    yield pa.RecordBatch.from_arrays([*empty, *columns], names=names)

        names = [c.strip().split()[0] for c in f"{STATE}, {RANGES}".split(",")]
        rows = state.where("node IS NULL") if "node" in state.columns else state
        return store(rows.select("y", "vec", "at").mapInArrow(run, f"{STATE}, {RANGES}"))

    def split(self, state: DataFrame, opened: Level) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature and threshold of the best cut of each open node (-1 without one), and the counts of both sides."""
        n, k = len(opened), self.max_features
        feature, threshold, sides = np.full(n, -1), np.zeros(n), np.zeros((n, 2, self.n_classes))
        rows = state.where("node IS NULL")
        for lo in range(0, n, self.nodes_per_pass):
            hi = min(n, lo + self.nodes_per_pass)
            partial = state.where("node IS NOT NULL") if n <= self.nodes_per_pass else self.ranges(rows, opened, lo, hi)
            merged = partial.groupBy("node", "tree", "path", "feature").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
            drawn = candidate_cuts(merged, k, self.seed).toArrow()
            if not drawn.num_rows:
                continue
            node, slot = (drawn.column(c).to_numpy() for c in ("node", "slot"))
            features, thresholds = np.full((n, k), -1), np.full((n, k), np.nan)
            features[node, slot], thresholds[node, slot] = (drawn.column(c).to_numpy() for c in ("feature", "threshold"))
            best = best_cuts(self.counts(rows, features, thresholds, lo, hi), self.n_classes).toArrow()
            node, slot = (best.column(c).to_numpy() for c in ("node", "slot"))
            feature[node], threshold[node] = features[node, slot], thresholds[node, slot]
            for side, name in enumerate(("left", "right")):
                flat = best.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
                sides[node, side] = flat.reshape(len(node), self.n_classes)
        return feature, threshold, sides

    def _ranges(self, opened: Level, lo: int, hi: int):
        names = self.spark.sparkContext.broadcast((opened.tree, opened.path))
        width = self.width
        return lambda: Ranges(lo, hi, width, *names.value)

    def ranges(self, rows: DataFrame, opened: Level, lo: int, hi: int) -> DataFrame:
        """Partial ranges of the open nodes lo to hi."""
        make, width = self._ranges(opened, lo, hi), self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = make()
            for batch in batches:
                found.add(_features(batch.column(0), width), batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1))
            for columns in found.rows():
                yield pa.RecordBatch.from_arrays(columns, names=[c.strip().split()[0] for c in RANGES.split(",")])

        return rows.select("vec", "at").mapInArrow(run, RANGES)

    def counts(self, rows: DataFrame, features: np.ndarray, thresholds: np.ndarray, lo: int, hi: int) -> DataFrame:
        """Rows ``(node, slot, side, class, n)`` for every candidate cut of the open nodes lo to hi."""
        k, n_classes, width = self.max_features, self.n_classes, self.width
        shared = self.spark.sparkContext.broadcast((features[lo:hi], thresholds[lo:hi]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            feature, threshold = shared.value
            total = np.zeros(len(feature) * k * 2 * n_classes, dtype=np.int64)
            for batch in batches:
                x, y = _features(batch.column(1), width), batch.column(0).to_numpy()
                for row, node in open_pairs(batch.column(2).flatten().to_numpy().reshape(len(x), -1), lo, hi):
                    node = node - lo
                    right = x[row[:, None], np.maximum(feature[node], 0)] >= threshold[node]
                    cell = ((node[:, None] * k + np.arange(k)) * 2 + right) * n_classes + y[row][:, None]
                    found, n = np.unique(cell[feature[node] >= 0], return_counts=True)
                    total[found] += n
            cell = np.nonzero(total)[0]
            rest, cls = np.divmod(cell, n_classes)
            rest, side = np.divmod(rest, 2)
            node, slot = np.divmod(rest, k)
            for at in range(0, len(cell), 1 << 16):
                some = slice(at, at + (1 << 16))
                columns = [pa.array(c[some], pa.int32()) for c in (node + lo, slot, side, cls)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(total[cell[some]])], names=["node", "slot", "side", "class", "n"])

        merged = rows.select("y", "vec", "at").mapInArrow(run, "node int, slot int, side int, class int, n long")
        return merged.groupBy("node", "slot", "side", "class").agg(F.sum("n").alias("n"))


def open_pairs(at: np.ndarray, lo: int, hi: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, node) of the rows in the open nodes lo to hi of any tree, some at a time."""
    rows, places = np.nonzero((at >= lo) & (at < hi))
    for k in range(0, len(rows), PAIRS_AT_ONCE):
        row, place = rows[k : k + PAIRS_AT_ONCE], places[k : k + PAIRS_AT_ONCE]
        yield row, at[row, place].astype(np.int64)


class Ranges:
    """Smallest and largest value of each feature in the open nodes lo to hi."""

    def __init__(self, lo: int, hi: int, width: int, tree: np.ndarray, path: np.ndarray):
        self.first, self.last, self.tree, self.path = lo, hi, tree, path
        self.low, self.high = np.full((hi - lo, width), np.inf), np.full((hi - lo, width), -np.inf)

    def add(self, x: np.ndarray, at: np.ndarray) -> None:
        for row, node in open_pairs(at, self.first, self.last):
            order = node.argsort(kind="stable")
            found, starts = np.unique(node[order], return_index=True)
            found, values = found - self.first, x[row[order]]
            self.low[found] = np.minimum(self.low[found], np.minimum.reduceat(values, starts, axis=0))
            self.high[found] = np.maximum(self.high[found], np.maximum.reduceat(values, starts, axis=0))

    def rows(self) -> Iterator[list[pa.Array]]:
        """A row per node and feature met: at most one per partition, node and feature is sent on."""
        step = max(1, (1 << 16) // self.low.shape[1])
        for at in range(0, len(self.low), step):
            low, high = self.low[at : at + step], self.high[at : at + step]
            node, feature = np.nonzero(low <= high)
            name = node + at + self.first
            yield [
                pa.array(name, pa.int32()), pa.array(self.tree[name], pa.int32()), pa.array(self.path[name]),
                pa.array(feature, pa.int32()), pa.array(low[node, feature]), pa.array(high[node, feature]),
            ]


def candidate_cuts(ranges: DataFrame, max_features: int, seed: int) -> DataFrame:
    """Draw the features of each node among those that vary, and one cut for each."""
    key = [F.col("tree"), F.col("path"), F.col("feature")]
    order = Window.partitionBy("node").orderBy(draw_hex(seed, "feature", *key))
    cut = F.col("lo") + draw_unit(seed, "cut", *key) * (F.col("hi") - F.col("lo"))
    # a cut at the smallest value would leave the left side empty
    cut = F.when(cut > F.col("lo"), cut).otherwise(F.col("hi"))
    return (
        ranges.where(F.col("lo") < F.col("hi"))
        .withColumn("slot", F.row_number().over(order) - 1)
        .where(F.col("slot") < max_features)
        .select("node", "slot", "feature", cut.alias("threshold"))
    )


def best_cuts(counts: DataFrame, n_classes: int) -> DataFrame:
    """Per node the cut with the smallest Gini impurity, the first drawn on ties.

    For a node the impurity falls as the sum over both sides of sum(n_c^2) / n grows.
    """
    entries = F.map_from_entries(F.collect_list(F.struct("class", "n")))
    sides = counts.groupBy("node", "slot", "side").agg(
        F.sum("n").alias("total"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("squares"),
        entries.alias("per_class"),
    )
    every = F.array(*[F.lit(i) for i in range(n_classes)])
    full = F.transform(every, lambda c: F.coalesce(F.element_at("per_class", c), F.lit(0)))
    sides = sides.withColumn("full", full)
    cuts = sides.groupBy("node", "slot").agg(
        F.sum(F.col("squares") / F.col("total")).alias("score"),
        F.max(F.when(F.col("side") == 0, F.col("full"))).alias("left"),
        F.max(F.when(F.col("side") == 1, F.col("full"))).alias("right"),
    )
    best = F.max_by(F.struct("slot", "score", "left", "right"), F.struct("score", -F.col("slot")))
    both = cuts.where(F.col("left").isNotNull() & F.col("right").isNotNull())
    return both.groupBy("node").agg(best.alias("b")).select("node", "b.*")
