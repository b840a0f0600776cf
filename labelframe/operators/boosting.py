"""Gradient-boosted trees for several classes: softmax gradients, one tree per class and round.

A row's state is its class, the bins of its features and a margin per class, in a stored
table.  From the margins come the gradient p - [y = c] and the Hessian 2 p (1 - p) of each
class.  A level of a round is one pass, in which the trees of all classes share a histogram
of gradient sums by (class and node, feature, bin); Spark merges it, takes running sums over
the bins and picks the cut with the greatest gain

    1/2 (GL^2 / (HL + l2) + GR^2 / (HR + l2) - G^2 / (H + l2)).

The last pass of a round adds the leaves to the margins, writes the rows anew and gives the
first histogram of the next round.  So a round of depth d costs d passes, whatever the
number of classes.  Gradients are rounded to a grid on which all sums are whole numbers, so
beyond the cut values, which come from a sketch, the model does not depend on the partitions
or their order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelframe.functions.checkpoints import discard, materialize, store
from labelframe.functions.classes import class_counts
from labelframe.functions.reshape import vector
from labelframe.functions.small import local_table
from labelframe.operators.extra_trees import NODES_PER_BROADCAST, _features, _route

CELLS_PER_PASS = 8_000_000
ROWS_AT_ONCE = 4096
FEATURES_AT_ONCE = 100
SKETCH = 10_000
MAX_DEPTH = 30
GRID_BITS = 38  # a gradient is a multiple of 2^-38 or, for more than 2^24 rows, of fewer bits
MODEL_SCHEMA = "round int, class int, node int, feature int, threshold double, child int, value double"
STATE = "y int, bins binary, margin array<double>"
CELLS = "cell long, g long, h long"


@dataclass
class Tree:
    """Nodes in the order they were made; ``bin`` is the first bin of the right side, ``child`` the left child."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    child: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])

    def cut(self, node: int, feature: int, first: int, values: Sequence[float]) -> int:
        """Cut a node; returns its left child."""
        left = len(self.feature)
        self.feature[node], self.bin[node], self.child[node] = feature, first, left
        for v in values:
            self.feature.append(-1)
            self.bin.append(0)
            self.child.append(-1)
            self.value.append(v)
        return left

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.array(self.feature), np.array(self.bin), np.array(self.child)


def softmax(margin: np.ndarray) -> np.ndarray:
    e = np.exp(margin - margin.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def gradients(y: np.ndarray, margin: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian by row and class, as whole numbers of the grid."""
    p = softmax(margin)
    g = p.copy()
    g[np.arange(len(y)), y] -= 1.0
    return np.rint(g * scale), np.rint(2 * p * (1 - p) * scale)


def _adder(spark: SparkSession, trees: list[tuple]) -> Callable:
    """A function that adds the leaves of some trees to the margins of vectors."""
    model = spark.sparkContext.broadcast(trees)

    @F.pandas_udf("array<double>")
    def add(vec: pd.Series, margin: pd.Series) -> pd.Series:
        x = _features(vec.tolist())
        total = np.array(margin.tolist(), dtype=float)
        for c, arrays, values in model.value:
            total[:, c] += values[_route(x, arrays)]
        return pd.Series(list(total))

    return add


class Boosted:
    """A fitted model: ``classes`` in order, and a table of nodes (see ``MODEL_SCHEMA``)."""

    def __init__(self, classes: list, nodes: DataFrame):
        self.classes, self.nodes = classes, nodes

    def margins(self, df: DataFrame, features: Sequence[str] | str, output: str = "margin") -> DataFrame:
        """Add the array of the classes' margins."""
        scored = df.withColumn("_vec", vector(features)).withColumn(output, F.array_repeat(F.lit(0.0), len(self.classes)))
        for trees in self._groups():
            scored = scored.withColumn(output, _adder(df.sparkSession, trees)("_vec", output))
        return scored.drop("_vec")

    def predict(self, df: DataFrame, features: Sequence[str] | str, output: str = "prediction") -> DataFrame:
        """Add the class with the greatest margin; the first class wins ties."""
        scored = self.margins(df.drop(output), features, "_margin")
        place = F.array_position(F.col("_margin"), F.array_max("_margin")).cast("int")
        return scored.withColumn(output, F.element_at(F.array(*[F.lit(c) for c in self.classes]), place)).drop("_margin")

    def _groups(self) -> Iterator[list[tuple]]:
        """(class, arrays, values) of the trees, in groups below the bound of one broadcast, fetched one at a time."""
        sizes = self.nodes.groupBy("round").count().orderBy("round").collect()
        group, nodes = [], 0
        for r, n in sizes:
            if group and nodes + n > NODES_PER_BROADCAST:
                yield self._fetch(group)
                group, nodes = [], 0
            group.append(r)
            nodes += n
        if group:
            yield self._fetch(group)

    def _fetch(self, group: list[int]) -> list[tuple]:
        some = self.nodes.where(F.col("round").between(group[0], group[-1])).toArrow()
        some = some.sort_by([(c, "ascending") for c in ("round", "class", "node")])
        columns = {c: some.column(c).to_numpy() for c in some.column_names}
        starts = np.flatnonzero(columns["node"] == 0).tolist()
        out = []
        for a, b in zip(starts, [*starts[1:], some.num_rows]):
            arrays = tuple(columns[c][a:b] for c in ("feature", "threshold", "child"))
            out.append((int(columns["class"][a]), arrays, columns["value"][a:b]))
        return out


def fit_boosting(
    df: DataFrame,
    label: str,
    features: Sequence[str] | str,
    rounds: int = 100,
    max_depth: int = 6,
    eta: float = 0.3,
    l2: float = 1.0,
    min_child_weight: float = 1.0,
    min_gain: float = 0.0,
    max_bins: int = 64,
) -> Boosted:
    """Grow ``rounds`` trees for each class.

    A feature is cut at the distinct values among its ``max_bins`` - 1 quantiles, whose ranks
    are off by a 10,000th at most; they are exact for fewer rows than that.  A cut leaves ``min_child_weight`` of Hessian on both sides and gains more than ``min_gain``;
    of equal gains the first feature's least cut is taken.  Rows without a label are left
    out; a missing feature value is an error.  A level of more than ``CELLS_PER_PASS``
    histogram cells takes several passes, which bounds the memory of a task.
    """
    if not 1 <= max_depth <= MAX_DEPTH or not 2 <= max_bins <= 256:
        raise ValueError(f"max_depth is 1 to {MAX_DEPTH}, max_bins 2 to 256")
    counts = {c: n for c, n in class_counts(df, label).items() if c is not None}
    if not counts:
        raise ValueError(f"{label} has no classes")
    classes, n = list(counts), sum(counts.values())
    number = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)).cast("int") - 1
    rows = df.where(F.col(label).isNotNull()).select(number.cast("int").alias("y"), vector(features).alias("vec"))
    width = rows.select(F.size("vec")).first()[0]
    grower = _Booster(rows.sparkSession, len(classes), feature_cuts(rows, width, max_bins), 2.0 ** min(GRID_BITS, 62 - max(1, n).bit_length()))
    grower.eta, grower.l2, grower.min_child_weight, grower.min_gain = eta, l2, min_child_weight, min_gain
    state, path = grower.binned(rows)
    made, kept = [], []
    for r in range(rounds):
        trees = grower.round(state, max_depth)
        kept += grower.rows_of(r, trees)
        if len(kept) >= NODES_PER_BROADCAST or r == rounds - 1:
            made.append(grower.table(kept))
            kept = []
        if r < rounds - 1:
            (state, after), before = grower.step(state, trees), path
            discard(rows.sparkSession, before)
            path = after
    discard(rows.sparkSession, path)
    nodes = made[0]
    for more in made[1:]:
        nodes = nodes.unionAll(more)
    return Boosted(classes, nodes)


def feature_cuts(rows: DataFrame, width: int, max_bins: int) -> list[np.ndarray]:
    """Increasing cut values of each feature; a value at or above a cut lies to its right."""
    probs = F.array(*[F.lit(k / max_bins) for k in range(1, max_bins)])
    cuts: list[np.ndarray] = []
    for lo in range(0, width, FEATURES_AT_ONCE):
        some = [F.percentile_approx(F.col("vec")[i], probs, F.lit(SKETCH)).alias(f"f{i}") for i in range(lo, min(width, lo + FEATURES_AT_ONCE))]
        cuts += [np.unique(np.array(q or [], dtype=float)) for q in rows.agg(*some).first()]
    return cuts


class _Booster:
    def __init__(self, spark: SparkSession, n_classes: int, cuts: list[np.ndarray], scale: float):
        self.spark, self.n_classes, self.cuts, self.scale = spark, n_classes, cuts, scale
        self.width, self.bins = len(cuts), max((len(c) for c in cuts), default=0) + 1
        self.per_pass = max(1, CELLS_PER_PASS // (self.width * self.bins))

    def _open_roots(self) -> list[tuple[int, int]]:
        return [(c, 0) for c in range(self.n_classes)]

    def binned(self, rows: DataFrame) -> tuple[DataFrame, str]:
        """The rows with bins and zero margins, and the histogram of the roots, stored."""
        cuts, k, width = self.cuts, self.n_classes, self.width
        histogram = self._histogram(self._open_roots(), None, 0, k) if k <= self.per_pass else None

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells = histogram() if histogram else None
            for batch in batches:
                x = _features(batch.column(1), width)
                bins = np.column_stack([np.searchsorted(c, x[:, f], "right") for f, c in enumerate(cuts)]).astype(np.uint8)
                yield from _state_rows(batch.column(0), bins, np.zeros((len(x), k)), cells)
            yield from _cell_rows(cells)

        return store(rows.mapInArrow(run, f"{STATE}, {CELLS}"))

    def step(self, state: DataFrame, trees: list[Tree]) -> tuple[DataFrame, str]:
        """The rows with the trees' leaves added to the margins, and the histogram of the next roots, stored."""
        k, width = self.n_classes, self.width
        model = self.spark.sparkContext.broadcast([(t.arrays(), np.array(t.value)) for t in trees])
        histogram = self._histogram(self._open_roots(), None, 0, k) if k <= self.per_pass else None

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells = histogram() if histogram else None
            for batch in batches:
                bins, margin = _state_arrays(batch, width, k)
                margin = margin + np.column_stack([values[_route(bins, arrays)] for arrays, values in model.value])
                yield from _state_rows(batch.column(0), bins, margin, cells)
            yield from _cell_rows(cells)

        return store(state.where("cell IS NULL").select("y", "bins", "margin").mapInArrow(run, f"{STATE}, {CELLS}"))

    def round(self, state: DataFrame, max_depth: int) -> list[Tree]:
        """The trees of all classes, level by level."""
        trees, open_ = [Tree() for _ in range(self.n_classes)], self._open_roots()
        for depth in range(max_depth):
            found: list[tuple] = []
            for lo in range(0, len(open_), self.per_pass):
                hi = min(len(open_), lo + self.per_pass)
                stored = depth == 0 and len(open_) <= self.per_pass
                partial = state.where("cell IS NOT NULL").select("cell", "g", "h") if stored else self.histogram(state, open_, trees, lo, hi)
                found += self.best(partial).collect()
            following = []
            for r in sorted(found):
                c, node = open_[r["node"]]
                if not depth:
                    trees[c].value[0] = self.leaf(r["g"], r["h"])
                if r["gain"] is None:
                    continue
                values = [self.leaf(r["gl"], r["hl"]), self.leaf(r["g"] - r["gl"], r["h"] - r["hl"])]
                left = trees[c].cut(node, r["feature"], r["bin"] + 1, values)
                following += [(c, left), (c, left + 1)]
            open_ = following
            if not open_:
                break
        return trees

    def leaf(self, g: int, h: int) -> float:
        return -self.eta * (g / self.scale) / (h / self.scale + self.l2)

    def _histogram(self, open_: list[tuple[int, int]], trees: list[Tree] | None, lo: int, hi: int):
        slots: dict[int, dict[int, int]] = {}
        for i in range(lo, hi):
            c, node = open_[i]
            slots.setdefault(c, {})[node] = i - lo
        arrays = {c: trees[c].arrays() for c in slots} if trees else {}
        shared = self.spark.sparkContext.broadcast((slots, arrays, lo))
        width, bins, scale, n = self.width, self.bins, self.scale, hi - lo
        return lambda: Histogram(*shared.value, n, width, bins, scale)

    def histogram(self, state: DataFrame, open_: list[tuple[int, int]], trees: list[Tree], lo: int, hi: int) -> DataFrame:
        """Partial sums (cell, g, h) of the open nodes lo to hi."""
        make, width, k = self._histogram(open_, trees, lo, hi), self.width, self.n_classes

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cells = make()
            for batch in batches:
                cells.add(batch.column(0).to_numpy(), *_state_arrays(batch, width, k))
            for columns in cells.rows():
                yield pa.RecordBatch.from_arrays(columns, names=["cell", "g", "h"])

        return state.where("cell IS NULL").select("y", "bins", "margin").mapInArrow(run, CELLS)

    def best(self, partial: DataFrame) -> DataFrame:
        """Per open node its sums and the best cut; gain, feature and bin are null where none is allowed."""
        of = self.width * self.bins
        cells = partial.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).selectExpr(
            f"CAST(cell DIV {of} AS int) AS node", f"CAST(cell % {of} DIV {self.bins} AS int) AS feature", f"CAST(cell % {self.bins} AS int) AS bin", "g", "h"
        )
        line = Window.partitionBy("node", "feature")
        upto = line.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        sums = cells.select(
            "node", "feature", "bin", F.sum("g").over(upto).alias("gl"), F.sum("h").over(upto).alias("hl"),
            F.sum("g").over(line).alias("g"), F.sum("h").over(line).alias("h"),
        )
        part = lambda g, h: f"pow(({g}) / {self.scale!r}D, 2) / (({h}) / {self.scale!r}D + {self.l2!r}D)"
        gain = F.expr(f"0.5D * ({part('gl', 'hl')} + {part('g - gl', 'h - hl')} - {part('g', 'h')})")
        enough = F.expr(f"hl >= {self.min_child_weight * self.scale!r}D AND h - hl >= {self.min_child_weight * self.scale!r}D AND h > hl")
        scored = sums.withColumn("gain", F.when(enough & (gain > self.min_gain), gain))
        first = F.when(F.col("gain").isNotNull(), F.struct("gain", -F.col("feature"), -F.col("bin")))
        chosen = F.max_by(F.struct("gain", "feature", "bin", "gl", "hl"), first).alias("b")
        return scored.groupBy("node").agg(F.first("g").alias("g"), F.first("h").alias("h"), chosen).select("node", "g", "h", "b.gain", "b.feature", "b.bin", "b.gl", "b.hl")

    def rows_of(self, r: int, trees: list[Tree]) -> list[tuple]:
        out = []
        for c, t in enumerate(trees):
            for i, (f, b, child, value) in enumerate(zip(t.feature, t.bin, t.child, t.value)):
                out.append((r, c, i, f, float(self.cuts[f][b - 1]) if f >= 0 else 0.0, child, value))
        return out

    def table(self, rows: list[tuple]) -> DataFrame:
        return materialize(local_table(self.spark, rows, MODEL_SCHEMA))


def _state_arrays(batch: pa.RecordBatch, width: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    raw = batch.column(1)
    places = np.frombuffer(raw.buffers()[1], np.int32)
    begin = int(places[raw.offset])
    bins = np.frombuffer(raw.buffers()[2], np.uint8)[begin : begin + len(raw) * width].reshape(len(raw), width)
    return bins, batch.column(2).flatten().to_numpy().reshape(batch.num_rows, k)


def _state_rows(y: pa.Array, bins: np.ndarray, margin: np.ndarray, cells: Histogram | None) -> Iterator[pa.RecordBatch]:
    if not len(bins):
        return
    if cells:
        cells.add(y.to_numpy(), bins, margin)
    k = margin.shape[1]
    margins = pa.ListArray.from_arrays((np.arange(len(margin) + 1) * k).astype(np.int32), margin.ravel())
    places = (np.arange(len(bins) + 1) * bins.shape[1]).astype(np.int32)
    raw = pa.Array.from_buffers(pa.binary(), len(bins), [None, pa.py_buffer(places.tobytes()), pa.py_buffer(bins.tobytes())])
    empty = [pa.nulls(len(bins), pa.int64())] * 3
    yield pa.RecordBatch.from_arrays([y, raw, margins, *empty], names=["y", "bins", "margin", "cell", "g", "h"])


def _cell_rows(cells: Histogram | None) -> Iterator[pa.RecordBatch]:
    for columns in cells.rows() if cells else ():
        n = len(columns[0])
        empty = [pa.nulls(n, kind) for kind in (pa.int32(), pa.binary(), pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays([*empty, *columns], names=["y", "bins", "margin", "cell", "g", "h"])


class Histogram:
    """Sums of gradients and Hessians by (open node, feature, bin) of the rows of a task, in whole numbers."""

    def __init__(self, slots: dict, arrays: dict, first: int, n: int, width: int, bins: int, scale: float):
        self.slots, self.arrays, self.first = slots, arrays, first
        self.width, self.bins, self.scale = width, bins, scale
        self.g, self.h = (np.zeros(n * width * bins, np.int64) for _ in range(2))

    def add(self, y: np.ndarray, bins: np.ndarray, margin: np.ndarray) -> None:
        for lo in range(0, len(y), ROWS_AT_ONCE):  # sums of so many whole numbers are exact as doubles
            some = slice(lo, lo + ROWS_AT_ONCE)
            self._add(y[some], bins[some], margin[some])

    def _add(self, y: np.ndarray, bins: np.ndarray, margin: np.ndarray) -> None:
        g, h = gradients(y, margin, self.scale)
        place = np.arange(self.width) * self.bins + bins.astype(np.int64)
        size = self.width * self.bins
        for c, slots in self.slots.items():
            if c in self.arrays:
                number = np.full(len(self.arrays[c][0]), -1)
                number[list(slots)] = list(slots.values())
                at = number[_route(bins, self.arrays[c])]
            else:
                at = np.full(len(y), slots[0])
            mine = np.flatnonzero(at >= 0)
            if not len(mine):
                continue
            low, high = min(slots.values()), max(slots.values()) + 1  # the nodes of a class follow one another
            cell = ((at[mine] - low)[:, None] * size + place[mine]).ravel()
            for total, part in ((self.g, g), (self.h, h)):
                weights = np.repeat(part[mine, c], self.width)
                total[low * size : high * size] += np.bincount(cell, weights, (high - low) * size).astype(np.int64)

    def rows(self) -> Iterator[list[pa.Array]]:
        used = np.flatnonzero((self.g != 0) | (self.h != 0))
        base = self.first * self.width * self.bins
        for lo in range(0, len(used), 1 << 16):
            some = used[lo : lo + (1 << 16)]
            yield [pa.array(some + base), pa.array(self.g[some]), pa.array(self.h[some])]
