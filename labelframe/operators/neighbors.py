"""Exact k nearest neighbours as a partitioned join, and the classifier on top.

Candidates are cut into cells around pivot points and each cell into rings by the
distance to its pivot (the iDistance idea: Jagadish et al., ACM TODS 2005; the
pivot-cell join: Lu et al., VLDB 2012).  A ring with many rows is divided among centres of
its own, and a large part by a hash, so a block always has a bounded number of rows,
whatever the size of the table.  The driver knows the rings, whose number is bounded; the
parts are a table.  Every query first searches
the one block around it; the k-th distance found there, with the triangle
inequality, rules out the blocks that cannot hold a nearer row, and only the blocks
left are searched.  No pair of rows is ever emitted: a block search gives k rows.

Copies of a vector are one candidate that carries its k + 1 smallest ids, which is
all that an order by (distance, id) can ever use, and what the caller asks for of them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelframe.functions.checkpoints import materialize
from labelframe.functions.classes import class_counts, require_unique
from labelframe.functions.hashing import draw_int, draw_unit
from labelframe.functions.memory import give_back, tidy_pair
from labelframe.functions.reshape import quoted, vector
from labelframe.functions.small import large, local_table, settle

MAX_PIVOTS = 16_384
MAX_RINGS = 32_768
ROUNDS = (8, 64)
SLACK = 1e-6
# a group of so many blocks' rows is searched whole, as one block
WHOLE = 4
TASK_BLOCKS = 32
# a ring of so many blocks is cut by hash, a larger one by centres
HASHED = 4
# distances, or numbers of vectors, that a worker holds in one array
PAIRS_AT_ONCE = 500_000


def nearest(
    queries: DataFrame,
    candidates: DataFrame,
    row_id: str,
    features: Sequence[str] | str,
    k: int = 5,
    group: str | None = None,
    exclude_self: bool = False,
    seed: int = 42,
    block_rows: int = 2048,
    query_rows: int = 8192,
    carry: str | None = None,
    probes: int | None = None,
) -> DataFrame:
    """Rows ``(id, rank, neighbour, distance2)``, rank 1..k by (distance, id).

    With ``group`` a row only meets rows of its own group.  ``exclude_self`` leaves
    out the candidate that has the query's own id.  ``carry`` names a column of the
    candidates, such as the label, that comes along with each neighbour.  Candidate ids
    must be unique: rows that share one could not be told apart.

    The search is exact unless ``probes`` is given: a query then visits its home block
    and the rings nearest to it, ``probes`` in all, and a nearer row elsewhere is missed.
    """
    keep = k + 1 if exclude_self else k

    def prepared(df: DataFrame, *more: Column) -> DataFrame:
        key = F.col(group).cast("string") if group else F.lit("")
        return df.select(key.alias("grp"), F.col(row_id).alias("id"), vector(features).alias("vec"), *more)

    carried = F.col(carry) if carry else F.lit(None).cast("int")
    # each is read several times; what made it, such as a split or an oversampling, runs once
    left, right = materialize(prepared(queries)), materialize(prepared(candidates, carried.alias("carried")))
    require_unique(right, "id", "candidates")
    id_type, carried_type = (right.schema[c].dataType.simpleString() for c in ("id", "carried"))
    index = _Index(right, id_type, carried_type, keep, seed, block_rows)
    brought = f", {quoted(carry)} {carried_type}" if carry else ""
    schema = f"id {id_type}, rank int, neighbour {id_type}, distance2 double{brought}"
    if not index.groups:
        return local_table(queries.sparkSession, [], schema)
    asked = left.where(F.col("grp").isin(list(index.groups)))
    homes = materialize(index.homes(asked))
    best = materialize(index.search(homes, asked, query_rows))
    # nearest rings first, so that the reach has shrunk before the many far ones are weighed
    last = probes - 1 if probes else None
    more = any(g not in index.whole for g in index.groups)
    for lo, hi in zip((0, *ROUNDS), (*ROUNDS, None)) if more else ():
        stop = last if hi is None or last is not None and last < hi else hi
        if stop is not None and stop <= lo:
            break
        visits = materialize(index.open(index.bounds(asked, homes, best), lo, stop))
        if not visits.isEmpty():
            best = materialize(index.nearest_of(best.unionByName(index.search(visits, asked, query_rows))))
        elif stop is None or stop - lo > 1:
            # of two rings one is not the home ring; it is closed, and so are all that come after
            break
    if exclude_self:
        best = best.where(~F.col("id").eqNullSafe(F.col("neighbour")))
    order = Window.partitionBy("id").orderBy("distance2", "neighbour")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("id", "rank", "neighbour", "distance2", *([F.col("carried").alias(carry)] if carry else []))
    )


class _Index:
    """Candidates in blocks, and the bounded directory that says where to look."""

    def __init__(self, rows: DataFrame, id_type: str, carried_type: str, keep: int, seed: int, block_rows: int):
        self.spark, self.id_type, self.keep = rows.sparkSession, id_type, keep
        self.one_type = f"struct<neighbour: {id_type}, carried: {carried_type}>"
        self.found = f"id {id_type}, grp string, distance2 double, neighbour {id_type}, carried {carried_type}"
        sizes = class_counts(rows, "grp")
        self.groups = {g: {} for g in sizes if g is not None}
        if not self.groups:
            return
        self.whole = {g for g in self.groups if sizes[g] <= WHOLE * block_rows}
        self._choose_pivots(rows, sizes, seed, block_rows)
        ring_rows = max(block_rows, math.ceil(sum(sizes.values()) / MAX_RINGS))
        placed = materialize(self._place(self._distinct(rows)))
        self.blocks = self._split(placed, ring_rows, block_rows)

    def _distinct(self, rows: DataFrame) -> DataFrame:
        """One row per distinct vector with its smallest ids; copies stop at the map side."""
        order = Window.partitionBy("grp", "vec").orderBy("id")
        few = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= self.keep)
        one = F.struct(F.col("id").alias("neighbour"), "carried")
        return few.groupBy("grp", "vec").agg(F.array_sort(F.collect_list(one)).alias("ids"))

    def _choose_pivots(self, rows: DataFrame, sizes: dict, seed: int, block_rows: int) -> None:
        share = min(256, max(1, MAX_PIVOTS // len(self.groups)))
        wanted = {g: 1 if g in self.whole else min(share, math.ceil(4 * sizes[g] / block_rows)) for g in self.groups}
        # about 16 times the wanted rows pass the first filter, whatever the size of the group
        share_of = {g: min(1.0, 16 * wanted[g] / sizes[g]) for g in self.groups}
        shares = local_table(self.spark, list(share_of.items()), "grp string, share double")
        order = Window.partitionBy("grp").orderBy("h", "id")
        drawn = (
            rows.join(F.broadcast(shares), "grp")
            .where(draw_unit(seed, "pivot", F.col("id")) < F.col("share"))
            .withColumn("h", draw_int(seed, "pivot", F.col("id")))
            .withColumn("n", F.row_number().over(order))
            .where(F.col("n") <= max(wanted.values()))
            .select("grp", "n", "vec")
        )
        # a small group passes the filter whole; should chance leave a large one without pivots, its least row stands in
        table = drawn.collect()
        for g, info in self.groups.items():
            vecs = [r["vec"] for r in table if r["grp"] == g and r["n"] <= wanted[g]]
            if not vecs:
                vecs = [rows.where(F.col("grp") == F.lit(g)).agg(F.min_by("vec", "id")).first()[0]]
            info["pivots"] = np.unique(np.array(vecs, dtype=float), axis=0)

    def _place(self, distinct: DataFrame) -> DataFrame:
        """Add the nearest pivot of each vector and the distance to it."""
        pivots = {g: info["pivots"] for g, info in self.groups.items()}
        schema = f"grp string, vec array<double>, ids array<{self.one_type}>, cell int, dist double"

        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for g, part in batch.groupby("grp", sort=False):
                    for some in _cut(part, max(pivots[g].shape)):
                        v = _matrix(some["vec"])
                        cell = _distances(v, pivots[g]).argmin(axis=1)
                        dist = np.sqrt(((v - pivots[g][cell]) ** 2).sum(axis=1))
                        yield some.assign(cell=cell.astype("int32"), dist=dist)
            give_back()

        return distinct.where(F.col("grp").isNotNull()).mapInPandas(place, schema)

    def _split(self, placed: DataFrame, ring_rows: int, block_rows: int) -> DataFrame:
        """Number the blocks: rings of a cell, parts of a large ring, pieces of a large part.

        Rings are few, and the driver knows them.  A ring of a few blocks is cut by hash.  A larger
        one is divided among centres drawn from it; these parts with their radii are a table of
        their own, the second level of the directory, which visits meet in a join.  A block
        is a piece by hash of a part and has about ``block_rows`` rows however large the
        table is.
        """
        cells = placed.groupBy("grp", "cell").agg(F.count("*").alias("n"), F.max("dist").alias("radius"))
        widths = [
            (r["grp"], r["cell"], rings, (r["radius"] / rings) or 1.0)
            for r in cells.collect()
            for rings in [1 if r["grp"] in self.whole else math.ceil(r["n"] / ring_rows)]
        ]
        table = local_table(self.spark, widths, "grp string, cell int, rings int, width double")
        ring = F.least(F.floor(F.col("dist") / F.col("width")).cast("int"), F.col("rings") - 1)
        ringed = placed.join(F.broadcast(table), ["grp", "cell"]).withColumn("ring", ring).drop("rings", "width")
        stats = ringed.groupBy("grp", "cell", "ring").agg(
            F.count("*").alias("n"), F.min("dist").alias("lo"), F.max("dist").alias("hi")
        ).collect()
        numbered = []
        for number, r in enumerate(sorted(stats, key=lambda r: (r["grp"], r["cell"], r["ring"]))):
            parts = 1 if r["grp"] in self.whole else math.ceil(r["n"] / block_rows)
            numbered.append((r["grp"], r["cell"], r["ring"], number, parts, r["n"]))
            self.groups[r["grp"]].setdefault("rings", []).append((r["cell"], r["lo"], r["hi"], number, parts, r["n"]))
        for info in self.groups.values():
            info["rings"] = np.array(info["rings"], dtype=float).reshape(-1, 6)
        table = local_table(self.spark, numbered, "grp string, cell int, ring int, number int, parts int, n long")
        rows = ringed.join(F.broadcast(table), ["grp", "cell", "ring"]).select(
            "number", "parts", "n", "vec", F.col("ids.neighbour").alias("neighbours"), F.col("ids.carried").alias("carried")
        )
        few = F.col("parts") <= HASHED
        piece = F.pmod(F.xxhash64("vec"), F.col("parts"))
        small = rows.where(few).select(_block(F.col("number"), None, piece).alias("block"), "vec", "neighbours", "carried")
        self.parts = None
        if all(r[4] <= HASHED for r in numbered):
            return small
        divided = materialize(self._divide(rows.where(~few), block_rows))
        self.parts = materialize(
            divided.groupBy("number", "part")
            .agg(F.first("centre").alias("centre"), F.max("away").alias("radius"), F.count("*").alias("n"))
            .select("number", "part", "centre", "radius", F.ceil(F.col("n") / block_rows).cast("int").alias("pieces"))
        )
        self.near = settle(self.parts)  # fetched once, for all rounds
        pieces = settle(self.parts.select("number", "part", "pieces"))
        piece = F.pmod(F.xxhash64("vec"), F.col("pieces"))
        large = divided.join(pieces, ["number", "part"]).select(
            _block(F.col("number"), F.col("part"), piece).alias("block"), "vec", "neighbours", "carried"
        )
        return small.unionByName(large)

    def _divide(self, rows: DataFrame, block_rows: int) -> DataFrame:
        """Rows of large rings with the nearest of the centres drawn in their ring, and the distance to it.

        A ring is spread over tasks of about ``TASK_BLOCKS`` blocks, each of which gets its centres.
        """
        share = F.least(F.lit(1.0), F.col("parts") / F.col("n"))
        draw = F.pmod(F.xxhash64("vec", F.lit("centre")), F.lit(1 << 30)) / float(1 << 30)
        picked = rows.where(draw < share).select("number", "vec")
        least = rows.groupBy("number").agg(F.min("vec").alias("vec"))  # chance may leave a ring without any
        centres = picked.unionByName(least).distinct()
        salts = F.ceil(F.col("parts") / TASK_BLOCKS).cast("int")
        sizes = rows.select("number", salts.alias("salts")).distinct()
        copies = centres.join(sizes, "number").select("number", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "vec")
        copies = materialize(copies)
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("vec", F.lit("salt")), salts).cast("int")).drop("parts", "n")
        ids = {c: rows.schema[c].dataType.simpleString() for c in ("neighbours", "carried")}
        schema = f"number int, vec array<double>, neighbours {ids['neighbours']}, carried {ids['carried']}, part int, centre array<double>, away double"

        def nearest_centre(some: pa.Table, around: pa.Table) -> pa.Table:
            if not some.num_rows:
                some = some.slice(0, 0)
            x = _rows(some.column("vec"))
            c = np.unique(_rows(around.column("vec")), axis=0)  # the same numbers in every task of the ring
            step = max(1, PAIRS_AT_ONCE // max(c.shape))
            part, away = np.zeros(len(x), np.int64), np.zeros(len(x))
            for i in range(0, len(x), step):
                v = x[i : i + step]
                part[i : i + step] = _distances(v, c).argmin(axis=1)
                away[i : i + step] = np.sqrt(((v - c[part[i : i + step]]) ** 2).sum(axis=1))
            ends = (np.arange(len(part) + 1) * c.shape[1]).astype(np.int32)
            columns = {n: some.column(n).combine_chunks() for n in ("number", "vec", "neighbours", "carried")}
            columns |= {"part": pa.array(part, pa.int32()), "centre": pa.ListArray.from_arrays(ends, c[part].ravel()), "away": pa.array(away)}
            return pa.table(columns)

        return salted.groupBy("number", "salt").cogroup(copies.groupBy("number", "salt")).applyInArrow(tidy_pair(nearest_centre), schema)

    def nearest_of(self, found: DataFrame) -> DataFrame:
        """The ``keep`` nearest rows of each query."""
        order = Window.partitionBy("id", "grp").orderBy("distance2", "neighbour")
        return found.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= self.keep).drop("_n")

    def bounds(self, queries: DataFrame, homes: DataFrame, best: DataFrame) -> DataFrame:
        """The queries with their home block and the distance of their k-th row so far, null without so many."""
        kth = best.groupBy("id", "grp").agg(F.when(F.count("*") >= self.keep, F.sqrt(F.max("distance2"))).alias("kth"))
        both = homes.select("id", "grp", F.col("block").alias("home")).join(large(kth), _same_query(homes, kth), "left")
        both = both.select(homes["id"], homes["grp"], "home", "kth")
        return queries.join(large(both), _same_query(queries, both)).select(queries["id"], queries["grp"], "vec", "home", "kth")

    def homes(self, queries: DataFrame) -> DataFrame:
        """``(id, grp, block, reach)``: the one block around each query, without a bound."""
        rings = self._visits(queries, lambda part, info: _home_rings(part, info))
        return self._blocks_of(rings, queries, home=True)

    def open(self, queries: DataFrame, first: int = 0, last: int | None = None) -> DataFrame:
        """The blocks still open after the home block, as ``homes``.

        Rows beyond ``reach`` are not looked for.  In the order of their least possible
        distance, the rings from ``first`` on and before ``last`` are looked at, and of a
        large ring the parts that come within reach.
        """
        keep = self.keep
        rings = self._visits(queries, lambda part, info: _open_rings(part, info, keep, first, last))
        blocks = self._blocks_of(rings, queries)
        same = _same_query(blocks, queries) & (blocks["block"] == queries["home"])
        return blocks.join(large(queries.select("id", "grp", "home")), same, "left_anti")

    def _visits(self, queries: DataFrame, choose: Callable) -> DataFrame:
        groups = self.groups

        def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for g, part in batch.groupby("grp", sort=False):
                    if g not in groups:
                        continue
                    for some in _cut(part, max(len(groups[g]["rings"]) + len(groups[g]["pivots"]), groups[g]["pivots"].shape[1])):
                        rows, rings, reach = choose(some, groups[g])
                        parts = groups[g]["rings"][rings, 4]
                        numbers = groups[g]["rings"][rings, 3].astype("int32")
                        for i in range(0, len(rows), 20_000):
                            cut = slice(i, i + 20_000)
                            out = some.iloc[rows[cut]][["id", "grp"]]
                            yield out.assign(number=numbers[cut], pieces=parts[cut].astype("int32"), reach=reach[rows[cut]])
            give_back()

        return queries.mapInPandas(visits, f"id {self.id_type}, grp string, number int, pieces int, reach double")

    def _blocks_of(self, rings: DataFrame, queries: DataFrame, home: bool = False) -> DataFrame:
        """The blocks of the visited rings: the ring itself, or its parts in reach (of a home ring, the nearest part)."""
        few = F.col("pieces") <= HASHED
        piece = F.lit(0) if home else F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
        direct = rings.where(few).withColumn("piece", piece)
        direct = direct.select("id", "grp", _block(F.col("number"), None, F.col("piece")).alias("block"), "reach")
        if self.parts is None:
            return direct
        visits = rings.where(~few).drop("pieces")
        met = visits.join(large(queries.select("id", "grp", "vec")), _same_query(visits, queries)).select(visits["id"], visits["grp"], "number", "reach", "vec")
        met = met.join(self.near, "number")
        squares = F.zip_with("vec", "centre", lambda a, b: (a - b) * (a - b))
        scale = F.sqrt(F.aggregate("centre", F.lit(0.0), lambda t, v: t + v * v)) + F.sqrt(F.aggregate("vec", F.lit(0.0), lambda t, v: t + v * v))
        met = met.withColumn("least", F.sqrt(F.aggregate(squares, F.lit(0.0), lambda t, v: t + v)) - F.col("radius") - SLACK * scale)
        if home:
            order = Window.partitionBy("id", "grp").orderBy("least", "part")
            nearest = met.withColumn("_n", F.row_number().over(order)).where("_n = 1")
            piece = F.pmod(F.xxhash64("id"), F.col("pieces"))
        else:
            nearest = met.where(F.col("least") <= F.col("reach"))
            nearest = nearest.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
            piece = F.col("piece")
        return direct.unionByName(nearest.select("id", "grp", _block(F.col("number"), F.col("part"), piece).alias("block"), "reach"))

    def search(self, visits: DataFrame, queries: DataFrame, query_rows: int) -> DataFrame:
        """``(id, grp, distance2, neighbour, carried)``: the ``keep`` nearest rows of each visited block.

        Visits are stored without vectors, which meet them on the way to the block.  A block
        with many visitors is copied, and its visitors are spread over the copies; how often a
        block is visited stays a table, broadcast only if it is small.
        """
        keep = self.keep
        often = visits.groupBy(F.col("block").alias("at")).agg(F.ceil(F.count("*") / query_rows).cast("int").alias("chunks"))
        chunks = settle(often)
        visits = visits.join(chunks, visits["block"] == chunks["at"]).withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
        asked = visits.join(large(queries), _same_query(visits, queries)).select("block", "chunk", visits["id"], visits["grp"], "vec", "reach")
        held = (
            self.blocks.join(chunks, self.blocks["block"] == chunks["at"])
            .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .select("block", "chunk", "vec", "neighbours", "carried")
        )

        def best(ask: pa.Table, have: pa.Table) -> pa.Table:
            ask, have = ask.combine_chunks(), have.combine_chunks()
            if not ask.num_rows or not have.num_rows:
                # a hash part may be empty; its visitors go on to the other blocks
                row, d2, entry = (np.zeros(0, np.int64) for _ in range(3))
            else:
                lists = have.column("neighbours").combine_chunks()
                row, d2, entry = _top(
                    _rows(ask.column("vec")), ask.column("reach").to_numpy(), _rows(have.column("vec")),
                    lists.value_lengths().to_numpy(), lists.flatten().to_numpy(zero_copy_only=False), keep,
                )
            row, entry = pa.array(row, pa.int64()), pa.array(entry, pa.int64())
            flat = {c: have.column(c).combine_chunks().flatten() for c in ("neighbours", "carried")}
            return pa.table(
                {
                    "id": ask.column("id").take(row), "grp": ask.column("grp").take(row), "distance2": pa.array(d2, pa.float64()),
                    "neighbour": flat["neighbours"].take(entry), "carried": flat["carried"].take(entry),
                }
            )

        return asked.groupBy("block", "chunk").cogroup(held.groupBy("block", "chunk")).applyInArrow(tidy_pair(best), self.found)


def _block(number: Column, part: Column | None = None, piece: Column | None = None) -> Column:
    """The number of a block: that of its ring, its part, its piece."""
    zero = F.lit(0)
    low = (zero if part is None else part).cast("long") * (1 << 16) + (zero if piece is None else piece).cast("long")
    return F.shiftleft(number.cast("long"), 32) + low


def _same_query(a: DataFrame, b: DataFrame) -> Column:
    return a["id"].eqNullSafe(b["id"]) & (a["grp"] == b["grp"])


def _rows(column: pa.ChunkedArray) -> np.ndarray:
    """An array column as a matrix."""
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float)
    if np.isnan(flat).any():
        raise ValueError("missing values in a feature vector")
    return flat.reshape(len(column), -1)


def _matrix(column: pd.Series) -> np.ndarray:
    out = np.array(column.tolist(), dtype=float)
    if np.isnan(out).any():
        raise ValueError("missing values in a feature vector")
    return out


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances by one matrix product; right to a small multiple of the norms."""
    d2 = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(d2, 0.0))


def _cut(part: pd.DataFrame, width: int) -> Iterator[pd.DataFrame]:
    """A batch in pieces whose rows have ``PAIRS_AT_ONCE`` numbers or fewer, ``width`` each."""
    step = max(1, PAIRS_AT_ONCE // width)
    for at in range(0, len(part), step):
        yield part.iloc[at : at + step]


def _slack(v: np.ndarray, info: dict) -> np.ndarray:
    scale = np.sqrt((v * v).sum(axis=1)) + np.sqrt((info["pivots"] ** 2).sum(axis=1).max())
    return (SLACK * scale)[:, None]


def _home_rings(part: pd.DataFrame, info: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query the ring that comes nearest to it."""
    v, rings = _matrix(part["vec"]), info["rings"]
    d = _distances(v, info["pivots"])[:, rings[:, 0].astype(int)]
    gap = np.maximum(np.maximum(rings[:, 1] - d, d - rings[:, 2]), 0.0)
    return np.arange(len(part)), (gap + 1e-3 * d).argmin(axis=1), np.full(len(part), np.inf)


def _open_rings(
    part: pd.DataFrame, info: dict, keep: int, first: int, last: int | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query the rings that may hold a row nearer than its k-th so far, ranked [first, last)."""
    v, rings = _matrix(part["vec"]), info["rings"]
    cell = rings[:, 0].astype(int)
    to_pivot = _distances(v, info["pivots"])
    d = to_pivot[:, cell]
    reach = part["kth"].fillna(np.inf).to_numpy(dtype=float)
    # a set of rings with at least `keep` rows bounds the k-th distance from above
    most = d + rings[:, 2]
    order = most.argsort(axis=1)
    enough = (rings[order, 5].cumsum(axis=1) >= keep).argmax(axis=1)
    held = rings[:, 5].sum() >= keep
    bound = np.take_along_axis(most, order, axis=1)[np.arange(len(part)), enough] if held else np.inf
    reach = np.minimum(reach, bound)[:, None] + _slack(v, info)
    ring_gap = np.maximum(rings[:, 1] - d, d - rings[:, 2])
    # a row of a cell is no nearer to any other pivot than to its own
    half_plane = (d - to_pivot.min(axis=1)[:, None]) / 2.0
    least = np.maximum(ring_gap, half_plane)
    by_bound = least.argsort(axis=1, kind="stable")[:, first:last]
    rows, place = np.nonzero(np.take_along_axis(least, by_bound, axis=1) <= reach)
    return rows, by_bound[rows, place], reach[:, 0]


def _offsets(parts: np.ndarray) -> np.ndarray:
    """0..p-1 for each p in parts, end to end."""
    starts = np.repeat(np.cumsum(parts) - parts, parts)
    return np.arange(parts.sum()) - starts


def _top(
    asked: np.ndarray, reach: np.ndarray, held: np.ndarray, size: np.ndarray, names: np.ndarray, keep: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, squared distance, entry) of the ``keep`` nearest (distance, id) of one block, as far as the reach.

    A matrix product gives a shortlist with a margin for its rounding; distances of
    the shortlist are then taken from the differences themselves.
    """
    n = min(keep, len(held))
    norm = np.sqrt((held * held).sum(axis=1)).max()
    # copies of a vector: entries of one candidate, ranked by id over the block
    first = np.cumsum(size) - size
    place = np.unique(names, return_inverse=True)[1]
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    step, width = (max(1, PAIRS_AT_ONCE // max(1, n)) for n in held.shape)
    for at in range(0, len(asked), step):
        some = asked[at : at + step]
        rough = _distances(some, held)
        kth = np.partition(rough, n - 1, axis=1)[:, n - 1]
        margin = SLACK * (np.sqrt((some * some).sum(axis=1)) + norm)
        rows, cols = np.nonzero(rough <= (np.minimum(kth, reach[at : at + step]) + margin)[:, None])
        d2 = np.empty(len(rows))
        for i in range(0, len(rows), width):
            cut = slice(i, i + width)
            d2[cut] = ((some[rows[cut]] - held[cols[cut]]) ** 2).sum(axis=1)
        entries = np.repeat(first[cols], size[cols]) + _offsets(size[cols])
        rows, d2 = np.repeat(rows, size[cols]), np.repeat(d2, size[cols])
        order = np.lexsort((place[entries], d2, rows))
        rows, d2, entries = rows[order], d2[order], entries[order]
        nth = np.arange(len(rows)) - np.searchsorted(rows, rows)
        mine = nth < keep
        out.append((rows[mine] + at, d2[mine], entries[mine]))
    return tuple(np.concatenate(c) for c in zip(*out))


def vote(neighbours: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Most frequent label among the neighbours; the smallest label wins ties.

    ``neighbours`` holds the label, as ``nearest`` brings it with ``carry``.
    """
    counted = neighbours.groupBy(*by, "id", F.col(label).alias("prediction")).agg(F.count("*").alias("votes"))
    return counted.groupBy(*by, "id").agg(
        F.min_by("prediction", F.struct(-F.col("votes"), F.col("prediction"))).alias("prediction")
    )


def vote_each(neighbours: DataFrame, label: str, ks: Sequence[int]) -> DataFrame:
    """Votes of the first k neighbours for several k, from one neighbour table."""
    some = F.filter(F.array(*[F.lit(k) for k in ks]), lambda k: k >= F.col("rank"))
    return vote(neighbours.withColumn("k", F.explode(some)), label, ["k"])


def classify(
    train: DataFrame, test: DataFrame, row_id: str, label: str, features: Sequence[str] | str, k: int = 5, **options
) -> DataFrame:
    """k-nearest-neighbour predictions ``(id, label, prediction)`` for the test rows."""
    found = nearest(test, train, row_id, features, k=k, carry=label, **options)
    predicted = vote(found, label)
    truth = test.select(F.col(row_id).alias("id"), F.col(label).alias("label"))
    return truth.join(large(predicted), "id", "left")
