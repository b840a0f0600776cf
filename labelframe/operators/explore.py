"""The tables behind exploratory charts."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelframe.functions.checkpoints import materialize
from labelframe.functions.reshape import aggregate_columns, present
from labelframe.functions.small import settle
from labelframe.operators.profile import with_share
from labelframe.operators.quantiles import quantiles

NARROW = 8
TILE = 1536
# cells of half a bandwidth, and their moments, for the density
CELL = 0.5
TERMS = 12
# exp(-z * z / 2) is zero in double arithmetic beyond this many bandwidths
REACH = 39.0
SUMS = ["n", "x", "y", "xx", "yy", "xy"]


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 50) -> DataFrame:
    """Equal-width bins from min to max, the last one closed; empty bins count 0.

    Rows ``(ordinal, column, bin, lower, upper, n)``.  A column with one value gets
    bins over value - 0.5 to value + 0.5.
    """
    columns = list(columns)
    spans = aggregate_columns(
        df,
        columns,
        {
            "a": lambda c: F.min(present(df, c)).cast("double"),
            "b": lambda c: F.max(present(df, c)).cast("double"),
        },
    )
    flat = F.col("a") == F.col("b")
    spans = spans.where(F.col("a").isNotNull()).select(
        "ordinal",
        "column",
        F.when(flat, F.col("a") - 0.5).otherwise(F.col("a")).alias("lo"),
        F.when(flat, F.col("b") + 0.5).otherwise(F.col("b")).alias("hi"),
    )
    spans = spans.withColumn("w", (F.col("hi") - F.col("lo")) / bins)
    # the spans, one row per column, are needed as bounds of the scan below
    bounds = {r["ordinal"]: (r["lo"], r["w"]) for r in spans.collect()}
    values = [
        _bin_of(present(df, c).cast("double"), *bounds[i], bins) if i in bounds else F.lit(None).cast("long")
        for i, c in enumerate(columns)
    ]
    counted = (
        df.select(F.posexplode(F.array(*values)).alias("ordinal", "bin"))
        .where(F.col("bin").isNotNull())
        .groupBy("ordinal", "bin")
        .agg(F.count("*").alias("n"))
    )
    grid = spans.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))).alias("bin"))
    edge = F.col("lo") + F.col("bin") * F.col("w")
    last = F.col("bin") == bins - 1
    return grid.join(F.broadcast(counted), ["ordinal", "bin"], "left").select(
        "ordinal",
        "column",
        "bin",
        edge.alias("lower"),
        F.when(last, F.col("hi")).otherwise(F.col("lo") + (F.col("bin") + 1) * F.col("w")).alias("upper"),
        F.coalesce(F.col("n"), F.lit(0)).alias("n"),
    )


def _bin_of(value: Column, lo: float, w: float, bins: int) -> Column:
    """Bin number, put right against the bin edges where rounding moved it; null stays null."""
    lo, w = F.lit(lo), F.lit(w)
    rough = F.least(F.greatest(F.floor((value - lo) / w), F.lit(0)), F.lit(bins - 1))
    return (
        F.when(value.isNull(), F.lit(None).cast("long"))
        .when(value < lo + rough * w, F.greatest(rough - 1, F.lit(0)))
        .when((rough < bins - 1) & (value >= lo + (rough + 1) * w), rough + 1)
        .otherwise(rough)
    )


def adjusted_skewness(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Bias-adjusted skewness; null below three values."""
    raw = aggregate_columns(
        df,
        columns,
        {"n": lambda c: F.count(present(df, c)), "g": lambda c: F.skewness(present(df, c))},
        by,
    )
    n = F.col("n").cast("double")
    adjusted = F.when(F.col("n") > 2, F.col("g") * F.sqrt(n * (n - 1)) / (n - 2))
    return raw.select(*by, "ordinal", "column", "n", adjusted.alias("skewness"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson r of every ordered pair of columns, in long form.

    Each unordered pair is computed once, on the rows where both are present; the
    mirror image is added to the small result.  Up to ``NARROW`` columns are one aggregate
    in the JVM, up to ``TILE`` one pass of matrix products; more are cut into tiles, a pass
    over two tiles for each pair of them.
    """
    columns = list(columns)
    if len(columns) <= NARROW:
        lower = _pairs_by_aggregate(df, columns)
    else:
        tiles = [range(i, min(i + TILE, len(columns))) for i in range(0, len(columns), TILE)]
        means = _means(df, columns)
        lower = reduce(
            DataFrame.unionByName,
            [_pairs_by_product(df, columns, means, a, b) for i, a in enumerate(tiles) for b in tiles[: i + 1]],
        )
    mirror = F.struct(F.col("j").alias("i"), F.col("i").alias("j"), "r")
    one, both = F.array(F.struct("i", "j", "r")), F.array(F.struct("i", "j", "r"), mirror)
    out = lower.select(F.inline(F.when(F.col("i") == F.col("j"), one).otherwise(both)))
    names = F.array(*[F.lit(c) for c in columns])
    return out.select(
        F.col("i").alias("ordinal_a"),
        F.col("j").alias("ordinal_b"),
        F.element_at(names, F.col("i") + 1).alias("feature_a"),
        F.element_at(names, F.col("j") + 1).alias("feature_b"),
        "r",
    )


def _pairs_by_aggregate(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(i, j, r)``, j <= i, from one aggregation."""
    values = df.select(*[present(df, c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    pairs = [(i, j) for i in range(len(columns)) for j in range(i + 1)]
    sums = {"xy": F.regr_sxy, "xx": F.regr_sxx, "yy": F.regr_syy}
    found = values.agg(*[f(f"c{i}", f"c{j}").alias(f"{n}{i}_{j}") for i, j in pairs for n, f in sums.items()])

    def r(i: int, j: int) -> Column:
        xy, below = F.col(f"xy{i}_{j}"), F.col(f"xx{i}_{j}") * F.col(f"yy{i}_{j}")
        raw = F.lit(1.0) if i == j else F.greatest(F.least(xy / F.nullif(F.sqrt(below), F.lit(0.0)), F.lit(1.0)), F.lit(-1.0))
        return F.when(below > 0, raw)

    return found.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), r(i, j).alias("r")) for i, j in pairs])))


def _means(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    values = df.select(*[present(df, c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    means = values.agg(*[F.avg(f"c{i}") for i in range(len(columns))]).first()
    return np.array([0.0 if m is None else m for m in means], dtype=float)


def _pairs_by_product(df: DataFrame, columns: Sequence[str], means: np.ndarray, rows: range, cols: range) -> DataFrame:
    """``(i, j, r)``, j <= i, of the columns numbered ``rows`` with those numbered ``cols``.

    Each task multiplies its batches into sums over pairs, about the column means so
    that nothing cancels; Spark adds the sums of the tasks up.  A task holds the sums of
    one tile of columns with another, so its memory does not grow with the width.
    """
    used = [*rows, *(j for j in cols if j not in rows)]
    values = df.select(*[present(df, columns[i]).cast("double").alias(f"c{i}") for i in used])
    at = {i: k for k, i in enumerate(used)}
    left, right = [at[i] for i in rows], [at[j] for j in cols]
    centre = means[used]
    i, j = (a.ravel() for a in np.meshgrid(np.array(rows), np.array(cols), indexing="ij"))
    kept = j <= i

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((6, len(left), len(right)))
        for batch in batches:
            x = batch.to_numpy(dtype=float) - centre
            there = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x)
            squares = x * x
            a, b, at_, bt, a2, b2 = x[:, left], x[:, right], there[:, left], there[:, right], squares[:, left], squares[:, right]
            total += [at_.T @ bt, a.T @ bt, at_.T @ b, a2.T @ bt, at_.T @ b2, a.T @ b]
        yield pd.DataFrame({"i": i[kept], "j": j[kept], **{n: total[k].ravel()[kept] for k, n in enumerate(SUMS)}})

    schema = "i int, j int, " + ", ".join(f"{n} double" for n in SUMS)
    added = values.mapInPandas(sums, schema).groupBy("i", "j").agg(*[F.sum(n).alias(n) for n in SUMS])
    n, x, y, xx, yy, xy = [F.col(c) for c in SUMS]
    some = F.nullif(n, F.lit(0.0))
    below = (xx - x * x / some) * (yy - y * y / some)
    r = (xy - x * y / some) / F.nullif(F.sqrt(below), F.lit(0.0))
    bounded = F.greatest(F.least(F.when(F.col("i") == F.col("j"), 1.0).otherwise(r), F.lit(1.0)), F.lit(-1.0))
    return added.select("i", "j", F.when((n > 0) & (below > 0), bounded).alias("r"))


def strong_pairs(corr: DataFrame, threshold: float = 0.85) -> DataFrame:
    """Pairs of the strict lower triangle with |r| above the threshold, strongest first."""
    strength = F.abs("r")
    return (
        corr.where((F.col("ordinal_a") > F.col("ordinal_b")) & (strength > threshold))
        .select("feature_a", "feature_b", strength.alias("abs_r"))
        .orderBy(F.desc("abs_r"), "feature_a", "feature_b")
    )


def box_statistics(
    df: DataFrame, columns: Sequence[str], label: str, whisker: float = 1.5, approx: bool = False
) -> DataFrame:
    """Per (feature, class): quartiles, whisker ends, outliers beyond 1.5 x IQR."""
    quarters = quantiles(df, columns, [0.25, 0.5, 0.75], by=[label], approx=approx)
    reach = F.lit(whisker) * (F.col("q")[2] - F.col("q")[0])
    fences = quarters.where("q IS NOT NULL").select(
        F.col(label).alias("class"),
        "ordinal",
        "column",
        F.col("q")[0].alias("q25"),
        F.col("q")[1].alias("q50"),
        F.col("q")[2].alias("q75"),
        (F.col("q")[0] - reach).alias("lower"),
        (F.col("q")[2] + reach).alias("upper"),
    )
    fences = materialize(fences)
    table = fences.groupBy("class").agg(
        F.map_from_entries(F.collect_list(F.struct("ordinal", F.struct("lower", "upper")))).alias("fence")
    )
    table = settle(table)
    joined = df.join(table, df[label].eqNullSafe(table["class"])).drop(label)

    def inside(i: int, c: str) -> Column:
        value, fence = present(df, c), F.element_at("fence", F.lit(i))
        return F.when(value.between(fence["lower"], fence["upper"]), value.cast("double"))

    position = {c: i for i, c in enumerate(columns)}
    ends = aggregate_columns(
        joined,
        columns,
        {
            "n": lambda c: F.count(present(df, c)),
            "whisker_low": lambda c: F.min(inside(position[c], c)),
            "whisker_high": lambda c: F.max(inside(position[c], c)),
            "n_inside": lambda c: F.count(inside(position[c], c)),
        },
        ["class"],
    )
    ends = ends.withColumn("n_outliers", F.col("n") - F.col("n_inside")).drop("n_inside", "column")
    same = fences["class"].eqNullSafe(ends["class"]) & (fences["ordinal"] == ends["ordinal"])
    return fences.join(ends, same).select(
        fences["class"], fences["ordinal"], "column", "n", "q25", "q50", "q75", "whisker_low", "whisker_high", "n_outliers"
    )


def density(
    df: DataFrame, columns: Sequence[str], label: str, grid: int = 100, cut: float = 2.0, bins: int | None = None
) -> DataFrame:
    """Gaussian kernel density of each (feature, class) on an even grid.

    Bandwidth std * n^(-1/5); the grid reaches ``cut`` bandwidths past the extremes.  The
    kernel sums come from moments (the fast Gauss transform of Greengard and Strain): cells
    of half a bandwidth sum the powers d^m / m! of their values' distances d to the cell's
    centre, in bandwidths, and at the distance t of a grid point the cell adds

        exp(-t^2 / 2) * sum over m of He_m(t) * moment_m

    with the Hermite polynomials He_m.  With |d| <= 1/4 and ``TERMS`` moments a value's part
    is off by less than 4e-12 of its kernel's height.  The rows are aggregated map-side by
    cell, a scan of two columns for each feature; cells meet the grid points within
    ``REACH`` bandwidths, beyond which the kernel is zero.  ``bins`` first moves values to the
    middle of that many bins per group, for comparison with binned estimates.  Groups with
    one value, without a spread or with an infinite value have no curve.
    """
    columns = list(columns)
    moments = aggregate_columns(
        df,
        columns,
        {
            "n_total": lambda c: F.count(present(df, c)),
            "std": lambda c: F.stddev_samp(present(df, c)),
            "lo": lambda c: F.min(present(df, c)).cast("double"),
            "hi": lambda c: F.max(present(df, c)).cast("double"),
        },
        [label],
    ).withColumnRenamed(label, "class")
    width = F.col("std") * F.pow(F.col("n_total").cast("double"), F.lit(-0.2))
    params = moments.withColumn("h", width).where((F.col("h") > 0) & (F.col("h") < float("inf")))
    params = params.withColumn("start", F.col("lo") - cut * F.col("h")).withColumn(
        "step", (F.col("hi") - F.col("lo") + 2 * cut * F.col("h")) / (grid - 1)
    )
    params = settle(params.select("class", "ordinal", "column", "n_total", "h", "lo", "hi", "start", "step"))
    cells = reduce(DataFrame.unionByName, [_cell_moments(df, c, label, params.where(F.col("ordinal") == i), bins) for i, c in enumerate(columns)])
    centre = F.col("lo") + (F.col("cell") + 0.5) * F.col("h") * CELL
    first = F.greatest(F.ceil((centre - REACH * F.col("h") - F.col("start")) / F.col("step")), F.lit(0)).cast("int")
    last = F.least(F.floor((centre + REACH * F.col("h") - F.col("start")) / F.col("step")), F.lit(grid - 1)).cast("int")
    reached = F.when(first <= last, F.sequence(first, last))
    near = cells.select("class", "ordinal", "h", "start", "step", centre.alias("centre"), *[a.alias(f"a{k}") for k, a in enumerate(_polynomial())], F.explode(reached).alias("point"))
    near = near.withColumn("t", (F.col("start") + F.col("point") * F.col("step") - F.col("centre")) / F.col("h"))
    value = F.col(f"a{TERMS - 1}")
    for k in range(TERMS - 2, -1, -1):
        value = value * F.col("t") + F.col(f"a{k}")
    points = near.groupBy("class", "ordinal", "point").agg(F.sum(value * F.exp(F.col("t") * F.col("t") * -0.5)).alias("mass"))
    every = params.select("*", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("at"))
    same = every["class"].eqNullSafe(points["class"]) & (every["ordinal"] == points["ordinal"]) & (F.col("at") == points["point"])
    scale = F.lit(0.3989422804014327) / (F.col("n_total") * F.col("h"))
    return every.join(points, same, "left").select(
        every["class"],
        every["ordinal"],
        "column",
        F.col("at").alias("point"),
        (F.col("start") + F.col("at") * F.col("step")).alias("x"),
        (F.greatest(F.coalesce("mass", F.lit(0.0)), F.lit(0.0)) * scale).alias("density"),
    )


def _cell_moments(df: DataFrame, column: str, label: str, params: DataFrame, bins: int | None) -> DataFrame:
    """``(class, ordinal, h, lo, start, step, cell, m0, m1, ...)`` of one feature."""
    own = df.select(F.col(label).alias("g"), present(df, column).cast("double").alias("v")).where(F.col("v").isNotNull())
    met = own.join(params, own["g"].eqNullSafe(params["class"]))
    if bins is not None:
        w = (F.col("hi") - F.col("lo")) / bins
        met = met.withColumn("v", F.col("lo") + (F.least(F.floor((F.col("v") - F.col("lo")) / w), F.lit(bins - 1)) + 0.5) * w)
    met = met.withColumn("u", (F.col("v") - F.col("lo")) / (F.col("h") * CELL)).withColumn("cell", F.floor("u"))
    met = met.withColumn("d", (F.col("u") - F.col("cell") - 0.5) * CELL)
    powers = [F.count("*").cast("double").alias("m0")]
    power = F.col("d")
    for k in range(1, TERMS):
        powers.append((F.sum(power) / math.factorial(k)).alias(f"m{k}"))
        power = power * F.col("d")
    return met.groupBy("class", "ordinal", "h", "lo", "start", "step", "cell").agg(*powers)


def _polynomial() -> list[Column]:
    """Coefficients by the power of t of the sum of He_m(t) times moment m."""
    hermite = [[1.0], [0.0, 1.0]]
    for m in range(1, TERMS - 1):
        up = [0.0, *hermite[m]]
        hermite.append([a - m * b for a, b in zip(up, [*hermite[m - 1], 0.0, 0.0])])
    return [sum(((F.col(f"m{m}") * h[k]) for m, h in enumerate(hermite) if k < len(h) and h[k]), F.lit(0.0)) for k in range(TERMS)]


def violin(df: DataFrame, columns: Sequence[str], label: str, grid: int = 100, bins: int | None = None) -> DataFrame:
    """The density table with the quartiles of each (feature, class) beside it."""
    quarters = quantiles(df, columns, [0.25, 0.5, 0.75], by=[label]).where("q IS NOT NULL").select(
        F.col(label).alias("q_class"),
        F.col("ordinal").alias("q_ordinal"),
        F.col("q")[0].alias("q25"),
        F.col("q")[1].alias("q50"),
        F.col("q")[2].alias("q75"),
    )
    curve = density(df, columns, label, grid=grid, bins=bins)
    same = curve["class"].eqNullSafe(quarters["q_class"]) & (curve["ordinal"] == quarters["q_ordinal"])
    return curve.join(quarters, same).drop("q_class", "q_ordinal")


def cross_counts(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """Cross-tabulation in long form ``(row, col, n)``, without empty cells."""
    return (
        df.where(F.col(rows).isNotNull() & F.col(columns).isNotNull())
        .groupBy(F.col(rows).alias("row"), F.col(columns).alias("col"))
        .agg(F.count("*").alias("n"))
    )


def cross_tab(df: DataFrame, rows: str, columns: str, max_columns: int = 1_000) -> DataFrame:
    """Cross-tabulation with one column per value of ``columns``; empty cells are 0."""
    found = cross_counts(df, rows, columns).select("col").distinct().orderBy("col").limit(max_columns + 1).collect()
    if len(found) > max_columns:
        raise ValueError(f"{columns} has more than {max_columns} values; use cross_counts")
    values = [r["col"] for r in found]
    return (
        df.where(F.col(rows).isNotNull() & F.col(columns).isNotNull())
        .groupBy(F.col(rows).alias("row"))
        .agg(*[F.count_if(F.col(columns) == F.lit(v)).alias(str(v)) for v in values])
    )


def cross_tab_percent(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """Long cross-tabulation with each cell's percentage of its row."""
    counts = cross_counts(df, rows, columns)
    total = F.sum("n").over(Window.partitionBy("row"))
    return counts.withColumn("pct", F.col("n") / total * 100)


def indicator_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sum of each indicator column, largest first."""
    sums = aggregate_columns(df, columns, {"n": lambda c: F.sum(present(df, c)).cast("double")})
    return sums.orderBy(F.desc("n"), "ordinal")


def sparse_indicators(df: DataFrame, columns: Sequence[str], share: float = 0.01, below: int = 100) -> DataFrame:
    """Indicators set in less than ``share`` of the rows, flagged when under ``below`` rows."""
    total = df.agg(F.count("*")).scalar()
    return (
        indicator_counts(df, columns)
        .where(F.col("n") < total * F.lit(share))
        .select("ordinal", "column", "n", (F.col("n") < below).alias("is_extreme"))
    )


def sparse_categories(df: DataFrame, column: str, share: float = 0.01, below: int = 100) -> DataFrame:
    """The same on the category column itself, for any number of categories."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return (
        with_share(counts, "n", "pct")
        .where(F.col("pct") < share * 100)
        .withColumn("is_extreme", F.col("n") < below)
    )


def importance_ranking(importances: DataFrame, threshold: float, top_n: int = 30) -> DataFrame:
    """The top features by importance, each marked keep or drop."""
    return (
        importances.orderBy(F.desc("importance"), "ordinal")
        .limit(top_n)
        .select(
            "ordinal",
            "feature",
            "importance",
            F.when(F.col("importance") >= threshold, "keep").otherwise("drop").alias("decision"),
        )
    )
