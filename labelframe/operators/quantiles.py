"""Exact interpolated quantiles, per group, of any number of columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelframe.functions.checkpoints import materialize
from labelframe.functions.reshape import aggregate_columns, present
from labelframe.functions.small import settle

BINS = 10_000
LEAST_BINS = 100
GRID = 1000
SORTED_AT_ONCE = 200_000
MOST_PASSES = 6


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    approx: bool = False,
    bins: int = BINS,
    small: int = SORTED_AT_ONCE,
) -> DataFrame:
    """Rows ``(by..., ordinal, column, q)`` with ``q`` an array aligned to ``probs``.

    Every group and column has a row; ``q`` is null where there is no value.  ``approx``
    gives Spark's bounded sketch instead.  See ``summaries`` for the way.
    """
    columns = list(columns)
    if approx:
        wanted = F.array(*[F.lit(float(p)) for p in probs])
        return aggregate_columns(
            df, columns, {"q": lambda c: F.percentile_approx(present(df, c).cast("double"), wanted)}, by
        )
    return summaries(df, columns, probs, by, {}, bins, small)


def summaries(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    measures: Mapping[str, Callable[[str], Column]] | None = None,
    bins: int = BINS,
    small: int = SORTED_AT_ONCE,
) -> DataFrame:
    """Rows ``(by..., ordinal, column, measures..., q)``: other aggregates and exact quantiles.

    The first pass takes the measures and, from a sketch whose ranks are off by 1 / ``bins``
    of the values at most, a bracket around each quantile (for few values a wider one).  The second counts the values
    between the brackets, and those inside by value, which places every rank exactly.  Both
    are aggregated map-side, whatever the values are.  Only where a bracket would hold more
    than ``small`` values (above ``small`` * ``bins`` / 4 rows), it is narrowed by a sketch
    of its own values before; the passes are ``MOST_PASSES`` at most.
    """
    bins, groups = max(bins, LEAST_BINS), [f"g{i}" for i in range(len(by))]
    keys = [*groups, "ordinal"]
    near, far = 2.0 / bins, 100.0 / bins
    sides = F.array(*[F.lit(min(1.0, max(0.0, float(p) + s))) for p in probs for s in (-far, -near, near, far)])
    value = lambda c: present(df, c).cast("double")
    found = aggregate_columns(
        df,
        list(columns),
        {
            **(measures or {}),
            "_n": lambda c: F.count(present(df, c)),
            "_lo": lambda c: F.min(value(c)),
            "_hi": lambda c: F.max(value(c)),
            "_q": lambda c: F.percentile_approx(value(c), sides, F.lit(bins)),
        },
        by,
    )
    names = ["column", *(measures or {})]
    totals = materialize(found.select(*[F.col(f"`{b}`").alias(g) for b, g in zip(by, groups)], "ordinal", *names, "_n", "_lo", "_hi", "_q"))
    # one row per input row and column; a null is dropped before anything moves
    long = df.select(
        *[F.col(f"`{b}`").alias(g) for b, g in zip(by, groups)],
        F.posexplode(F.array(*[value(c) for c in columns])).alias("ordinal", "v"),
    ).where(F.col("v").isNotNull())
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    spot = F.transform(wanted, lambda p: p * (F.col("_n") - 1))
    ranks = F.array_distinct(F.flatten(F.transform(spot, lambda s: F.array(F.floor(s).cast("long"), F.ceil(s).cast("long")))))
    # a bracket of four ranks at least on either side; beyond all values it ends at the least or the greatest of them
    edge = F.when(F.col("_n") >= 4 * bins, near).when(F.col("_n") >= bins / 25, far).otherwise(1.0)
    side = lambda i, inner, outer: F.element_at("_q", 4 * i + F.when(F.col("_n") >= 4 * bins, inner).otherwise(outer))
    low = F.transform(wanted, lambda p, i: F.when(p <= edge, F.col("_lo")).otherwise(side(i, 2, 1)))
    high = F.transform(wanted, lambda p, i: F.when(p >= 1 - edge, F.col("_hi")).otherwise(side(i, 3, 4)))
    brackets = F.transform(F.arrays_zip(low.alias("lo"), high.alias("hi")), lambda b: F.struct(b["lo"].alias("lo"), b["hi"].alias("hi")))
    state = totals.where("_n > 0").select(*keys, F.col("_n").alias("n"), ranks.alias("ranks"), brackets.alias("brackets"))
    largest = totals.agg(F.max("_n")).first()[0] or 0
    held, passes = 4 * largest / bins, 2
    while held > small and passes < MOST_PASSES:
        state = materialize(_narrowed(long, keys, state, bins))
        held, passes = held * 4 / GRID, passes + 1
    placed = materialize(_placed(long, keys, state, values=True))
    ends = _found(placed, keys, state)
    at = ends.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rnk", "v"))).alias("at"))
    at = at.select(*[F.col(k).alias(f"t_{k}") for k in keys], "at")
    same = [F.col(k).eqNullSafe(F.col(f"t_{k}")) for k in keys]

    def between(s: Column) -> Column:
        low, high = (F.element_at("at", f(s).cast("long")) for f in (F.floor, F.ceil))
        # between equal values nothing is added, so that infinite ones stay themselves
        return F.when(low == high, low).otherwise(low + (high - low) * (s - F.floor(s)))

    q = F.when(F.col("_n") > 0, F.transform(spot, between)).alias("q")
    return totals.join(at, same, "left").select(*[F.col(g).alias(b) for b, g in zip(by, groups)], "ordinal", *names, q)


def _placed(long: DataFrame, keys: Sequence[str], state: DataFrame, values: bool, grid: int = 0) -> DataFrame:
    """Counts of the values by slot, and of those inside a bracket by value, with the number of lesser values.

    The ends of a group's brackets cut the numbers into slots: 0 below the first end, 1 the
    first end itself, 2 above it, and so on.
    """
    cuts = F.array_sort(F.array_distinct(F.flatten(F.transform("brackets", lambda b: F.array(b["lo"], b["hi"])))))
    known = settle(state.select(*[F.col(k).alias(f"t_{k}") for k in keys], cuts.alias("cuts"), "brackets"))
    same = [F.col(k).eqNullSafe(F.col(f"t_{k}")) for k in keys]
    v = F.col("v")
    slot = F.size(F.filter("cuts", lambda c: c < v)) + F.size(F.filter("cuts", lambda c: c <= v))
    inside = F.exists("brackets", lambda b: (b["lo"] < v) & (v < b["hi"]))
    met = long.join(known, same).withColumns({"slot": slot, "inner": F.when(inside, v)})
    more = []
    if grid:
        more = [F.percentile_approx("inner", F.array(*[F.lit(k / grid) for k in range(grid + 1)]), F.lit(BINS)).alias("q"), F.min("inner").alias("lo"), F.max("inner").alias("hi")]
    by = [*keys, "slot", *["inner"] * values]
    if values:
        met = met.withColumn("cut", F.when(F.col("slot") % 2 == 1, F.get("cuts", F.floor(F.col("slot") / 2).cast("int"))))
        more = [F.first("cut").alias("cut")]
    counted = met.groupBy(*by).agg(F.count("*").alias("n"), *more)
    upto = Window.partitionBy(*keys).orderBy(*by[len(keys) :]).rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn("first", F.coalesce(F.sum("n").over(upto), F.lit(0)))


def _met(placed: DataFrame, keys: Sequence[str], state: DataFrame) -> DataFrame:
    """The counted parts that hold wanted ranks, with these."""
    other = state.select(*[F.col(k).alias(f"t_{k}") for k in keys], F.col("ranks").alias("all"))
    same = [F.col(k).eqNullSafe(F.col(f"t_{k}")) for k in keys]
    mine = F.filter("all", lambda r: (r >= F.col("first")) & (r < F.col("first") + F.col("n")))
    return placed.join(other, same).withColumn("mine", mine).where(F.size("mine") > 0).drop(*[f"t_{k}" for k in keys])


def _found(placed: DataFrame, keys: Sequence[str], state: DataFrame) -> DataFrame:
    """Rows ``(keys..., rnk, v)`` of all wanted ranks; one outside of all brackets is an error."""
    v = F.coalesce("cut", "inner", F.raise_error(F.lit("a quantile lies outside of its bracket")).cast("double"))
    return _met(placed, keys, state).select(*keys, F.explode("mine").alias("rnk"), v.alias("v"))


def _narrowed(long: DataFrame, keys: Sequence[str], state: DataFrame, bins: int) -> DataFrame:
    """The state with narrower brackets, from a sketch of the values in each slot."""
    met = _met(_placed(long, keys, state, values=False, grid=GRID), keys, state)
    place = lambda r: (r - F.col("first")) / F.greatest(F.col("n") - 1, F.lit(1)) * GRID
    low = lambda r: F.when(place(r) < 2, F.col("lo")).otherwise(F.element_at("q", F.floor(place(r)).cast("int")))
    high = lambda r: F.when(place(r) > GRID - 2, F.col("hi")).otherwise(F.element_at("q", F.ceil(place(r)).cast("int") + 2))
    # a rank on an end keeps that end: its slot holds one value
    cuts = F.array_sort(F.array_distinct(F.flatten(F.transform("brackets", lambda b: F.array(b["lo"], b["hi"])))))
    ends = state.select(*[F.col(k).alias(f"t_{k}") for k in keys], cuts.alias("cuts"))
    same = [F.col(k).eqNullSafe(F.col(f"t_{k}")) for k in keys]
    end = F.when(F.col("slot") % 2 == 1, F.get("cuts", F.floor(F.col("slot") / 2).cast("int")))
    new = met.join(ends, same).withColumn("end", end).select(
        *keys, F.transform("mine", lambda r: F.struct(F.coalesce("end", low(r)).alias("lo"), F.coalesce("end", high(r)).alias("hi"))).alias("some")
    )
    gathered = new.groupBy(*keys).agg(F.flatten(F.collect_list("some")).alias("some")).select(*[F.col(k).alias(f"t_{k}") for k in keys], "some")
    return state.join(gathered, same).select(*keys, "n", "ranks", F.col("some").alias("brackets"))
