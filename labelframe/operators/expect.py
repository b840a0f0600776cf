"""Expectations: checks on tables as rows (check, passed, observed, expected)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from labelframe.functions.reshape import is_missing
from labelframe.functions.small import local_table
from labelframe.operators.profile import compare_distributions

SCHEMA = "check string, passed boolean, observed string, expected string"


class ExpectationError(AssertionError):
    """Raised by :func:`require` with the checks that failed."""


def _known(spark: SparkSession, check: str, passed: bool, observed, expected) -> DataFrame:
    return local_table(spark, [(check, bool(passed), str(observed), str(expected))], SCHEMA)


def has_columns(df: DataFrame, columns: Sequence[str], check: str = "required columns") -> DataFrame:
    absent = sorted(set(columns) - set(df.columns))
    return _known(df.sparkSession, check, not absent, f"missing {absent}", "missing []")


def same_columns(left: DataFrame, right: DataFrame, check: str = "same columns in the same order") -> DataFrame:
    return _known(left.sparkSession, check, left.columns == right.columns, right.columns, left.columns)


def retains(kept: Sequence[str], wanted: Sequence[str], spark: SparkSession, check: str = "columns kept") -> DataFrame:
    lost = [c for c in wanted if c not in kept]
    return _known(spark, check, not lost, f"lost {lost}", "lost []")


def column_count(df: DataFrame, expected: int, check: str = "column count") -> DataFrame:
    return _known(df.sparkSession, check, len(df.columns) == expected, len(df.columns), expected)


@dataclass(frozen=True)
class Check:
    """One aggregate of a table, and what it must be."""

    name: str
    measure: Column
    passes: Callable[[Column], Column]
    shows: Callable[[Column], Column]
    expected: str


def missing_check(df: DataFrame, columns: Sequence[str] | None = None, check: str = "no missing values") -> Check:
    each = reduce(lambda a, b: a + b, [F.count_if(is_missing(df, c)) for c in columns or df.columns])
    return Check(check, each, lambda n: n == 0, lambda n: n.cast("string"), "0")


def range_check(column: str, lo, hi, check: str | None = None) -> Check:
    inside = F.coalesce(F.col(column).between(lo, hi), F.lit(False))
    shown = lambda n: F.concat(n.cast("string"), F.lit(" outside"))
    return Check(check or f"{column} in range", F.count_if(~inside), lambda n: n == 0, shown, f"[{lo}, {hi}]")


def count_check(expected: int, check: str = "row count") -> Check:
    return Check(check, F.count("*"), lambda n: n == expected, lambda n: n.cast("string"), str(expected))


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All checks of one table from one aggregate, a row for each."""
    return _verdicts(df.agg(*[c.measure.alias(f"m{i}") for i, c in enumerate(checks)]), checks)


def _verdicts(measured: DataFrame, checks: Sequence[Check]) -> DataFrame:
    rows = []
    for i, c in enumerate(checks):
        value = F.col(f"m{i}")
        parts = {"check": F.lit(c.name), "passed": c.passes(value), "observed": c.shows(value), "expected": F.lit(c.expected)}
        rows.append(F.struct(*[v.alias(n) for n, v in parts.items()]))
    return measured.select(F.inline(F.array(*rows)))


def write_checked(df: DataFrame, path: str, checks: Sequence[Check], **options) -> DataFrame:
    """Write a Parquet table with checks that ride on the write itself; the rows of the checks.

    The table is read once.  If a check fails the written files are deleted and
    :class:`ExpectationError` is raised; an existing table at ``path`` is an error.
    """
    spark, seen = df.sparkSession, Observation()
    df.observe(seen, *[c.measure.alias(f"m{i}") for i, c in enumerate(checks)]).write.options(**options).parquet(path)
    found = [seen.get[f"m{i}"] for i in range(len(checks))]
    verdicts = _verdicts(local_table(spark, [tuple(found)], ", ".join(f"m{i} long" for i in range(len(checks)))), checks)
    try:
        require(verdicts)
    except ExpectationError:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        raise
    return verdicts


def no_missing(df: DataFrame, columns: Sequence[str] | None = None, check: str = "no missing values") -> DataFrame:
    return run_checks(df, [missing_check(df, columns, check)])


def in_range(df: DataFrame, column: str, lo, hi, check: str | None = None) -> DataFrame:
    """Every value lies in [lo, hi]; a missing value fails."""
    return run_checks(df, [range_check(column, lo, hi, check)])


def row_count(df: DataFrame, expected: int, check: str = "row count") -> DataFrame:
    return run_checks(df, [count_check(expected, check)])


def class_targets_met(
    before: DataFrame, after: DataFrame, label: str, targets: Mapping, check: str = "class"
) -> DataFrame:
    """One row per class: targets reached, all other classes unchanged."""
    spark = before.sparkSession
    kind = before.schema[label].dataType.simpleString()
    goal = local_table(spark, [(c, int(n)) for c, n in targets.items()], f"class {kind}, target long")
    compared = compare_distributions(before, after, label).join(F.broadcast(goal), "class", "left")
    wanted = F.coalesce(F.col("target"), F.col("n_before"))
    return compared.select(
        F.concat(F.lit(f"{check} "), F.col("class").cast("string")).alias("check"),
        (F.col("n_after") == wanted).alias("passed"),
        F.col("n_after").cast("string").alias("observed"),
        wanted.cast("string").alias("expected"),
    )


def metric_above(metrics: DataFrame, metric: str, floor: float, name: str = "model") -> DataFrame:
    """One row per metrics row: the metric is strictly above a floor."""
    return metrics.select(
        F.concat(F.col(name).cast("string"), F.lit(f" {metric}")).alias("check"),
        (F.col(metric) > floor).alias("passed"),
        F.format_string("%.4f", F.col(metric)).alias("observed"),
        F.lit(f"> {floor}").alias("expected"),
    )


def all_checks(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def require(*checks: DataFrame, show: int = 50) -> None:
    """Raise when any check fails; the message lists up to ``show`` of them."""
    failed = all_checks(*checks).where(~F.coalesce(F.col("passed"), F.lit(False))).limit(show).collect()
    if failed:
        lines = [f"{r['check']}: observed {r['observed']}, expected {r['expected']}" for r in failed]
        raise ExpectationError("; ".join(lines))
