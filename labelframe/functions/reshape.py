"""Missing values and wide-to-long helpers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelframe.functions.checkpoints import materialize
from labelframe.functions.small import local_table

FLOATING = (T.FloatType, T.DoubleType)


def quoted(name: str) -> str:
    """A column name inside a SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """A string literal inside a SQL expression."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def is_missing(df: DataFrame, name: str) -> Column:
    """True for null and, in floating columns, for NaN."""
    if isinstance(df.schema[name].dataType, FLOATING):
        return F.expr(f"{quoted(name)} IS NULL OR isnan({quoted(name)})")
    return F.expr(f"{quoted(name)} IS NULL")


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into null, so that aggregates skip it."""
    if isinstance(df.schema[name].dataType, FLOATING):
        return F.expr(f"CASE WHEN NOT isnan({quoted(name)}) THEN {quoted(name)} END")
    return F.expr(quoted(name))


def vector(features: Sequence[str] | str) -> Column:
    """Array of doubles from an array column or a list of numeric columns."""
    if isinstance(features, str):
        return F.col(features).cast("array<double>")
    return F.expr(f"array({', '.join(f'CAST({quoted(c)} AS DOUBLE)' for c in features)})")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def aggregate_columns(
    df: DataFrame,
    columns: Sequence[str],
    measures: Mapping[str, Callable[[str], Column]],
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per (group, column) holding every measure, from a single aggregation.

    The table is read once however many columns and measures there are, and only
    one row per group is shuffled.
    """
    exprs = [
        fn(name).alias(f"{i}_{measure}")
        for i, name in enumerate(columns)
        for measure, fn in measures.items()
    ]
    wide = df.groupBy(*by).agg(*exprs)
    # one expression text: a wide table would need thousands of calls to the JVM otherwise
    rows = [
        f"named_struct('ordinal', {i}, 'column', {text(name)}, "
        + ", ".join(f"'{measure}', `{i}_{measure}`" for measure in measures)
        + ")"
        for i, name in enumerate(columns)
    ]
    return wide.select(*by, F.expr(f"inline(array({', '.join(rows)}))"))


def ranked(df: DataFrame, by: str, output: str) -> DataFrame:
    """Number the rows 0, 1, ... in the order of a column of distinct values.

    The rows are sorted into ranges, numbered inside each range and moved up by the
    sizes of the ranges before; no task sees more than a range.
    """
    sorted_ = materialize(df.orderBy(by).withColumn("_range", F.spark_partition_id()))
    sizes = sorted_.groupBy("_range").agg(F.count("*").alias("n")).orderBy("_range").collect()
    starts, total = [], 0
    for r in sizes:
        starts.append((r["_range"], total))
        total += r["n"]
    table = local_table(df.sparkSession, starts, "_range int, _start long")
    inner = F.row_number().over(Window.partitionBy("_range").orderBy(by)) - 1
    numbered = sorted_.withColumn("_rank", inner).join(F.broadcast(table), "_range")
    return numbered.select((F.col("_start") + F.col("_rank")).cast("int").alias(output), *df.columns)
