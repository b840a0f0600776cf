"""Arithmetic feature formulas as column expressions.  Nothing here is fitted."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def circular(angle: Column) -> tuple[Column, Column]:
    """Sine and cosine of an angle in degrees."""
    return F.sin(F.radians(angle)), F.cos(F.radians(angle))


def euclidean(a: Column, b: Column) -> Column:
    return F.hypot(a.cast("double"), b.cast("double"))


def difference(a: Column, b: Column) -> Column:
    return a.cast("double") - b


def row_mean(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, [c.cast("double") for c in columns]) / len(columns)


def product(a: Column, b: Column) -> Column:
    return a.cast("double") * b


def ratio(a: Column, b: Column, offset: float = 1.0) -> Column:
    """a / (b + offset); the offset keeps a zero distance from dividing by zero."""
    return a.cast("double") / F.nullif(b + F.lit(float(offset)), F.lit(0.0))


def add_features(df: DataFrame, formulas: Mapping[str, Column], drop: Sequence[str] = ()) -> DataFrame:
    """Add every formula in one projection and drop the columns they replace.

    Formulas see the input columns only, so train and test are treated alike.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in drop and c not in formulas]
    return df.select(*kept, *[expr.alias(name) for name, expr in formulas.items()])
