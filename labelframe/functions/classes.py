"""The classes of a label: few, known, and the same bound everywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_CLASSES = 10_000


def class_counts(df: DataFrame, label: str, max_classes: int = MAX_CLASSES) -> dict:
    """Rows of each class, in the order of the labels; a missing label counts under None.

    A column with more than ``max_classes`` values is no class label and is refused.
    """
    rows = df.groupBy(F.col(label).alias("c")).agg(F.count("*").alias("n")).limit(max_classes + 1).collect()
    if len(rows) > max_classes:
        raise ValueError(f"{label} has more than {max_classes} classes; it is not a class label")
    found = {r["c"]: r["n"] for r in rows}
    return {c: found[c] for c in sorted(found, key=lambda c: (c is None, c))}


def class_list(df: DataFrame, label: str, max_classes: int = MAX_CLASSES) -> list:
    """The classes in order, without the missing label."""
    return [c for c in class_counts(df, label, max_classes) if c is not None]


def require_unique(df: DataFrame, row_id: str, what: str = "rows") -> None:
    """Refuse a table in which an id stands for several rows; only ids are shuffled."""
    repeated = df.groupBy(F.col(row_id).alias("id")).count().where("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"{row_id} {repeated[0]['id']!r} stands for {repeated[0]['count']} {what}; ids must be unique")
