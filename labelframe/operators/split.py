"""Exact stratified train / test split without moving the table."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelframe.functions.checkpoints import materialize
from labelframe.functions.classes import MAX_CLASSES, require_unique
from labelframe.functions.hashing import draw_hex
from labelframe.functions.small import local_table

PURPOSE = "split"
DIGITS = 3


def allocate(counts: Mapping, fraction: float) -> dict:
    """Test rows per class: floors first, then the largest fractional parts.

    The whole test set gets ``ceil(fraction * total)`` rows; equal fractional parts
    go to the smaller label.
    """
    given = {c: math.floor(round(fraction * n, 9)) for c, n in counts.items()}
    part = {c: round(fraction * n - given[c], 9) for c, n in counts.items()}
    rest = math.ceil(round(fraction * sum(counts.values()), 9)) - sum(given.values())
    for c in sorted(counts, key=lambda c: (-part[c], c))[:rest]:
        given[c] += 1
    return given


def bucket_counts(hashed: DataFrame, depth: int) -> DataFrame:
    """Rows per class and leading hex digits of the digest: ``(label, b, n)``."""
    return hashed.groupBy("label", F.substring("h", 1, depth).alias("b")).agg(F.count("*").alias("n"))


def cut_points(hashed: DataFrame, buckets: DataFrame, wanted: Mapping, small: int = 100_000) -> dict:
    """Per class, the (digest, id) of the wanted-th row in digest order.

    ``buckets`` counts rows by class and the first three hex digits of their digest;
    the digits that hold the cut are split by three more, until at most ``small`` rows
    are left to sort.  No pass sorts or shuffles the rows of a class.
    """
    open_, ready, depth = {c: n for c, n in wanted.items() if n > 0}, {}, DIGITS
    while open_:
        before = Window.partitionBy("label").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
        hit = (
            buckets.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
            .join(_lookup(hashed, open_, "k long"), "label")
            .where((F.col("start") < F.col("k")) & (F.col("k") <= F.col("start") + F.col("n")))
        ).collect()
        found = {r["label"]: (r["b"], r["k"] - r["start"]) for r in hit}
        ready.update({r["label"]: found[r["label"]] for r in hit if r["n"] <= small or depth >= 30})
        rest = {c: s for c, s in found.items() if c not in ready}
        open_ = {c: k for c, (_, k) in rest.items()}
        depth += DIGITS
        if rest:
            buckets = bucket_counts(_under(hashed, {c: b for c, (b, _) in rest.items()}), depth)
    if not ready:
        return {}
    last = _under(hashed, {c: b for c, (b, _) in ready.items()})
    rank = F.row_number().over(Window.partitionBy("label").orderBy("h", "id"))
    need = _lookup(hashed, {c: k for c, (_, k) in ready.items()}, "k long")
    cut = last.withColumn("rank", rank).join(need, "label").where(F.col("rank") == F.col("k"))
    return {r["label"]: (r["h"], r["id"]) for r in cut.select("label", "h", "id").collect()}


def _under(hashed: DataFrame, prefixes: Mapping) -> DataFrame:
    """Rows whose digest starts with the digits chosen for their class."""
    table = _lookup(hashed, prefixes, "prefix string")
    return hashed.join(table, "label").where(F.col("h").startswith(F.col("prefix"))).drop("prefix")


def _lookup(hashed: DataFrame, values: Mapping, column: str) -> DataFrame:
    """A value per class; there are at most ``MAX_CLASSES`` of them."""
    kind = hashed.schema["label"].dataType.simpleString()
    return F.broadcast(local_table(hashed.sparkSession, list(values.items()), f"label {kind}, {column}"))


def stratified_split(
    df: DataFrame,
    label: str,
    row_id: str,
    test_fraction: float = 0.2,
    seed: int = 42,
    output: str = "split",
    small: int = 100_000,
) -> DataFrame:
    """Add a column 'train' / 'test' with exact class proportions.

    Within a class the rows with the smallest digests are test rows.  Only class
    counts and one cut per class reach the driver; rows are then marked by a
    map-only comparison, so the wide table is never shuffled.  Ids must be unique, since
    rows that share one could not be parted by the cut.
    """
    require_unique(df, row_id)
    hashed = df.select(
        F.col(label).alias("label"), F.col(row_id).alias("id"), draw_hex(seed, PURPOSE, F.col(row_id)).alias("h")
    )
    buckets = materialize(bucket_counts(hashed, DIGITS))
    counted = buckets.groupBy("label").agg(F.sum("n").alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(counted) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes; it is not a class label")
    counts = {r["label"]: r["n"] for r in counted if r["label"] is not None}
    if len(counts) < len(counted):
        raise ValueError(f"{label} has missing values; every row needs a class")
    wanted = allocate(counts, test_fraction)
    cuts = cut_points(hashed, buckets, wanted, small)
    kinds = [df.schema[label].dataType.simpleString(), df.schema[row_id].dataType.simpleString()]
    rows = [(c, h, i) for c, (h, i) in cuts.items()]
    table = local_table(df.sparkSession, rows, f"_label {kinds[0]}, _cut string, _cut_id {kinds[1]}")
    # one comparison of pairs, so that the digest is computed once per row
    own = F.struct(draw_hex(seed, PURPOSE, F.col(row_id)).alias("h"), F.col(row_id).alias("i"))
    cut = F.struct(F.col("_cut").alias("h"), F.col("_cut_id").alias("i"))
    is_test = F.col("_cut").isNotNull() & (own <= cut)
    return (
        df.join(F.broadcast(table), F.col(label) == F.col("_label"), "left")
        .withColumn(output, F.when(is_test, "test").otherwise("train"))
        .drop("_label", "_cut", "_cut_id")
    )
