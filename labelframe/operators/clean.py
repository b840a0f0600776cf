"""Label encoding, recoding and range rules."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelframe.functions.reshape import aggregate_columns, present
from labelframe.functions.small import local_table, settle
from labelframe.operators.profile import status_text

Rules = Mapping[str, tuple[float, float]]


def class_map(spark: SparkSession, names: Mapping[int, str]) -> DataFrame:
    """The two-column table ``(code, name)`` of a code to name mapping."""
    return local_table(spark, sorted(names.items()), "code long, name string")


def invert_class_map(mapping: DataFrame) -> DataFrame:
    """Rows ``(name, code)``; a name that stands for two codes is an error."""
    repeated = [r[0] for r in mapping.groupBy("name").count().where("count > 1").select("name").limit(10).collect()]
    if repeated:
        raise ValueError(f"names used for more than one code: {sorted(repeated)}")
    return mapping.select("name", "code")


def unknown_labels(df: DataFrame, label: str, mapping: DataFrame) -> DataFrame:
    """Distinct labels that the map does not hold."""
    seen = df.select(F.col(label).alias("name")).where(F.col("name").isNotNull()).distinct()
    return seen.join(mapping.select("name"), "name", "left_anti")


def require_known_labels(df: DataFrame, label: str, mapping: DataFrame) -> None:
    unknown = [r[0] for r in unknown_labels(df, label, mapping).orderBy("name").limit(20).collect()]
    if unknown:
        raise ValueError(f"labels not in the class map: {unknown}")


def encode_label(df: DataFrame, label: str, mapping: DataFrame, output: str | None = None) -> DataFrame:
    """Name to code; a label outside the map becomes null."""
    pairs = settle(mapping.select(F.col("name").alias("_name"), F.col("code").alias("_code")))
    joined = df.join(pairs, F.col(label) == F.col("_name"), "left").drop("_name")
    return joined.withColumn(output or label, F.col("_code")).drop("_code")


def decode_label(df: DataFrame, label: str, mapping: DataFrame, output: str) -> DataFrame:
    """Code to name."""
    pairs = settle(mapping.select(F.col("code").alias("_code"), F.col("name").alias("_name")))
    joined = df.join(pairs, F.col(label) == F.col("_code"), "left").drop("_code")
    return joined.withColumn(output, F.col("_name")).drop("_name")


def recode(df: DataFrame, column: str, old, new) -> DataFrame:
    return df.withColumn(column, F.when(F.col(column) == F.lit(old), F.lit(new)).otherwise(F.col(column)))


def _outside(df: DataFrame, column: str, lo: float, hi: float) -> Column:
    col = present(df, column)
    return (col < F.lit(lo)) | (col > F.lit(hi))


def audit_ranges(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows outside ``[lo, hi]`` for each rule, and a last row with their sum.

    The sum counts a row once for each rule it breaks.
    """
    counts = aggregate_columns(df, list(rules), {"invalid": lambda c: F.count_if(_outside(df, c, *rules[c]))})
    lo = F.create_map(*[x for c, (low, _) in rules.items() for x in (F.lit(c), F.lit(float(low)))])
    hi = F.create_map(*[x for c, (_, high) in rules.items() for x in (F.lit(c), F.lit(float(high)))])
    per_rule = counts.select(
        "ordinal",
        "column",
        F.element_at(lo, F.col("column")).alias("lo"),
        F.element_at(hi, F.col("column")).alias("hi"),
        "invalid",
    )
    total = aggregate_total(counts, len(rules))
    return per_rule.unionByName(total).withColumn("status", status_text("invalid", "invalid"))


def aggregate_total(counts: DataFrame, position: int) -> DataFrame:
    return counts.agg(F.sum("invalid").alias("invalid")).select(
        F.lit(position).alias("ordinal"),
        F.lit("TOTAL").alias("column"),
        F.lit(None).cast("double").alias("lo"),
        F.lit(None).cast("double").alias("hi"),
        "invalid",
    )


def drop_impossible(df: DataFrame, rules: Rules) -> DataFrame:
    """Keep the rows that break no rule; a missing value breaks none."""
    kept = df
    for column, (lo, hi) in rules.items():
        kept = kept.where(~F.coalesce(_outside(df, column, lo, hi), F.lit(False)))
    return kept
