"""First look at a table: shape, summaries, value counts, class balance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelframe.functions.reshape import aggregate_columns, is_missing, numeric_columns, present
from labelframe.functions.small import local_table
from labelframe.operators.quantiles import summaries


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("long"))


def head(df: DataFrame, key: Sequence[str], n: int = 5) -> DataFrame:
    """First n rows by key; a bounded top-n, not a sort of the table."""
    return df.orderBy(*[F.col(k).asc() for k in key]).limit(n)


def tail(df: DataFrame, key: Sequence[str], n: int = 5) -> DataFrame:
    """Last n rows by key, latest first."""
    return df.orderBy(*[F.col(k).desc() for k in key]).limit(n)


def describe(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """count, mean, sample std, min, quartiles and max of each numeric column."""
    columns = list(columns or numeric_columns(df))
    measures = {
        "count": lambda c: F.count(present(df, c)),
        "mean": lambda c: F.avg(present(df, c)),
        "std": lambda c: F.stddev_samp(present(df, c)),
        "min": lambda c: F.min(present(df, c)).cast("double"),
        "max": lambda c: F.max(present(df, c)).cast("double"),
    }
    quarters = [0.25, 0.5, 0.75]
    if approx:
        wanted = F.array(*[F.lit(p) for p in quarters])
        found = aggregate_columns(df, columns, {**measures, "q": lambda c: F.percentile_approx(present(df, c).cast("double"), wanted)})
    else:
        found = summaries(df, columns, quarters, measures=measures)
    return found.select(
        "ordinal", "column", "count", "mean", "std", "min",
        *[F.col("q")[i].alias(n) for i, n in enumerate(("q25", "q50", "q75"))], "max",
    )


def column_info(df: DataFrame) -> DataFrame:
    """Type and non-missing count of each column."""
    types = dict(df.dtypes)
    return aggregate_columns(
        df,
        df.columns,
        {"dtype": lambda c: F.first(F.lit(types[c])), "non_null": lambda c: F.count_if(~is_missing(df, c))},
    )


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null or NaN rows of each column, in one pass."""
    return aggregate_columns(
        df, columns or df.columns, {"n_missing": lambda c: F.count_if(is_missing(df, c))}
    )


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None, max_repeated: int = 100_000) -> DataFrame:
    """Rows that repeat an earlier row, i.e. copies after the first.

    Only a hash of each row is shuffled at first.  Rows whose hash occurs once cannot
    be copies; the others are compared in full.  With more than ``max_repeated``
    repeated hashes the whole rows are grouped at once.
    """
    names = list(columns or df.columns)
    rows = df.select(*names)
    hashed = rows.withColumn("_hash", F.xxhash64(*names))
    repeated = hashed.groupBy("_hash").agg(F.count("*").alias("_n")).where("_n > 1").select("_hash")
    few = repeated.limit(max_repeated + 1).toArrow()
    if few.num_rows <= max_repeated:
        known = F.broadcast(df.sparkSession.createDataFrame(few, schema=repeated.schema))
        rows = hashed.join(known, "_hash", "left_semi").drop("_hash")
    copies = rows.groupBy(*names).agg(F.count("*").alias("n"))
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return (
        df.where(~is_missing(df, column))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n"))
        .orderBy("value")
    )


def balance_ratio(df: DataFrame, label: str) -> DataFrame:
    """Largest class count over smallest."""
    return value_counts(df, label).agg(
        F.max("n").alias("largest"),
        F.min("n").alias("smallest"),
        (F.max("n") / F.min("n")).alias("ratio"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values, sorted, as rows."""
    return df.where(~is_missing(df, column)).select(F.col(column).alias("value")).distinct().orderBy("value")


def distinct_counts(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct values of each column.

    One exact distinct count expands every row once per column, so each column is
    counted by its own partial distinct and the results are put together.
    """
    if approx:
        return aggregate_columns(
            df, columns, {"n_distinct": lambda c: F.approx_count_distinct(present(df, c))}
        )
    parts = [
        df.select(present(df, c).alias("v"))
        .distinct()
        .agg(F.count("v").alias("n_distinct"))
        .select(F.lit(i).alias("ordinal"), F.lit(c).alias("column"), "n_distinct")
        for i, c in enumerate(columns)
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def value_ranges(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or numeric_columns(df))
    return aggregate_columns(
        df,
        columns,
        {
            "min": lambda c: F.min(present(df, c)).cast("double"),
            "max": lambda c: F.max(present(df, c)).cast("double"),
        },
    )


def negative_audit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Negative values of columns that should have none, with a status text."""
    counts = aggregate_columns(df, columns, {"n_negative": lambda c: F.count_if(present(df, c) < 0)})
    return counts.withColumn("status", status_text("n_negative", "negatives"))


def status_text(count: str, what: str) -> Column:
    n = F.col(count)
    return F.when(n == 0, F.lit("CLEAN")).otherwise(F.concat(n.cast("string"), F.lit(f" {what}")))


def count_equal(df: DataFrame, column: str, value) -> DataFrame:
    return df.agg(F.count_if(F.col(column) == F.lit(value)).alias("n"))


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows ``(class, count, pct)``."""
    counts = df.groupBy(F.col(label).alias("class")).agg(F.count("*").alias("count"))
    return with_share(counts, "count", "pct")


def with_share(counts: DataFrame, count: str, share: str) -> DataFrame:
    """Add each row's percentage of the total of a small table of counts."""
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn(share, F.col(count) / total * 100)


def compare_distributions(before: DataFrame, after: DataFrame, label: str) -> DataFrame:
    """Class counts of two tables side by side, with the rows added."""
    b = before.groupBy(F.col(label).alias("class")).agg(F.count("*").alias("n_before"))
    a = class_distribution(after, label).select("class", F.col("count").alias("n_after"), F.col("pct").alias("pct_after"))
    both = b.join(a, "class", "full_outer").na.fill(0, ["n_before", "n_after"]).na.fill(0.0, ["pct_after"])
    return both.withColumn("added", F.col("n_after") - F.col("n_before")).withColumn(
        "status", F.when(F.col("added") == 0, "unchanged").otherwise("resampled")
    )


def split_distribution(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Train and test counts per class, each with its percentage of the split."""
    per_class = df.groupBy(F.col(label).alias("class")).agg(
        F.count_if(F.col(split) == "train").alias("train"),
        F.count_if(F.col(split) == "test").alias("test"),
    )
    n_train = per_class.agg(F.nullif(F.sum("train"), F.lit(0))).scalar()
    n_test = per_class.agg(F.nullif(F.sum("test"), F.lit(0))).scalar()
    return per_class.withColumn("train_pct", F.col("train") / n_train * 100).withColumn(
        "test_pct", F.col("test") / n_test * 100
    )


def minority_flags(df: DataFrame, label: str, threshold: int) -> DataFrame:
    """Class counts with a flag on the classes that hold fewer than ``threshold`` rows."""
    return value_counts(df, label).select(
        F.col("value").alias("class"),
        F.col("n").alias("count"),
        (F.col("n") < threshold).alias("is_minority"),
    )


def name_classes(counts: DataFrame, names: Mapping[int, str], column: str = "class") -> DataFrame:
    """Add the class name from a small map of code to name."""
    spark = counts.sparkSession
    pairs = local_table(spark, list(names.items()), "code long, class_name string")
    return counts.join(F.broadcast(pairs), counts[column] == pairs["code"], "left").drop("code")
