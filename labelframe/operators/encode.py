"""One-hot encoding and scaling, fitted on training rows only."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelframe.functions.reshape import aggregate_columns, is_missing, present, quoted, ranked
from labelframe.functions.small import local_table, settle

MAX_CATEGORIES = 10_000


def fit_one_hot(df: DataFrame, column: str) -> DataFrame:
    """Parameter table ``(ordinal, category)``: all sorted categories seen in ``df``."""
    seen = df.where(~is_missing(df, column)).select(F.col(column).alias("category")).distinct()
    return ranked(seen, "category", "ordinal")


def categories(params: DataFrame, max_categories: int = MAX_CATEGORIES) -> list:
    """The ordered categories on the driver; more than can be columns are refused, see ``one_hot_vector`` for these."""
    rows = params.orderBy("ordinal").limit(max_categories + 1).collect()
    if len(rows) > max_categories:
        raise ValueError(f"more than {max_categories} categories; one column for each is not useful")
    return [r["category"] for r in rows]


def one_hot(df: DataFrame, column: str, cats: Sequence, prefix: str | None = None, keep: bool = False) -> DataFrame:
    """One double column per category, named ``prefix_category``, in order.

    A category that was not seen when fitting gets zeros everywhere.
    """
    prefix = prefix or column
    indicators = [
        F.when(F.col(column) == F.lit(c), 1.0).otherwise(0.0).alias(f"{prefix}_{c}") for c in cats
    ]
    others = [F.col(f"`{c}`") for c in df.columns if keep or c != column]
    return df.select(*others, *indicators)


def one_hot_vector(
    df: DataFrame, fitted: Mapping[str, DataFrame], output: str = "features", dense: Sequence[str] = ()
) -> DataFrame:
    """Add one sparse vector: the ``dense`` columns, then the indicators of each fitted column.

    ``fitted`` gives each categorical column its table of ``fit_one_hot``, of any length: a
    category finds its ordinal by a join, broadcast only if the table is small.  A category
    that was not seen, or a missing one, has zeros.  A missing dense value is an error when
    the vector is made.  Models take the column as it is.
    """
    out, hot = df, []
    for i, (column, params) in enumerate(fitted.items()):
        size = params.count()
        if not size:
            continue
        known = settle(params.select(F.col("ordinal").alias(f"_at{i}"), F.col("category").alias(f"_category{i}")))
        out = out.join(known, out[column] == known[f"_category{i}"], "left").drop(f"_category{i}")
        out = out.withColumn(f"_at{i}", F.coalesce(f"_at{i}", F.lit(size)).cast("double"))
        # the encoder learns its size from the greatest index; the one above it means "none of them"
        encoder = OneHotEncoder(inputCol=f"_at{i}", outputCol=f"_hot{i}", handleInvalid="keep", dropLast=True)
        out = encoder.fit(local_table(df.sparkSession, [(float(size - 1),)], f"_at{i} double")).transform(out).drop(f"_at{i}")
        hot.append(f"_hot{i}")
    numbers = {f"_dense{i}": F.col(f"`{c}`").cast("double") for i, c in enumerate(dense)}
    out = VectorAssembler(inputCols=[*numbers, *hot], outputCol=output, handleInvalid="error").transform(out.withColumns(numbers))
    return out.drop(*numbers, *hot)


def vector_entries(df: DataFrame, column: str, keep: Sequence[str]) -> DataFrame:
    """Rows ``(keep..., index, value)`` of the entries of a vector column that are not zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = {f: batch.column(len(keep)).field(f) for f in ("type", "indices", "values")}
            places, values, row = [], [], []
            for i, (kind, indices, entries) in enumerate(zip(*(parts[f].to_pylist() for f in ("type", "indices", "values")))):
                used = [(k, v) for k, v in (zip(indices, entries) if kind == 0 else enumerate(entries or [])) if v]
                places += [k for k, _ in used]
                values += [v for _, v in used]
                row += [i] * len(used)
            taken = [batch.column(k).take(pa.array(row, pa.int64())) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*taken, pa.array(places, pa.int32()), pa.array(values, pa.float64())], names=[*keep, "index", "value"])

    plain = df.select(*[F.col(f"`{c}`") for c in keep], F.col(column))
    kinds = ", ".join(f"{quoted(c)} {df.schema[c].dataType.simpleString()}" for c in keep)
    return plain.mapInArrow(run, f"{kinds}, index int, value double")


def inverse_one_hot(df: DataFrame, columns: Sequence[str], output: str) -> DataFrame:
    """Trailing digits of the name of the largest indicator; the first one wins ties."""
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in columns])
    names = F.array(*[F.lit(c) for c in columns])
    winner = F.element_at(names, F.array_position(values, F.array_max(values)).cast("int"))
    digits = F.regexp_extract(winner, r"(\d+)$", 1)
    return df.withColumn(output, F.nullif(digits, F.lit("")).cast("long"))


def align_rows(parts: Sequence[DataFrame], row_id: str) -> DataFrame:
    """Columns of several tables side by side, matched on the row key.

    A key that one table lacks stays, with nulls, so that a check for missing values
    finds it.  Tables already partitioned by the key are joined without a shuffle.
    """
    return reduce(lambda a, b: a.join(b, row_id, "full_outer"), parts)


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows ``(ordinal, column, mean, std)`` with the population deviation."""
    return aggregate_columns(
        df,
        columns,
        {
            "mean": lambda c: F.avg(present(df, c)),
            "std": lambda c: F.stddev_pop(present(df, c)),
        },
    )


def apply_scaler(df: DataFrame, params: DataFrame) -> DataFrame:
    """(x - mean) / std on the fitted columns; all others pass through.

    The parameters, one row per column, become literals of a map-only projection.  A
    column without spread is only centred.
    """
    fitted = {r["column"]: (r["mean"], r["std"]) for r in params.collect()}

    def scaled(name: str):
        if name not in fitted:
            return F.col(f"`{name}`")
        mean, std = fitted[name]
        if mean is None:
            return F.col(f"`{name}`").cast("double").alias(name)
        return ((F.col(f"`{name}`") - F.lit(mean)) / F.lit(std or 1.0)).alias(name)

    return df.select(*[scaled(c) for c in df.columns])
