"""CSV and Parquet tables, and the check that a written table reads back the same."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from labelframe.functions.reshape import is_missing
from labelframe.functions.small import local_table
from labelframe.operators.expect import SCHEMA


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header.  The schema is given, so no pass over the file infers it."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def save_columns(spark: SparkSession, columns: Sequence[str], path: str) -> None:
    """An ordered column list as a table ``(ordinal, name)``."""
    rows = list(enumerate(columns))
    local_table(spark, rows, "ordinal int, name string").coalesce(1).write.mode("overwrite").parquet(path)


def load_columns(spark: SparkSession, path: str) -> list[str]:
    return [r["name"] for r in spark.read.parquet(path).orderBy("ordinal").collect()]


def align(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The saved columns in the saved order."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def signature(inputs: StructType, output: str, output_type: str) -> list[tuple[str, str, str]]:
    """Input and output columns of a model as rows ``(name, type, role)``."""
    rows = [(f.name, f.dataType.simpleString(), "input") for f in inputs.fields]
    return [*rows, (output, output_type, "output")]


def _facts(df: DataFrame, digest: Column | None):
    """Row count, missing values and the sum of a digest of each row, in one pass."""
    missing = sum((F.count_if(is_missing(df, c)) for c in df.columns), F.lit(0))
    own = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]) if digest is None else digest
    return df.agg(F.count("*").alias("n"), missing.alias("missing"), F.sum(own.cast("decimal(38,0)")).alias("digest")).first()


def round_trip(df: DataFrame, path: str, fmt: str = "parquet", digest: Column | None = None) -> DataFrame:
    """Write the table, read it back and compare: one row per check.

    ``digest`` is a number for each row, whose sum stands for the values; the default is
    a hash of all columns.
    """
    spark = df.sparkSession
    if fmt == "csv":
        write_csv(df, path)
        back = read_csv(spark, path, df.schema)
    elif fmt == "parquet":
        write_parquet(df, path)
        back = read_parquet(spark, path)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    before, after = _facts(df, digest), _facts(back, digest)
    rows = [
        ("columns in order", back.columns == df.columns, ",".join(back.columns), ",".join(df.columns)),
        ("rows", after["n"] == before["n"], str(after["n"]), str(before["n"])),
        ("missing values", after["missing"] == before["missing"], str(after["missing"]), str(before["missing"])),
        ("values", after["digest"] == before["digest"], str(after["digest"]), str(before["digest"])),
    ]
    return local_table(spark, rows, SCHEMA)
