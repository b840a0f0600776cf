"""Small tables that live on the driver, a size check before a broadcast, and joins without one."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

MAX_ROWS = 100_000


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Rows as a literal table, whose size the optimizer knows."""
    struct = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)
    columns = list(zip(*rows)) if rows else [[] for _ in arrow]
    plain = [[list(v.items()) if isinstance(v, dict) else v for v in c] for c in columns]
    arrays = [pa.array(c, type=f.type) for c, f in zip(plain, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema=struct)


def settle(df: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Broadcast a table of parameters once it is known to be small.

    At most ``max_rows + 1`` rows are fetched.  A table within the bound comes back
    as a literal, broadcast table; a larger one is returned as it is, for a shuffled
    join that adaptive execution may split on hot keys.
    """
    found = df.limit(max_rows + 1).toArrow()
    if found.num_rows > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(found, schema=df.schema))


def large(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the input: both sides are shuffled.

    Left to its size, such a table would be broadcast while it is below Spark's threshold,
    and go through the driver each time.
    """
    return df.hint("merge")
