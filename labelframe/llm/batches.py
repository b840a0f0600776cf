"""Bounded Arrow batches, so that long texts do not pile up between Spark and Python."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from labelframe.functions.memory import give_back
from labelframe.llm.words import forget_others

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MOST_ROWS = 2000
MOST_BYTES = "8m"


def bounded(df: DataFrame) -> DataFrame:
    """``df`` itself, after the session's batches are set to 2,000 rows and 8 MB at most.

    A plan reads these settings when it runs, so they stay set; a smaller number of
    rows that the user has chosen is left alone.
    """
    conf = df.sparkSession.conf
    rows = int(conf.get(ROWS, "10000"))
    if rows <= 0 or rows > MOST_ROWS:
        conf.set(ROWS, str(MOST_ROWS))
    conf.set(BYTES, MOST_BYTES)
    return df


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keeps: str | None = None) -> Callable:
    """``run`` for mapInArrow, whose worker holds no freed memory between its tasks.

    Workers outlive a task, and those of several stages share an executor; so the large
    state of another operator than ``keeps`` is dropped first.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others(keeps)
        yield from run(batches)
        give_back()

    return whole
