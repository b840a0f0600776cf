"""A corpus run: documents through the corpus operators, one stage after another.

Every stage but the last returns the columns of ``documents``; a stage works on all rows
that its predecessor kept.  Packing returns the pieces of all remaining documents with
their token ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelframe.functions.checkpoints import materialize
from labelframe.llm import decontaminate, jaccard_join, packing, pii, quality_classifier
from labelframe.llm.queries import table, tokenizer


def classified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on this very input, keeps."""
    return quality_classifier.keep_good(docs, quality_classifier.fit(docs))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the least id, of each group connected by similarity."""
    return jaccard_join.keep_first(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with marks in place of personal data; n_chars follows the text."""
    clean = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    length = F.coalesce(F.char_length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", length)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their ids and places in the windows."""
    return packing.pack(docs, tokenizer(), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", classified),
    ("n-gram jaccard join", deduplicated),
    ("benchmark decontamination", decontaminated),
    ("personal data", redacted),
    ("packing", packed),
]

ORACLE_SQL = None  # a learned classifier and a tokenizer are no SQL; tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
