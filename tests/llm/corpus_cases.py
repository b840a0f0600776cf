"""Odd small tables for the corpus operators."""

import os

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

LONG = "lorem ipsum dolor sit amet " * 8000  # 200,000 characters of one line
EDGE_TEXTS = [
    None,
    "",
    " \t\n\r\n",
    "one",
    "one two three four",
    "one two three four five six seven eight nine ten eleven",
    "one two three four five six seven eight nine ten eleven",
    "Üñí cöde 猫 😀 words, in a single line of text here\nand\nand\nmore",
    "x" * 5000,
    LONG,
    " no break spaces and the rest of the line are words",
]

# names that operators use inside
CLASHES = "id long, text_hash long, own binary, n long, block long, `range` int, size int, band int, value long, key string, fold long, label int"


def edge_docs(spark):
    """Null, empty, blank, short, repeated and very long texts; null and repeated ids; clashing columns."""
    ids = [1, 2, 3, 4, 5, 6, 6, 7, 8, None, None]
    rows = [(i, t, None, "s", 0, i, 1, b"x", 2, 3, 4, 5, 6, 7, "k", 8, 9) for i, t in zip(ids, EDGE_TEXTS)]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}")


def empty_docs(spark):
    return edge_docs(spark).limit(0)


def texts_of(docs):
    return [r.text for r in docs.select("text").collect()]
