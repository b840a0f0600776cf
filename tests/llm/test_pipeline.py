"""The pipeline against brute force, and its place in the entry module."""

import subprocess
import sys
from collections import defaultdict
from pathlib import Path

import corpus_pipeline
from corpus_cases import DATA, edge_docs, empty_docs
from labelframe.functions.checkpoints import materialize
from labelframe.llm import pii, quality_classifier
from test_models_and_files import check_pieces
from test_similar_and_private import brute_join, shingle_set

ROOT = Path(__file__).resolve().parents[2]


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}
    model = quality_classifier.fit(docs)
    expected = [r.doc_id for r in quality_classifier.classify(docs, model).collect() if r.kept]
    found = []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, DATA))
        found.append((name, docs))
        assert name == "packing" or docs.columns == columns
    ids = [sorted(r.doc_id for r in d.collect()) for _, d in found[:4]]
    assert ids[0] == sorted(expected) and len(expected) < len(rows)
    groups = brute_join([rows[i].text for i in ids[0]])
    first = [i for k, i in enumerate(ids[0]) if groups[k][0] == k]
    assert ids[1] == first
    items = [shingle_set(r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    clean = [i for i in first if all(len(s & shingle_set(rows[i].text)) < 0.8 * len(s) for s in items)]
    assert ids[2] == ids[3] == clean
    cues = pii.automaton()
    texts = {i: pii.redacted(rows[i].text, pii.find(rows[i].text, cues)) for i in clean}
    for r in found[3][1].collect():
        assert r.text == texts[r.doc_id] and r.n_chars == len(r.text)
    check_pieces(texts, found[4][1].collect())
    whole = corpus_pipeline.run(spark, DATA)
    by_doc = defaultdict(int)
    for r in whole.collect():
        by_doc[r.doc_id] += r.length
    assert sorted(by_doc) == clean


def test_pipeline_of_an_odd_table(spark):
    docs = edge_docs(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, DATA))
    assert docs.columns[:3] == ["doc_id", "start", "length"]


def test_pipeline_of_an_empty_table(spark):
    docs = empty_docs(spark)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, DATA))
        assert docs.count() == 0 and (name == "packing" or docs.columns == columns)


def test_the_library_does_without_the_corpus_operators():
    code = """
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("labelframe.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as e
assert "pipeline" not in e.queries() and not any(n.startswith("op") for n in e.queries())
assert set(e.oracle_sql()) <= set(e.queries())
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
