"""The trie of conversation prefixes against plain dictionaries."""

import hashlib
import zlib

import numpy as np
import pytest
from corpus_cases import DATA
from hypothesis import given, settings
from hypothesis import strategies as st
from labelframe.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = {}
    for c, _, r, x in sorted((q for q in rows if q[0] is not None), key=lambda q: (q[0], q[1] is not None, q[1] or 0)):
        convs.setdefault(c, []).append((r or "", x or ""))
    whole = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = tuple((convs.get(c - c % 5) or [])[:h] + own[h:])
    members, children, below = {}, {}, {}
    for c, q in whole.items():
        for d in range(len(q) + 1):
            members.setdefault(q[:d], []).append(c)
    for q in members:
        if q:
            children.setdefault(q[:-1], []).append(q)
    for q in sorted(members, key=len, reverse=True):
        own = (len(members[q]) - 1) * len(q[-1][1].encode()) if q else 0
        kids = children.get(q, [])
        below[q] = (sum(below[k][0] for k in kids) or 1, own + sum(below[k][1] for k in kids))

    def digest(q):
        return hashlib.sha256(",".join(str(c) for c in sorted(members[q]) if len(whole[c]) == len(q)).encode()).hexdigest()

    return ordered(
        (min(members[q]), len(q), min(members[q[:-1]]) if q else None, len(members[q]), len(children.get(q, [])), *below[q], digest(q))
        for q in members
    )


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, v or 0) if not isinstance(v, str) else v for v in r))


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = ordered(prefix_trie.prefix_trie(df).collect())
    assert got == brute(rows)
    return got


@pytest.mark.parametrize("block", [1, 3, 20_000])
def test_whole_table_in_blocks_of_any_size(spark, monkeypatch, block):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    df = spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert ordered(prefix_trie.prefix_trie(df).collect()) == brute([tuple(r) for r in df.collect()])


@pytest.mark.parametrize("block", [1, 5, 20_000])
def test_copies_and_prefixes_across_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    rng = np.random.default_rng(4)
    rows = []
    for c in range(90):
        kind = int(rng.integers(0, 4))
        for t in range(int(rng.integers(1, 14))):
            text = f"same {t}" if kind < 2 else f"kind {kind} {t // 9 * c}"
            rows.append((c * 5 if c % 3 else c, t, "user", text))
    rows = list(dict.fromkeys(rows))
    rows = [r for i, r in enumerate(rows) if (r[0], r[1]) not in {(q[0], q[1]) for q in rows[:i]}]
    check(spark, rows)


def test_odd_rows(spark):
    long = "word " * 100_000
    rows = [
        (1, None, "user", "first"), (1, 0, None, "second"), (1, 1, "user", None), (1, 2, "", ""),
        (2, 0, "user", long), (2, 0, "user", long), (2, 1, "üñ", "猫😀"),
        (None, 0, "user", "nobody"), (0, 0, "user", "head"), (0, 1, "user", "x"), (0, 1, "user", "x"),
        (7, 0, "user", "alone"), (-3, 0, "user", "below zero"), (2**62, 3, "user", "far"),
    ]
    rows[12] = (-5, 0, "user", "below zero")
    got = check(spark, rows)
    assert got[0][1] == 0 or any(r[1] == 0 and r[2] is None for r in got)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS key", "2 AS depth", "'a' AS family", "3 AS h", "4 AS place")
    assert ordered(prefix_trie.prefix_trie(df).collect()) == got


def test_without_turns_or_rows(spark):
    short = [c for c in range(1, 60) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2][:3]
    got = check(spark, [(c, t, "user", f"{c} {t}") for c in short for t in (0, 1)])
    assert [r[:5] for r in got] == [(min(short), 0, None, 3, 0)]  # turnless conversations are members of the root
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=5), min_size=1, max_size=25), st.integers(1, 6))
def test_forests_of_any_blocks_merge_to_the_whole_trie(sequences, size):
    """Blocks and the path that merges them, without Spark."""
    keys = sorted((b"".join(hashlib.md5(bytes([t])).digest() for t in q), i) for i, q in enumerate(sequences))
    path, place, members = prefix_trie.Path(), 0, {}
    rows = []
    for at in range(0, len(keys), size):
        part = keys[at : at + size]
        sizes = np.concatenate([np.ones(len(k) // 16, np.int64) for k, _ in part] or [np.zeros(0, np.int64)])
        done, paths = prefix_trie.block_nodes([k for k, _ in part], [i for _, i in part], sizes, 0, at, place)
        place += len(paths["depth"])
        rows += list(zip(done["conv_id"].tolist(), np.array(done["depth"]).tolist(), done["n_convs"].tolist(), done["n_children"].tolist(), done["n_leaves"].tolist(), done["saved_tokens"].tolist()))
        columns = {c: v if isinstance(v, list) else v.tolist() for c, v in paths.items()}
        for values in zip(*columns.values()):
            path.add(dict(zip(columns, values)))
    path.close(0)
    rows += [tuple(r[c] for c in ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens")) for r in path.out if "same" not in r]
    for i, q in enumerate(map(tuple, sequences)):
        for d in range(len(q) + 1):
            members.setdefault(q[:d], []).append(i)
    expected = []
    for q, own in members.items():
        below = [p for p in members if p[: len(q)] == q]
        leaves = [p for p in below if not any(len(o) == len(p) + 1 and o[: len(p)] == p for o in members)]
        saved = sum(len(members[p]) - 1 for p in below if p)
        expected.append((min(own), len(q), len(own), sum(len(p) == len(q) + 1 for p in below), len(leaves), saved))
    assert sorted(rows) == sorted(expected)
