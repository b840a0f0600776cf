"""Packing of whole documents: places, exact round trip, number of sequences."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from corpus_cases import DATA, EDGE_TEXTS, edge_docs, empty_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from labelframe.llm import queries, two_fit
from tokenizers import Tokenizer


def naive_two_fit(lengths, window):
    """The same rule on plain lists."""
    left = sorted((n for n in lengths if n > window // two_fit.SHORT), reverse=True)
    bins = []
    while left:
        own = []
        while True:
            for n in list(left):
                if n <= window - sum(own):
                    own.append(n)
                    left.remove(n)
            room = window - sum(own)
            if len(own) < 2 or not room:
                break
            small = min(own)
            pairs = [(a + b, a, b) for i, a in enumerate(left) for b in left[i + 1 :] if small < a + b <= small + room]
            if not pairs:
                break
            _, a, b = max(pairs)
            own.remove(small)
            for n in (a, b):
                left.remove(n)
                own.append(n)
            left = sorted([*left, small], reverse=True)
        bins.append(own)
    for n in sorted((n for n in lengths if n <= window // two_fit.SHORT), reverse=True):
        fits = [own for own in bins if sum(own) + n <= window]
        best = max(fits, key=sum) if fits else bins.append([]) or bins[-1]
        best.append(n)
    return sorted(sum(own) for own in bins)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 24), max_size=40))
def test_places_follow_the_rule(lengths):
    place, offset, n = two_fit.two_fit(np.array(lengths, np.int64), 24)
    spans = defaultdict(list)
    for size, w, at in zip(lengths, place.tolist(), offset.tolist()):
        spans[w].append((at, at + size))
    assert len(spans) == n and sorted(spans) == list(range(n))
    for s in spans.values():
        s.sort()
        assert [a for a, _ in s] == [0, *[b for _, b in s][:-1]] and s[-1][1] <= 24
    assert sorted(s[-1][1] for s in spans.values()) == naive_two_fit(lengths, 24)


def test_the_shortest_piece_gives_way_to_two_that_fit_more_tightly():
    place, _, n = two_fit.two_fit(np.array([60, 30, 21, 19, 40]), 100)
    assert n == 2 and place[0] == place[4]  # 60 + 40 at once
    place, _, n = two_fit.two_fit(np.array([60, 38, 21, 19]), 100)
    assert n == 2 and place[0] == place[2] == place[3]  # 38 is replaced by 21 + 19


def check_pieces(texts, rows, window):
    """Every document's ids come back from its pieces; returns the number of sequences and of tokens."""
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, sequences, tokens = defaultdict(list), defaultdict(list), 0
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.offset + r.length))
    assert set(pieces) == set(texts)
    for i, text in texts.items():
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 1]
        tokens += len(ids)
        own = sorted(pieces[i], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert [r.start for r in own] == [window * k for k in range(len(own))]
        assert [r.length for r in own] == [min(window, len(ids) - r.start) for r in own]
        for r in own:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    for spans in sequences.values():
        spans.sort()
        assert [a for a, _ in spans] == [0, *[b for _, b in spans][:-1]] and spans[-1][1] <= window
    return len(sequences), tokens


def test_documents_come_back_and_few_sequences_are_used(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for parts in (1, 7):
        n, tokens = check_pieces(texts, two_fit.pack_whole(docs.repartition(parts), queries.tokenizer()).collect(), 4096)
        assert n <= 1.01 * tokens / 4096 + 1


def test_small_groups_meet_in_a_second_round(spark):
    rng = random.Random(3)
    texts = {i: " ".join("a" * rng.randint(1, 3) for _ in range(rng.randint(0, 90))) for i in range(400)}
    texts[400] = "one <|endoftext|> two<|endoftext|>"
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(20)
    n, tokens = check_pieces(texts, two_fit.pack_whole(docs, queries.tokenizer(), window=128, group_pieces=64).collect(), 128)
    assert n <= 1.1 * tokens / 128 + 2


def test_odd_tables(spark):
    rows = two_fit.pack_whole(edge_docs(spark), queries.tokenizer()).collect()
    assert len([r for r in rows if r.piece == 0]) == len(EDGE_TEXTS)
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    clashing = edge_docs(spark).selectExpr("*", "1 AS piece", "2 AS cell", "'x' AS sequence_id", "true AS again")
    assert two_fit.pack_whole(clashing, queries.tokenizer()).count() == len(rows)
    assert two_fit.pack_whole(empty_docs(spark), queries.tokenizer()).count() == 0
