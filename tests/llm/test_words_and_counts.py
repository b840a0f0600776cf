"""Token counts, licence scan, line rules: against brute force on small tables."""

import itertools
import math
import random
import re
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpus_cases import DATA, EDGE_TEXTS, edge_docs, empty_docs, texts_of
from labelframe.llm import license_scan, quality_rules, token_counts
from labelframe.llm.words import repeated_words, slices, split_lines, split_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \t\nü猫\x0b", max_size=30)), max_size=8), st.integers(1, 40))
def test_words_and_lines_equal_regular_expressions(texts, most):
    column = pa.array(texts, pa.string())
    words, lines, seen = [[] for _ in texts], [[] for _ in texts], {}
    for part in slices(column, most):
        found = split_words(part)
        raw = part.data.tobytes()
        for b, e, r, h in zip(found.begins, found.ends, found.rows, found.hashes.tolist()):
            words[part.first + r].append(raw[b:e].decode())
            assert seen.setdefault(words[part.first + r][-1], h) == h
        for b, e, r in zip(*(lambda s: (s.begins, s.ends, s.rows))(split_lines(part, found)[0])):
            lines[part.first + r].append(raw[b:e].decode())
    assert words == [WORD.findall(t or "") for t in texts]
    assert lines == [[x for x in (t or "").split("\n") if WORD.search(x)] for t in texts]
    assert len(set(seen.values())) == len(seen)


def test_repeated_words_are_those_in_windows_met_again():
    text = "a b c d e f a b c d e g"
    part = next(slices(pa.array([text])))
    assert repeated_words(split_words(part)).tolist() == [True] * 5 + [False] + [True] * 5 + [False]


def brute_count(word, scores, byte_score):
    marked = token_counts.MARK + word
    best = [(0.0, 0)]
    for end in range(1, len(marked) + 1):
        options = []
        for begin in range(end):
            piece = marked[begin:end]
            if piece in scores:
                options.append((best[begin][0] + scores[piece], -(best[begin][1] + 1)))
            elif len(piece) == 1:
                n = len(piece.encode())
                options.append((best[begin][0] + n * byte_score, -(best[begin][1] + n)))
        top = max(options)
        best.append((top[0], -top[1]))
    return best[-1][1]


def test_piece_counts_equal_the_lattice_of_each_word():
    rng = random.Random(3)
    pieces = ["▁", "a", "b", "ab", "▁a", "ba", "aba", "bab", "▁ab", "é", "abab"]
    scores = dict(zip(pieces, token_counts.zipf_scores(len(pieces) + 1).tolist()))
    made = token_counts.make_pieces(pieces)
    words = sorted({"".join(rng.choice("abécž猫😀") for _ in range(rng.randint(1, 12))) for _ in range(300)})
    got = token_counts.count_pieces(words, made).tolist()
    assert got == [brute_count(w, scores, made.byte_score) for w in words]


def test_token_counts_of_documents_equal_brute_force(spark):
    pieces = token_counts.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    scores = dict(zip(pieces, token_counts.zipf_scores(len(pieces) + 1).tolist()))
    byte_score = token_counts.make_pieces(pieces).byte_score
    memo = {}
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(20)
    rows = {r.doc_id: r for r in token_counts.token_counts(docs, pieces).collect()}
    for doc in docs.collect():
        words = WORD.findall(doc.text)
        for w in set(words) - set(memo):
            memo[w] = brute_count(w, scores, byte_score)
        assert (rows[doc.doc_id].n_words, rows[doc.doc_id].n_tokens) == (len(words), sum(memo[w] for w in words))


def test_token_counts_of_odd_tables(spark):
    pieces = token_counts.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    found = token_counts.token_counts(edge_docs(spark), pieces)
    assert found.columns == ["doc_id", "n_words", "n_tokens"]
    rows = found.collect()
    assert sorted(r.n_words for r in rows) == sorted(len(WORD.findall(t or "")) for t in EDGE_TEXTS)
    assert all((r.n_tokens == 0) == (r.n_words == 0) for r in rows)
    assert token_counts.token_counts(empty_docs(spark), pieces).count() == 0


# licence scan


def test_longest_increasing_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        v = [rng.randint(0, 9) for _ in range(rng.randint(0, 8))]
        got = [v[i] for i in license_scan.increasing(v)]
        assert all(a < b for a, b in zip(got, got[1:]))
        best = max(n for n in range(len(v) + 1) for c in itertools.combinations(v, n) if all(a < b for a, b in zip(c, c[1:])))
        assert len(got) == best


def test_alignment_is_a_common_subsequence_and_finds_what_is_whole():
    rng = random.Random(2)
    for _ in range(300):
        template = [rng.randint(0, 6) for _ in range(rng.randint(1, 8))]
        text = [rng.randint(0, 9) for _ in range(rng.randint(0, 12))]
        pairs = license_scan.align(text, template)
        assert all(text[i] == template[j] for i, j in pairs)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(pairs, pairs[1:]))
    assert license_scan.align([7, 1, 2, 3, 2, 8], [1, 2, 3, 2]) == [(1, 0), (2, 1), (3, 2), (4, 3)]


def test_licences_are_found_whole_changed_repeated_and_by_place(spark):
    apache = license_scan.TEMPLATES["Apache-2.0"]
    gpl = license_scan.TEMPLATES["GPL-3.0"]
    texts = {
        0: f"ünd the the text.\n{apache}",
        1: f"{apache}\nsome words between the notices here\n{apache}",
        2: gpl.replace("General", "Common").upper() + " the end",
        3: "the license of this work is under no version",
        4: f"this is a work of the kind. {'the word ' * 3000}{gpl} {'the word ' * 3000}",
        5: f"{apache} {license_scan.TEMPLATES['MIT']}",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {(r.doc_id, r.license): r for r in license_scan.license_scan(docs).collect()}
    assert set(found) == {(0, "Apache-2.0"), (1, "Apache-2.0"), (2, "GPL-3.0"), (4, "GPL-3.0"), (5, "Apache-2.0"), (5, "MIT")}
    assert found[0, "Apache-2.0"].n_found == 1 and found[1, "Apache-2.0"].n_found == 2
    assert math.isclose(found[2, "GPL-3.0"].coverage, 11 / 12) and found[4, "GPL-3.0"].coverage == 1
    for (i, name), r in found.items():
        if name == "Apache-2.0":
            assert texts[i][r.start : r.end] == apache[:-1]
    assert texts[4][found[4, "GPL-3.0"].start : found[4, "GPL-3.0"].end] == gpl[:-1]


def test_licences_of_the_documents_are_those_with_the_line(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    short = {n: license_scan.TEMPLATES[n] for n in ("Apache-2.0", "CC-BY-NC-4.0", "GPL-3.0", "MIT", "all-rights-reserved")}
    got = {(r.doc_id, r.license) for r in license_scan.license_scan(docs, short).collect()}
    assert got == {(r.doc_id, n) for r in docs.collect() for n, line in short.items() if line in r.text}


def test_a_notice_is_found_without_its_rarest_word(spark):
    text = "We released the tool in May after more than a year of hard work by many kind people who came from nearly all places. Distributed under the MIT License."
    grant = license_scan.TEMPLATES["MIT-grant"].replace("granted", "given")
    texts = {0: text, 1: f"Funds were granted by the state. {'the word ' * 200}{grant}. {'the word ' * 90}{grant}"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {(r.doc_id, r.license): r for r in license_scan.license_scan(docs).collect()}
    mit, given = found[0, "MIT"], found[1, "MIT-grant"]
    assert (mit.coverage, mit.n_found, text[mit.start : mit.end]) == (0.8, 1, "under the MIT License")
    assert given.n_found == 2 and texts[1][given.start : given.end] == grant


def brute_notices(text, template, least):
    """Notices by alignment of every run of at most 4 template lengths and a word; None is no template word."""
    ends, best = {}, None
    for q in range(len(text)):
        for p in range(q, max(-1, q - 4 * len(template) - 1), -1):
            hits = [i for i in range(p, q + 1) if text[i] is not None]
            pairs = license_scan.align([text[i] for i in hits], template)
            if len(pairs) >= least:
                ends.setdefault(q, p)
                if best is None or len(pairs) > best[0]:
                    best = (len(pairs), hits[pairs[0][0]], hits[pairs[-1][0]])
    n, taken = 0, -1
    for q, p in sorted(ends.items()):
        if p > taken:
            n, taken = n + 1, q
    return n, best


def test_notices_are_those_of_alignment_at_every_place():
    rng, several = random.Random(3), 0
    for _ in range(400):
        size = rng.randint(1, 6)
        template = [rng.randint(0, size) for _ in range(size)]
        text = [rng.choice([None, *template, *template]) for _ in range(rng.randint(1, 15))]
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(text))
            text[at:at] = template
        least = max(1, math.ceil(0.8 * size - 1e-9))
        places = [i for i, w in enumerate(text) if w is not None]
        n, best = license_scan.notices(np.array(places, np.int64), np.array([text[i] for i in places], np.int64), template, least)
        got = (n, best and (best[0], places[best[1]], places[best[2]]))
        assert got == brute_notices(text, template, least)
        several += n > 1
    assert several > 50


def test_licence_scan_of_odd_tables(spark):
    assert license_scan.license_scan(edge_docs(spark)).count() == 0
    assert license_scan.license_scan(empty_docs(spark)).count() == 0
    with pytest.raises(ValueError):
        license_scan.license_scan(empty_docs(spark), {"none": " . "})


# line rules


def brute_base(text):
    words = WORD.findall(text or "")
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times, covered, seen, again = Counter(grams), set(), set(), 0
    for i, g in enumerate(grams):
        if times[g] > 1:
            covered.update(range(i, i + 5))
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(covered), n < 10 or 100 * len(covered) > 20 * n


def test_viterbi_is_the_best_of_all_labellings():
    rng = np.random.default_rng(5)
    rows = np.repeat(np.arange(6), [1, 2, 5, 1, 4, 3])
    features = rng.random((len(rows), 3)) < 0.5
    field = quality_rules.Field(rng.normal(size=(3, 2)), rng.normal(size=(2, 2)))
    got = quality_rules.decode(rows, features, field)
    for r in range(6):
        x = features[rows == r]

        def score(labels):
            s = sum(x[i] @ field.emission[:, y] for i, y in enumerate(labels))
            return s + sum(field.transition[a, b] for a, b in zip(labels, labels[1:]))

        best = max(map(score, itertools.product((0, 1), repeat=len(x))))
        assert math.isclose(score(tuple(got[rows == r])), best)


def test_training_reaches_a_flat_place_of_the_likelihood():
    rng = np.random.default_rng(6)
    rows = np.repeat(np.arange(40), rng.integers(1, 6, 40))
    labels = rng.integers(0, 2, len(rows))
    features = np.stack([np.ones(len(rows), bool), (labels == 1) ^ (rng.random(len(rows)) < 0.2)], axis=1)

    def likelihood(field):
        total = 0.0
        for r in np.unique(rows):
            x, y = features[rows == r].astype(float) @ field.emission, labels[rows == r]
            scores = [sum(x[i, k] for i, k in enumerate(c)) + sum(field.transition[a, b] for a, b in zip(c, c[1:])) for c in itertools.product((0, 1), repeat=len(y))]
            total += scores[int("".join(map(str, y)), 2)] - np.logaddexp.reduce(scores)
        return total / len(rows) - 0.5e-3 * ((field.emission**2).sum() + (field.transition**2).sum())

    field = quality_rules.train(rows, features, labels, rounds=2000)
    top = likelihood(field)
    for where in (field.emission, field.transition):
        for at in np.ndindex(where.shape):
            for step in (-0.2, 0.2):
                where[at] += step
                assert likelihood(field) < top + 1e-6
                where[at] -= step


def test_base_counts_and_verdicts_on_documents(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{n}.parquet") for n in ("documents", "labels"))
    rows = {r.doc_id: r for r in quality_rules.quality_rules(docs, quality_rules.fit(docs, labels)).collect()}
    for doc in docs.collect():
        r = rows[doc.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_base(doc.text)
        assert r.kept == (not r.base_failed and r.content_share >= 0.5)
    good = {r.doc_id: r.quality for r in labels.collect()}
    right = [rows[i].kept == bool(q) for i, q in good.items() if not rows[i].base_failed]
    assert np.mean(right) > 0.97


def test_lines_of_long_texts_are_drawn_in_runs():
    rows, seeds = np.repeat([0, 1, 3], [40, 1000, 300]), np.arange(4, dtype=np.uint64)
    at, run = quality_rules.draw_lines(rows, seeds, 128)
    assert at[:40].tolist() == list(range(40)) and not run[:40].any()
    for row, first in ((1, 40), (3, 1040)):
        own = rows[at] == row
        assert 64 < own.sum() <= 128 and len(np.unique(run[own])) == 2
        assert ((at[own] - first) // 64 == run[own]).all()
    assert len(quality_rules.draw_lines(rows, seeds, 5000)[0]) == len(rows)
    assert np.bincount(rows[quality_rules.draw_lines(rows, seeds, 3)[0]]).tolist() == [3, 3, 0, 3]


def test_long_texts_are_learned_from(spark):
    good = "this is a plain line of words that ends with a full stop.\n"
    bad = "### $$$ BUY NOW | | | *** !!!\n"
    rows = [(i, (bad if i % 2 else good) * 3000) for i in range(6)]
    docs = spark.createDataFrame([*rows, (7, None), (8, " ")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(6)] + [(7, 0), (8, 1)], "doc_id long, quality int")
    absent = spark.range(100, 400).selectExpr("id AS doc_id", "0 AS quality")
    for most in (1500, 2):
        field = quality_rules.fit(docs, labels.unionAll(absent), most)
        share = {r.doc_id: r.content_share for r in quality_rules.quality_rules(docs, field).collect()}
        assert [share[i] for i in range(6)] == [1.0, 0.0] * 3
    with pytest.raises(ValueError):
        quality_rules.fit(docs, labels, most_lines=0)


def test_line_rules_of_odd_tables(spark):
    docs = edge_docs(spark)
    field = quality_rules.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    rows = quality_rules.quality_rules(docs, field).collect()
    assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows) == sorted(map(brute_base, EDGE_TEXTS))
    assert all(r.content_share == (1.0 if r.n_words else 0.0) for r in rows)
    assert quality_rules.quality_rules(empty_docs(spark), field).count() == 0
    assert len(texts_of(docs)) == len(EDGE_TEXTS)


def test_long_words_count_as_on_the_trie(monkeypatch):
    pieces = token_counts.make_pieces(["a", "b", "ab", "aba", "bab", "c" * 5, "猫a", token_counts.MARK + "a", "bbbbbbb"])
    rng = random.Random(6)
    words = ["".join(rng.choice("abcéx猫") for _ in range(rng.randint(1, 400))) for _ in range(40)] + ["ab" * 300, "c" * 999]
    monkeypatch.setattr(token_counts, "LONG", 10**9)
    whole = token_counts.count_pieces(words, pieces).tolist()
    for long, block in ((0, 1), (0, 3), (100, 64), (256, 1 << 15)):
        monkeypatch.setattr(token_counts, "LONG", long)
        monkeypatch.setattr(token_counts, "LONG_BLOCK", block)
        assert token_counts.count_pieces(words, pieces).tolist() == whole


def test_a_word_of_a_million_characters_is_counted_in_seconds():
    pieces = token_counts.make_pieces([*"abcdefgh", "ab", "abc", "abcdefgh", "h" * 16])
    begin = time.perf_counter()
    assert token_counts.count_pieces(["abcdefgh" * 125_000, "h" * 1_000_000], pieces).tolist() == [125_003, 62_503]  # the word mark is three bytes here
    assert time.perf_counter() - begin < 30
