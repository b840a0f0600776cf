"""Language model, quality classifier, web archives, packing: brute force, round trips, held-out accuracy."""

import base64
import gzip
import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpus_cases import DATA, EDGE_TEXTS, edge_docs, empty_docs
from labelframe.llm import batches, lm_score, packing, quality_classifier, queries, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: chr(c + 32) for c in range(65, 91)}


# language model


def tokens_of(text):
    return [*WORD.findall((text or "").translate(LOWER)), None]


def brute_scores(rows):
    """Scores with exact expectation-maximisation over the tokens of the deleted texts."""
    fold = {i: zlib.crc32(str(i).encode()) % 5 for i, _ in rows}
    toks = {i: tokens_of(t) for i, t in rows}

    def counts(folds):
        uni, bi = Counter(), Counter()
        for i, t in toks.items():
            if fold[i] in folds:
                uni.update(t)
                bi.update(zip(["<s>", *t], t))
        uni["<s>"] = uni[None]
        return uni, bi

    (uni, bi), (kept_uni, kept_bi) = counts({0, 2, 3, 4}), counts({0, 3, 4})
    total, kept = (sum(n for w, n in u.items() if w != "<s>") for u in (uni, kept_uni))
    known = sum(1 for w, n in uni.items() if n and w != "<s>")

    def parts(u, b, n, t):
        for v, w in zip(["<s>", *t], t):
            yield int(u[v]).bit_length(), (b[v, w] / u[v] if u[v] else 0.0, u[w] / n, 1 / (known + 1))

    events = defaultdict(list)
    for i, t in toks.items():
        if fold[i] == 2:
            for bucket, p in parts(kept_uni, kept_bi, kept, t):
                events[bucket].append(p)

    def learn(p):
        p, w = np.array(p).reshape(-1, 3), np.full(3, 1 / 3)
        for _ in range(100):
            share = p * w / (p * w).sum(axis=1, keepdims=True)
            w = (share.sum(axis=0) + 1) / (len(p) + 3)
        return w

    pooled = learn([p for e in events.values() for p in e])
    weights = {b: learn(e) for b, e in events.items()}

    def weight(b):
        w = weights.get(b, pooled).copy()
        if b == 0:
            w[0] = 0
        return w / w.sum()

    out = {}
    for i, t in toks.items():
        base = sum(math.log10((uni[w] + 0.5) / (total + 0.5 * (known + 1))) for w in t)
        score = sum(math.log10(weight(b) @ np.array(p)) for b, p in parts(uni, bi, total, t))
        out[i] = (fold[i] == 1, len(t), sum(uni[w] > 0 for w in t), total, base, score)
    return out


@pytest.mark.parametrize("block, ranges", [(lm_score.BLOCK_BYTES, lm_score.RANGE_BYTES), (3000, 20000)])
def test_scores_equal_brute_force(spark, monkeypatch, block, ranges):
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", block)
    monkeypatch.setattr(lm_score, "RANGE_BYTES", ranges)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    expected = brute_scores([(r.doc_id, r.text) for r in docs.collect()])
    rows = lm_score.lm_score(docs).collect()
    assert len(rows) == len(expected)
    for r in rows:
        held, n, known, total, base, score = expected[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert math.isclose(r.score, score, rel_tol=2e-3)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_blocks_of_null_and_empty_texts_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 1 << 16)
    rows = spark.range(0, 30000, 1, 1).selectExpr("id", "0L AS fold", "CASE WHEN id % 2 = 0 THEN '' END AS text")

    def sizes(batches):
        for block, held in lm_score.blocks(batches, 2):
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([sum(b.num_rows for b, _ in held)])], names=["block", "n"])

    found = batches.bounded(rows).mapInArrow(sizes, "block long, n long").collect()
    assert sum(r.n for r in found) == 30000 and len({r.block for r in found}) == len(found)
    assert max(r.n for r in found) <= (1 << 16) // 16 + batches.MOST_ROWS
    assert lm_score.lm_score(rows.selectExpr("id AS doc_id", "text")).count() == 30000


class Captured:
    """Stands in for a frame and keeps the function that it is given."""

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):
        self.run = run
        return self


def test_counting_a_block_takes_little_memory(monkeypatch):
    """Texts of a block are dropped once they are coded, its arrays before the next block, and what is sent is cut."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{w}" for w in rng.zipf(1.2, 6000) % 400_000) for _ in range(800)]
    size = sum(map(len, texts))
    assert size > 2 * lm_score.BLOCK_BYTES  # two whole blocks and more
    monkeypatch.setattr(lm_score, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    made = (
        pa.RecordBatch.from_pydict({"id": list(range(i, i + 50)), "fold": [0] * 50, "text": texts[i : i + 50]})
        for i in range(0, len(texts), 50)
    )
    frame = lm_score.count_requests(Captured(), 64)
    tracemalloc.start()
    total, largest = 0, 0
    for batch in frame.run(made):
        total += batch.column("total").flatten().to_numpy().sum() if batch.column("size")[0].as_py() == 1 else 0
        largest = max(largest, batch.nbytes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total == sum(len(t.split()) + 1 for t in texts)
    assert largest < 4 << 20 and peak < 20 * lm_score.BLOCK_BYTES, (largest, peak)


def test_weights_recover_a_known_mixture():
    rng = np.random.default_rng(3)
    n, weights = 40000, np.array([0.5, 0.3, 0.2])
    # three estimates over three outcomes; outcomes are drawn from their mixture
    estimates = np.array([[0.8, 0.1, 0.1], [0.1, 0.8, 0.1], [1 / 3, 1 / 3, 1 / 3]])
    drawn = rng.choice(3, n, p=weights @ estimates)
    counts = np.bincount(drawn)
    relative = estimates[:2] * 3
    got = lm_score.learn_weights(np.array([(5 * 2048 + 900 + k) * 2048 + 900 + k for k in range(3)]), counts, np.log2(relative[0]) * counts, np.log2(relative[1]) * counts)
    # the outcome probabilities are what the data decide
    assert np.allclose(got[5] @ estimates, counts / n, atol=0.01)


def test_scores_of_odd_tables(spark):
    rows = lm_score.lm_score(edge_docs(spark)).collect()
    assert sorted(r.n_tokens for r in rows) == sorted(len(tokens_of(t)) for t in EDGE_TEXTS)
    assert all(np.isfinite(r.score) and np.isfinite(r.base_score) and r.score < 0 for r in rows)
    assert lm_score.lm_score(empty_docs(spark)).count() == 0
    none = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1][:3]  # nothing to learn from
    rows = lm_score.lm_score(spark.createDataFrame([(i, "a b") for i in none], "doc_id long, text string")).collect()
    assert [(r.n_known, r.train_tokens, r.score) for r in rows] == [(0, 0, 0.0)] * 3


# quality classifier


def test_labellers_are_recovered_from_their_votes():
    rng = np.random.default_rng(9)
    good = rng.random(20000) < 0.8
    votes = np.stack([np.where(rng.random(20000) < r, 0, np.where(rng.random(20000) < a, np.where(good, 1, -1), np.where(good, -1, 1))) for a, r in ((0.97, 0.1), (0.95, 0.3), (0.92, 0.0), (0.9, 0.2))], axis=1)
    codes, n = np.unique(quality_classifier.patterns(votes), return_counts=True)
    found = quality_classifier.weak_labels(codes, n, 4)
    assert abs(found.prior - 0.8) < 0.03
    for j, (a, r) in enumerate(((0.97, 0.1), (0.95, 0.3), (0.92, 0.0), (0.9, 0.2))):
        assert abs(found.accuracy[j, 1, 2] - (1 - r) * a) < 0.03 and abs(found.accuracy[j, 0, 0] - (1 - r) * a) < 0.06
    assert ((found.posterior[quality_classifier.patterns(votes)] > 0.5) == good).mean() > 0.97


def test_classifier_agrees_with_labels_that_it_has_not_seen(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    model = quality_classifier.fit(docs)
    rows = quality_classifier.classify(docs, model).join(labels, "doc_id").collect()
    good, bad = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.05
    kept = {r.doc_id for r in quality_classifier.keep_good(docs, model).collect()}
    assert kept == {r.doc_id for r in quality_classifier.classify(docs, model).collect() if r.kept}


def test_equal_rows_are_drawn_once_with_their_number(spark, monkeypatch):
    seen = {}

    def fitted(x, y, rounds=200, penalty=1e-5, times=None):
        seen.update(x=x, y=y, times=times)
        return np.zeros(x.shape[1] + 1)

    monkeypatch.setattr(quality_classifier, "logistic", fitted)
    same = spark.range(1000).selectExpr("CAST(NULL AS LONG) AS doc_id", "'### !!! ### !!! ###' AS text")
    other = spark.range(2000).selectExpr("id AS doc_id", "concat('a quiet line of words, number ', id) AS text")
    blank = spark.range(50).selectExpr("id AS doc_id", "' ' AS text")
    quality_classifier.fit(same.unionAll(other).unionAll(blank), sample=100)
    assert len(seen["x"]) == len(seen["y"]) == len(seen["times"]) == 100
    heavy = seen["times"] == 1000
    assert heavy.sum() == 1 and abs(seen["times"].sum() - 3000) < 600
    assert len(np.unique(seen["times"][~heavy])) == 1
    quality_classifier.fit(same.unionAll(other), sample=5000)
    assert sorted(seen["times"]) == [1] * 2000 + [1000]


def test_rows_that_count_twice_fit_as_two_rows():
    rng = np.random.default_rng(5)
    x, y, times = rng.random((60, 4)), rng.random(60), rng.integers(1, 4, 60)
    once = quality_classifier.logistic(x, y, times=times)
    assert np.allclose(once, quality_classifier.logistic(np.repeat(x, times, axis=0), np.repeat(y, times)), atol=1e-6)


def test_classifier_on_odd_tables(spark):
    model = quality_classifier.fit(edge_docs(spark))
    rows = quality_classifier.classify(edge_docs(spark), model).collect()
    assert len(rows) == len(EDGE_TEXTS)
    assert all(r.p_quality == 0 and not r.kept for r in rows if r.n_words == 0)
    assert quality_classifier.keep_good(edge_docs(spark), model).columns == edge_docs(spark).columns
    empty = quality_classifier.fit(empty_docs(spark))
    assert quality_classifier.classify(empty_docs(spark), empty).count() == 0
    assert all(r.kept == (r.n_words > 0) for r in quality_classifier.classify(edge_docs(spark), empty).collect())


# web archives


def test_a_record_has_the_parts_that_the_format_asks_for():
    payload = "<p>é</p>".encode()
    head, _, block = gzip.decompress(warc.write_record(7, "http://a/ü\r\n", payload, None)).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    assert head.startswith(b"WARC/1.0\r\n") and fields["WARC-Type"] == "response"
    assert fields["WARC-Target-URI"] == "http://a/%C3%BC%0D%0A"
    assert int(fields["Content-Length"]) == len(block) - 4
    assert fields["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    revisit = warc.parse(gzip.decompress(warc.write_record(7, "u", payload, 9)))
    assert revisit.payload is None and revisit.headers["warc-refers-to"] == "<urn:x-page:9>" and revisit.http["content-length"] == "9"


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=300), max_size=6), st.integers(1, 50))
def test_members_come_back_one_by_one(payloads, size):
    written = [warc.write_record(i, "u", p, None) for i, p in enumerate(payloads)]
    before, warc.READ_BYTES = warc.READ_BYTES, size
    try:
        assert [warc.parse(m).payload for m in warc.read_members(b"".join(written))] == payloads
    finally:
        warc.READ_BYTES = before


def test_broken_records_are_refused():
    whole = warc.write_record(1, "u", b"payload", None, compressed=False)
    for broken in (whole.replace(b"payload", b"paYload"), whole[:-1], whole.replace(b"WARC/1.0", b"XARC/1.0"), whole + b"x"):
        with pytest.raises(warc.BadRecord):
            warc.parse(broken)
    with pytest.raises(warc.BadRecord):
        list(warc.read_members(warc.write_record(1, "u", b"payload", None)[:-5]))


def test_pages_survive_the_round_trip(spark):
    same, short = "x" * 1000, "x" * 999
    rows = [(1, "a", same), (2, None, same), (3, "c\n", same), (3, "c", same), (4, "d", short), (5, "e", short), (6, "f", None), (7, "", ""), (None, "g", same), (8, "h", "é" * 500), (9, "h", "é" * 500)]
    pages = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, key string")
    parts = warc.archive_parts(warc.mark_revisits(pages))
    got = warc.read_archives(parts, with_payload=True).collect()
    revisits = {r.page_id: r.refers_to for r in got if r.record_type == "revisit"}
    assert revisits == {1: 3, 2: 3, 8: 9}
    expected = Counter((i, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest(), u or "") for i, u, h in rows)
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.url) for r in got) == expected
    texts = Counter((i, (h or "").encode()) for i, _, h in rows if i not in revisits)
    assert Counter((r.page_id, bytes(r.payload)) for r in got if r.record_type == "response") == texts
    assert warc.read_archives(warc.archive_parts(warc.mark_revisits(pages.limit(0)))).count() == 0


def test_archives_equal_sql_where_pages_repeat(spark, tmp_path):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    more = pages.unionAll(pages.where("page_id % 3 = 0").selectExpr("page_id + 10000", "url", "html"))
    more.coalesce(2).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    expected = con.execute(queries.OP9_SQL).fetchall()
    got = queries.op9_warc(spark, str(tmp_path))
    assert Counter(map(tuple, got.collect())) == Counter(expected)
    assert any(r[3] == "revisit" for r in expected)


# packing


def naive_best_fit(lengths, window):
    left, place = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [c for c in left if c >= lengths[i]]
        if fits:
            left[left.index(min(fits))] -= lengths[i]
        else:
            left.append(window - lengths[i])
    return sorted(left)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=40))
def test_best_fit_fills_windows_as_the_naive_rule_does(lengths):
    place, offset, n = packing.best_fit(lengths, 16)
    used = Counter()
    spans = defaultdict(list)
    for size, w, at in zip(lengths, place, offset):
        used[w] += size
        spans[w].append((at, at + size))
    assert sorted(16 - used[w] for w in range(n)) == naive_best_fit(lengths, 16)
    for s in spans.values():
        assert [a for a, _ in sorted(s)] == [0, *[b for _, b in sorted(s)][:-1]]


def check_pieces(texts, rows, window=2048, special_as_text=False):
    """Every document's ids come back from its pieces, every sequence is gapless."""
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    if special_as_text:
        coder.encode_special_tokens = True
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.offset + r.length))
    assert set(pieces) == set(texts)
    for i, text in texts.items():
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 1]
        own = sorted(pieces[i], key=lambda r: r.start)
        assert [r.start for r in own] == [0, *np.cumsum([r.length for r in own])[:-1].tolist()]
        assert sum(r.length for r in own) == len(ids) == own[0].doc_tokens
        for r in own:
            part = ids[r.start : r.start + r.length]
            assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes()) and r.ids == part
    for spans in sequences.values():
        spans.sort()
        assert [a for a, _ in spans] == [0, *[b for _, b in spans][:-1]] and spans[-1][1] <= window
    return sum(b for s in sequences.values() for _, b in s) / (window * len(sequences))


def test_documents_come_back_from_their_pieces(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    filled = check_pieces({r.doc_id: r.text for r in docs.collect()}, packing.pack(docs, queries.tokenizer(), with_ids=True).collect())
    assert filled > 0.98


def test_small_groups_and_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_TOKENS", 500)
    rng = random.Random(2)
    odd = ["ÉCOLE d'été é naïve", "a b\x1cc\x85d", "can't you're 12.5% <|endoftext|>x", "ΟΔΟΣ İstanbul ﬁ ½ ①", "猫😀👩‍👩‍👧", "́ x", None, "", " \n"]
    texts = dict(enumerate(odd + [" ".join(rng.choice(odd[:6]) for _ in range(rng.randint(1, 300))) for _ in range(20)]))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = packing.pack(docs, queries.tokenizer(), window=64, with_ids=True).collect()
    check_pieces(texts, rows, 64)
    rows = packing.pack(docs, queries.tokenizer(), window=64, with_ids=True, special_as_text=True).collect()
    check_pieces(texts, rows, 64, special_as_text=True)


def test_special_words_give_their_ids_unless_they_count_as_text(spark):
    docs = spark.createDataFrame([(1, "hello <|endoftext|> world"), (2, "hello<|endoftext|>world")], "doc_id long, text string")
    found = {r.doc_id: r.ids for r in packing.pack(docs, queries.tokenizer(), with_ids=True).collect()}
    assert found[1] == [3306, 49407, 1002, 1] and 49407 in found[2]
    plain = packing.pack(docs, queries.tokenizer(), with_ids=True, special_as_text=True)
    assert all(49407 not in r.ids for r in plain.collect())


def test_packing_of_odd_tables(spark):
    rows = packing.pack(edge_docs(spark), queries.tokenizer()).collect()
    assert len([r for r in rows if r.start == 0]) == len(EDGE_TEXTS)
    assert [r.doc_tokens for r in rows if r.doc_id in (1, 2, 3)] == [1, 1, 1]
    assert packing.pack(empty_docs(spark), queries.tokenizer()).count() == 0


def plain_description(text):
    """Shares and hashed features of one text, word by word."""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    raw = [w.encode() for w in words]
    n = max(len(words), 1)
    symbols = [sum(w.count(c) for c in "#*$%&|<>") for w in words]
    marks = [w.count("!") for w in words]
    capitals = [sum("A" <= c <= "Z" for c in w) for w in words]
    letters = [sum(65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in r) for r in raw]
    same = [i > 0 and words[i] == words[i - 1] for i in range(len(words))]
    before = [w in words[:i] for i, w in enumerate(words)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    often = [any(windows[tuple(words[j : j + 5])] >= 3 for j in range(max(0, i - 4), i + 1) if j + 5 <= len(words)) for i in range(len(words))]
    twice = sum(a == b for r in raw for a, b in zip(r, r[1:]))
    shares = [
        sum(symbols) / n, sum(s > 0 for s in symbols) / n, sum(marks) / n, twice / max(sum(map(len, raw)), 1),
        sum(capitals) / max(sum(letters), 1), sum(same) / n, sum(before) / n, sum(often) / n,
    ]
    features = np.zeros(quality_classifier.BUCKETS)

    def put(kind, value):
        h = np.array([value + (kind << 32)], np.uint64)
        features[int(quality_classifier.mix(h)[0] % np.uint64(quality_classifier.BUCKETS))] += 1 / n

    for i, r in enumerate(raw):
        length = min(sum(len(r) >= k for k in (4, 8, 13, 30)), 4)
        shouted = capitals[i] > 1 and letters[i] == capitals[i]
        put(1, length + 8 * min(symbols[i], 3) + 32 * shouted + 64 * min(marks[i], 3) + 256 * often[i] + 512 * same[i])
        put(2, int(before[i]))
        put(3, r[-1] + (256 * r[-2] if len(r) > 1 else 0))
        put(4, often[i] + 2 * before[i] + 4 * same[i])
    return len(words), np.array(shares), features


def test_classifier_equals_a_plain_reading_of_each_text(spark):
    """Words, votes, posterior, score and decision of every row; rows beside each other do not mix."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.where("length(text) < 20000").collect()}
    texts |= {-1 - i: t for i, t in enumerate(["a", "aa", "a", "ab", "ba!!! #x ba ba", "", None, "!é É éé", *(t for t in EDGE_TEXTS if t is None or len(t) < 20000)])}
    model = quality_classifier.fit(docs)
    own = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in quality_classifier.classify(own, model).collect()}
    assert set(got) == set(texts) and len({r.kept for r in got.values()}) == 2
    low, high = (np.array([x[i] for x in quality_classifier.LABELLERS]) for i in (1, 2))
    for i, text in texts.items():
        n, shares, features = plain_description(text)
        vote = (shares <= low).astype(int) - (shares >= high) if n else np.zeros(len(low), int)
        code = sum((v + 1) * 3**k for k, v in enumerate(vote.tolist()))
        p = 1 / (1 + np.exp(-(features @ model.weights[:-1] + model.weights[-1]))) if n else 0.0
        assert got[i].n_words == n and got[i].weak_label == model.labels.posterior[code]
        assert abs(got[i].p_quality - p) < 1e-4 and (abs(p - 0.5) < 1e-4 or got[i].kept == (p >= 0.5))
