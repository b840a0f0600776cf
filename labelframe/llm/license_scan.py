"""Licence notices found by patience alignment of the text with templates.

Words are lower-case runs of letters and digits.  Words that stand once in both the
text region and the template are anchors; the longest increasing subsequence of their
places keeps the order, and the gaps between anchors are aligned in the same way after
equal words beside the anchors are matched.  Coverage is the share of template words that
are matched.

Only words of some template can match, so an alignment works on those alone.  Their
presence in the text bounds the coverage; a text whose bound is under the threshold is
left without alignment, which loses nothing.  A notice may stand several times and
anywhere: every run of at most 2 ``REACH`` template lengths and a word, from one template
word to another, is a region.  A region is aligned unless the template words in it, or
the longest common subsequence of it and the template, are too few; an alignment is a
common subsequence, so this loses nothing either.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from labelframe.llm.batches import bounded
from labelframe.llm.words import slices, split_words

THRESHOLD = 0.8
REACH = 2  # template lengths that a region extends to either side of its middle
BETWEEN = ~np.isin(np.arange(256), [*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)])

# fixed values: short notices of well-known licences
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at"
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the Software), to deal in the Software without restriction"
    ),
    "all-rights-reserved": "All rights reserved.",
}


def increasing(values: Sequence[int]) -> list[int]:
    """Places of a longest strictly increasing subsequence, by piles of cards."""
    tops: list[int] = []
    ends: list[int] = []
    back = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        back[i] = ends[k - 1] if k else -1
        tops[k : k + 1] = [v]
        ends[k : k + 1] = [i]
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(text: Sequence[int], template: Sequence[int]) -> list[tuple[int, int]]:
    """Matched (text place, template place) pairs, increasing in both."""
    out, todo = [], [(0, len(text), 0, len(template), False, False)]
    while todo:
        a, b, c, d, after, before = todo.pop()
        while after and a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while before and a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        left, right = Counter(text[a:b]), Counter(template[c:d])
        place = {w: j for j, w in enumerate(template[c:d], c) if right[w] == 1 and left[w] == 1}
        pairs = [(i, place[text[i]]) for i in range(a, b) if text[i] in place]
        anchors = [pairs[k] for k in increasing([j for _, j in pairs])]
        if not anchors:
            continue
        for i, j in anchors:
            todo.append((a, i, c, j, after, True))
            a, c, after = i + 1, j + 1, True
        todo.append((a, b, c, d, True, before))
        out.extend(anchors)
    return sorted(out)


def most_matches(places: np.ndarray, ids: np.ndarray, template: Sequence[int], reach: int) -> np.ndarray:
    """For each hit, how many template words the ``reach`` words up to it can match at most."""
    times = Counter(template)
    n = len(ids)
    gone = np.searchsorted(places, places + reach)  # the first hit whose run does not reach back
    for word, most in times.items():
        at = np.flatnonzero(ids == word)
        if len(at) > most:  # a word matches no more often than the template has it
            gone[at[:-most]] = np.minimum(gone[at[:-most]], at[most:])
    change = np.ones(n + 1, np.int64)
    change -= np.bincount(gone, minlength=n + 1)
    return np.cumsum(change[:n])


def notices(places: np.ndarray, ids: np.ndarray, template: Sequence[int], least: int) -> tuple[int, tuple[int, int, int] | None]:
    """How many disjoint regions match ``least`` template words, and the best (matched, first, last hit).

    Going by the ends of regions and taking the first one that shares no word with those
    taken gives the most.  Of equal matches the best is the first to end, and of those
    the shortest.
    """
    reach, size = 2 * REACH * len(template) + 1, len(template)
    mask, bits = (1 << size) - 1, {}
    for j, w in enumerate(reversed(template)):
        bits[w] = bits.get(w, 0) | 1 << j
    taken, n, best = -1, 0, None
    words = ids.tolist()
    first = np.searchsorted(places, places - reach, "right").tolist()
    for q in np.flatnonzero(most_matches(places, ids, template, reach) >= least).tolist():
        row, found = mask, False
        for p in range(q, first[q] - 1, -1):
            free = p > taken and not found
            if not free and best and best[0] == size:
                break
            hit = row & bits[words[p]]
            row = (row + hit | row - hit) & mask  # zeros count the longest common subsequence
            common = size - row.bit_count()
            if common < least or not free and best and common <= best[0]:
                continue
            pairs = align(words[p : q + 1], template)
            if len(pairs) < least:
                continue
            found = found or free
            if best is None or len(pairs) > best[0]:
                best = (len(pairs), p + pairs[0][0], p + pairs[-1][0])
        if found:
            n, taken = n + 1, q
    return n, best


def words_of(text: str) -> list[bytes]:
    """Words of one text as bytes, as the scan cuts them."""
    part = next(slices(pa.array([text])))
    spans = split_words(part, lower=True, apart=BETWEEN)
    raw = part.data.tobytes().lower()
    return [raw[b:e] for b, e in zip(spans.begins.tolist(), spans.ends.tolist())]


def license_scan(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per text and licence with coverage >= threshold: (id, license, coverage, n_found, start, end).

    ``n_found`` regions without a word in common reach the threshold; coverage, start and
    end (code points, end exclusive) are those of the best, the first on a tie.  Null and empty texts give no
    row, repeated rows give their rows each, a null id stays.  A template without words
    is an error.  The templates travel with the function; nothing is shuffled.
    """
    names = sorted(templates)
    ids: dict[bytes, int] = {}
    coded = [[ids.setdefault(w, len(ids)) for w in words_of(templates[n])] for n in names]
    if not all(coded):
        raise ValueError("a template has no words")
    joined = b" ".join(ids).decode("utf-8")
    hashes = split_words(next(slices(pa.array([joined]))), apart=BETWEEN).hashes if ids else np.zeros(0, np.uint64)
    order = np.argsort(hashes)
    ordered = hashes[order]
    weight = np.zeros((len(ids), len(names)))
    for j, words in enumerate(coded):
        np.add.at(weight[:, j], words, 1 / len(words))

    def scan(part, rows_out) -> None:
        words = split_words(part, lower=True, apart=BETWEEN)
        at = np.minimum(np.searchsorted(ordered, words.hashes), len(ordered) - 1)
        hits = np.flatnonzero(ordered[at] == words.hashes)
        kind, row = order[at[hits]], words.rows[hits]
        present = np.zeros((part.rows, len(ids)))
        present[row, kind] = 1
        bound = present @ weight
        offsets, hit_offsets = words.per_row(part.rows), np.searchsorted(row, np.arange(part.rows + 1))
        for r, j in zip(*np.nonzero(bound >= threshold - 1e-9)):
            mine = slice(hit_offsets[r], hit_offsets[r + 1])
            own = np.isin(kind[mine], coded[j])
            spots, labels = hits[mine][own] - offsets[r], kind[mine][own]
            n, best = notices(spots, labels, coded[j], max(1, math.ceil(threshold * len(coded[j]) - 1e-9)))
            if best:
                start, end = words.begins[offsets[r] + spots[best[1]]], words.ends[offsets[r] + spots[best[2]]]
                head = part.data[part.offsets[r] : end].tobytes()
                cut = len(head[: start - part.offsets[r]].decode("utf-8", "replace"))
                rows_out.append((part.first + int(r), names[j], best[0] / len(coded[j]), n, cut, len(head.decode("utf-8", "replace"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            for part in slices(batch.column(1)):
                scan(part, found)
            columns = list(zip(*found)) or [[]] * 6
            kinds = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(arrays[0]), *arrays[1:]], names=[id_column, "license", "coverage", "n_found", "start", "end"])

    kind = docs.schema[id_column].dataType.simpleString()
    return bounded(docs).select(id_column, text).mapInArrow(
        run, f"`{id_column}` {kind}, license string, coverage double, n_found long, start long, `end` long"
    )
