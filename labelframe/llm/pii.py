"""Personal data found by expanding the hits of one Aho-Corasick automaton.

The automaton reports at-signs, plus signs, digits, URL schemes and identifier cues in
one pass over a text.  A small deterministic parser then expands each hit to the
boundaries of an email address, IP address, card, phone number, URL, secret or account,
and validates it (octets, Luhn and mod-97 sums, digit counts).  Within a kind, spans are
leftmost and do not overlap: a parser starts no earlier than its last span ended.  A hit
inside a span of its kind is not expanded, so the work is linear in the text.

Kinds email, ip, card and phone follow the patterns of FIXED beneath; url, secret and
account are added.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from labelframe.llm.batches import bounded, tidy
from labelframe.llm.words import process_state

KINDS = ("email", "ip", "card", "phone", "url", "secret", "account")
BASE_KINDS = KINDS[:4]

# FIXED values: what the base kinds must equal, as regular expressions
#   email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip     [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)   each part at most 255
#   card   [0-9]([\x20-]?[0-9])+                  14 to 19 digits, Luhn sum 0
#   phone  \+[0-9][\x20().0-9-]+[0-9]             10 to 15 digits
DIGITS = frozenset("0123456789")
LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
LOCAL = LETTERS | DIGITS | frozenset("._%+-")
HOST = LETTERS | DIGITS | frozenset("-")
PHONE = DIGITS | frozenset(" ().-")
KEY = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ") | DIGITS
URL_ENDS = frozenset(" \t\n\r\v\f<>\"'`{}|\\^")
SCHEMES = ("http://", "https://", "ftp://")
SECRET_CUES = ("password", "passwd", "token", "secret", "api_key", "apikey")
ACCOUNT_CUES = ("account", "acct", "iban")


def run_end(text: str, at: int, allowed: frozenset, most: int | None = None) -> int:
    """End of the run of allowed characters, or of its first ``most`` ones."""
    n = len(text) if most is None else min(len(text), at + most)
    while at < n and text[at] in allowed:
        at += 1
    return at


def email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """Expand an at-sign to both sides; nothing before ``floor``."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    end = run_end(text, at + 1, HOST)
    if start == at or end == at + 1:
        return None
    labels = 0
    while end < len(text) and text[end] == ".":
        after = run_end(text, end + 1, HOST)
        if after == end + 1:
            break
        end, labels = after, labels + 1
    return (start, end) if labels else None


def dotted(text: str, at: int) -> tuple[int, list[tuple[int, int]]]:
    """End of a chain of numbers joined by dots, and its runs of four."""
    runs = [(at, run_end(text, at, DIGITS))]
    n = len(text)
    while runs[-1][1] + 1 < n and text[runs[-1][1]] == "." and text[runs[-1][1] + 1] in DIGITS:
        begin = runs[-1][1] + 1
        runs.append((begin, run_end(text, begin, DIGITS)))
    quads = [runs[i : i + 4] for i in range(0, len(runs) - 3, 4)]
    good = [q for q in quads if all(len(text[a:b].lstrip("0")) <= 3 and int(text[a:b].lstrip("0") or 0) <= 255 for a, b in q)]
    return runs[-1][1], [(q[0][0], q[3][1]) for q in good]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def card(text: str, at: int) -> tuple[int, bool]:
    """End of digits with single blanks or hyphens between, and whether they are a card."""
    n, digits, end = len(text), [], at
    while True:
        stop = run_end(text, end, DIGITS)
        digits.append(text[end:stop])
        end = stop
        if end + 1 < n and text[end] in " -" and text[end + 1] in DIGITS:
            end += 1
        else:
            break
    joined = "".join(digits)
    return end, 14 <= len(joined) <= 19 and luhn(joined)


def phone(text: str, at: int) -> tuple[int, bool] | None:
    """End of a number after a plus sign, and whether its digits are 10 to 15."""
    if at + 1 >= len(text) or text[at + 1] not in DIGITS:
        return None
    end = run_end(text, at + 2, PHONE)
    while end > at + 3 and text[end - 1] not in DIGITS:
        end -= 1
    if end <= at + 3 or text[end - 1] not in DIGITS:
        return None
    return end, 10 <= sum(c in DIGITS for c in text[at:end]) <= 15


def url(text: str, begin: int, host: int) -> tuple[int, int] | None:
    end, n = host, len(text)
    while end < n and text[end] not in URL_ENDS:
        end += 1
    while end > host and text[end - 1] in ".,;:!?)]":
        end -= 1
    return (begin, end) if end > host else None


def secret(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The value after a cue, = or :, and an optional quote: 6 characters at least, none before ``floor``."""
    n = len(text)
    at = run_end(text, at, frozenset(" "))
    if at >= n or text[at] not in "=:":
        return None
    at = run_end(text, at + 1, frozenset(" "))
    if at < n and text[at] in "\"'":
        at += 1
    if at < floor:
        return None
    end = at
    while end < n and not text[end].isspace() and text[end] not in "\"',;":
        end += 1
    return (at, end) if end - at >= 6 else None


def access_key(text: str, at: int) -> tuple[int, int] | None:
    if at and text[at - 1] in KEY:
        return None
    end = run_end(text, at, KEY, 21)
    return (at, end) if end - at == 20 else None


def account(text: str, at: int) -> tuple[int, int] | None:
    """An IBAN (mod 97) or 6 to 17 digits after a cue and at most 12 joining characters."""
    n, limit = len(text), at + 12
    while at < min(n, limit) and text[at] not in DIGITS and not (text[at : at + 2].isupper() and text[at + 2 : at + 4].isdigit()):
        if text[at] not in " :#.=-" and not text[at].isalpha():
            return None
        at += 1
    if at >= n:
        return None
    if text[at] in DIGITS:
        end = run_end(text, at, DIGITS, 18)
        return (at, end) if 6 <= end - at <= 17 else None
    end, code = at, ""
    while end < n and (text[end] in KEY or (text[end] == " " and end + 1 < n and text[end + 1] in KEY)) and len(code) < 34:
        code += text[end].strip()
        end += 1
    if len(code) < 15 or not code.isascii() or not code[:2].isalpha():
        return None
    return (at, end) if int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1 else None


def automaton():
    import ahocorasick

    made = ahocorasick.Automaton()
    for c in "@+0123456789":
        made.add_word(c, (c if c in "@+" else "digit", 1))
    for word in SCHEMES:
        for form in (word, word.upper(), word.capitalize()):
            made.add_word(form, ("url", len(form)))
    made.add_word("AKIA", ("key", 4))
    for kind, cues in (("secret", SECRET_CUES), ("account", ACCOUNT_CUES)):
        for word in cues:
            for form in (word, word.upper(), word.capitalize()):
                made.add_word(form, (kind, len(form)))
    made.make_automaton()
    return made


def find(text: str | None, cues) -> list[tuple[int, str, int]]:
    """(start, kind, end) of all spans, by start and then kind."""
    out: list[tuple[int, int, int]] = []
    ends = dict.fromkeys(KINDS, 0)
    chain = 0  # end of the last dotted chain
    cards = 0  # end of the last run of card digits

    def add(kind: str, span: tuple[int, int] | None) -> None:
        if span and span[0] >= ends[kind]:
            out.append((span[0], KINDS.index(kind), span[1]))
            ends[kind] = span[1]

    for last, (cue, size) in cues.iter(text or ""):
        at = last + 1 - size
        if cue == "digit":
            if at >= chain:
                chain, found = dotted(text, at)
                for span in found:
                    add("ip", span)
            if at >= cards:
                cards, good = card(text, at)
                if good:
                    add("card", (at, cards))
        elif cue == "@":
            add("email", email(text, at, ends["email"]))
        elif cue == "+":
            if at >= ends["phone"] and (found := phone(text, at)):
                if found[1]:
                    add("phone", (at, found[0]))
        elif cue == "url":
            if at >= ends["url"]:
                add("url", url(text, at, last + 1))
        elif cue == "key":
            add("secret", access_key(text, at))
        elif cue == "secret":
            add("secret", secret(text, last + 1, ends["secret"]))
        else:
            add("account", account(text, last + 1))
    return [(a, KINDS[k], b) for a, k, b in sorted(out)]


def digest_row(spans: list[tuple[int, str, int]]) -> tuple:
    """Counts of the base kinds, SHA-256 of the base spans, all spans."""
    names = [k for _, k, _ in spans]
    base = ",".join(f"{k}:{a}:{b}" for a, k, b in spans if k in BASE_KINDS)
    return (*(names.count(k) for k in BASE_KINDS), hashlib.sha256(base.encode()).hexdigest(), ",".join(f"{k}:{a}:{b}" for a, k, b in spans))


def redacted(text: str, spans: list[tuple[int, str, int]]) -> str:
    """The text with a mark in place of each span; overlapping spans share the first's mark."""
    out, at = [], 0
    for begin, kind, end in spans:
        if begin >= at:
            out += [text[at:begin], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find_personal_data(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every text.

    ``spans`` joins kind:start:end by commas, in code points, end exclusive, ordered by
    start and then kind; ``base_sha256`` is the digest of those of the base kinds.  A
    null text is empty.  Repeated rows are searched each; a null id stays.
    """
    names = [id_column, *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cues = process_state("pii_cues", automaton)
        for batch in batches:
            rows = [digest_row(find(t.as_py(), cues)) for t in batch.column(1)]
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)

    kind = docs.schema[id_column].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in BASE_KINDS)
    return bounded(docs).select(id_column, text).mapInArrow(tidy(run), f"`{id_column}` {kind}, {counts}, base_sha256 string, spans string")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns, with personal data in ``text`` replaced by marks such as [EMAIL]; null stays null."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cues = process_state("pii_cues", automaton)
        for batch in batches:
            column = batch.column(place)
            clean = [None if (t := v.as_py()) is None else redacted(t, find(t, cues)) for v in column]
            yield batch.set_column(place, batch.schema.field(place), pa.array(clean, column.type))

    return bounded(docs).mapInArrow(tidy(run), docs.schema)
