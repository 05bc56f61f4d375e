"""Secrets: fixed patterns, and credential values that are dear to guess.

A value after a credential word is cut into words of a list, dates, repeats, keyboard walks
and brute-force spans so that the product of the guesses of its pieces is least (dynamic
programming over end positions). Values that take at least ``MIN_LOG10`` guesses even so are
reported as spans of kind ``guess``, besides the spans of the patterns.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in the order in which spans that begin together are listed.
KINDS = ("assign", "access", "hex", "guess")
#: Guesses, as a power of ten, from which on a value counts as a secret.
MIN_LOG10 = 10.0

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: A credential word, a sign of assignment, and the value up to white space or a closing sign.
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase)|pwd|secret|token|credential|auth(?:orization)?|(?:api|access|private)[_-]?key)s?["'`]?[\x20\t]*"""
    r"""(?::=|=>|[:=])[\x20\t]*(?:bearer[\x20]+|basic[\x20]+)?["'`]?([^\s"'`<>,;()]{6,})""",
    re.IGNORECASE | re.ASCII,
)
#: One of these is in every text in which ASSIGN or CONTEXT can match, once it is in lower case.
HINTS = ("pass", "pwd", "secret", "token", "credential", "auth", "key")

#: Words that guessers try first, the likeliest first.
WORDS = (
    "password pass admin welcome login letmein monkey dragon master qwerty abc hello freedom whatever trust access "
    "shadow sunshine princess football baseball superman batman secret test guest user root default changeme change "
    "temp demo example sample token key love money summer winter spring autumn monday january company server system "
    "public private service account dummy none null true false your my the this is not here"
).split()
#: The rows of a keyboard, for walks along them.
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz")
_RANK = {w: i + 1 for i, w in enumerate(WORDS)}
_LONGEST = max(map(len, WORDS))
#: Signs that stand for letters.
_PLAIN = str.maketrans({"@": "a", "4": "a", "3": "e", "1": "i", "0": "o", "5": "s", "$": "s", "7": "t"})
_NEXT = {(a, b) for row in ROWS for a, b in zip(row, row[1:])}
_NEXT |= {(b, a) for a, b in _NEXT}
_DATE = re.compile(r"(?:(?:19|20)\d\d([-/._]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d)")
#: Guesses of a date: days of a year in a hundred years; of a year: a hundred and twenty.
_DATE_COST, _YEAR_COST = math.log10(36500), math.log10(120)
_JOIN = math.log10(2)
#: So far does a word or a date reach into a run that begins after it.
_INTO = max(_LONGEST, 10)


def _alphabet(value: str) -> int:
    """Signs that a brute-force search of this value has to try at each place."""
    if re.fullmatch(r"[0-9]+", value):
        return 10
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value):
        return 16
    size = 10 * bool(re.search(r"[0-9]", value)) + 26 * bool(re.search(r"[a-z]", value)) + 26 * bool(re.search(r"[A-Z]", value))
    return max(size + 33 * bool(re.search(r"[^0-9a-zA-Z]", value)), 10)


def log10_guesses(value: str) -> float:
    """Power of ten of the guesses that the cheapest segmentation of the value takes; 0 if empty.

    Linear in the length: words are bounded, dates too. A repeat or walk may begin at any place of
    its run, but one that begins inside is cheaper than a longer one only where a piece ends that
    began before the run, so not far from the run's begin.
    """
    n = len(value)
    low = value.lower()
    plain = low.translate(_PLAIN)
    each = math.log10(_alphabet(value)) if n else 0.0
    dates: dict[int, list[tuple[int, float]]] = {}
    for i in range(n):
        if low[i].isdigit() and (m := _DATE.match(low, i)):
            dates.setdefault(m.end(), []).append((i, _YEAR_COST if m.end() - i == 4 else _DATE_COST))
    best = [0.0] + [math.inf] * n
    repeat = walk = 1
    for end in range(1, n + 1):
        cost = best[end - 1] + each
        for size in range(3, min(_LONGEST, end) + 1):
            begin = end - size
            rank = _RANK.get(low[begin:end])
            swapped = 0.0
            if rank is None:
                rank, swapped = _RANK.get(plain[begin:end]), _JOIN
            if rank:
                turned = 0.0 if value[begin:end].islower() else _JOIN
                cost = min(cost, best[begin] + math.log10(rank + 1) + swapped + turned + _JOIN)
        for begin, guesses in dates.get(end, ()):
            cost = min(cost, best[begin] + guesses + _JOIN)
        repeat = repeat + 1 if end > 1 and low[end - 1] == low[end - 2] else 1
        if repeat >= 3:
            for begin in range(end - repeat, min(end - repeat + _INTO, end - 3) + 1):
                cost = min(cost, best[begin] + each + math.log10(end - begin) + _JOIN)
        walk = walk + 1 if end > 1 and (low[end - 2], low[end - 1]) in _NEXT else 1
        if walk >= 3:
            for begin in range(end - walk, min(end - walk + _INTO, end - 3) + 1):
                cost = min(cost, best[begin] + math.log10(47 * (end - begin) * 2) + _JOIN)
        best[end] = cost
    # A value that repeats one piece costs that piece and the number of repeats.
    period = (low + low).find(low, 1) if n else 0
    if 0 < period < n:
        return min(best[n], log10_guesses(value[:period]) + math.log10(n // period))
    return best[n]


def spans_of(text: str) -> tuple[list[tuple[int, int, int]], float]:
    """Spans (start, place of the kind, end) of a text in order, and the dearest credential value."""
    found, dearest = [], 0.0
    low = text.lower()
    if any(h in low for h in HINTS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 6:
                found.append((m.start(), 0, m.end()))
        for m in CONTEXT.finditer(text):
            cost = log10_guesses(m[1])
            dearest = max(dearest, cost)
            if cost >= MIN_LOG10:
                found.append((m.start(1), 3, m.end(1)))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found), dearest


SCHEMA = (
    "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long, max_log10_guesses double"
)


def scan(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, counts of each kind, digest of the base spans, all spans.

    Null text counts as empty: no spans, the digest of the empty string. Offsets are code
    points, the end is exclusive. Rows are independent: no shuffle, repeated rows stay.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                spans, dearest = spans_of(text or "")
                say = lambda some: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in some)
                n = [sum(k == i for _, k, _ in spans) for i in range(4)]
                base = hashlib.sha256(say([s for s in spans if s[1] < 3]).encode()).hexdigest()
                rows.append((n[0], n[1], n[2], base, say(spans), n[3], dearest))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])
            out.insert(0, "doc_id", batch["doc_id"].array)
            yield out

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(run, f"doc_id {kind}, {SCHEMA}")
