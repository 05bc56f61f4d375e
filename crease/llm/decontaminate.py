"""Documents that hold a test item, up to some edits.

An item of m characters may differ by ``m * RATE`` edits. It is cut into one piece more than
that, so at least one piece is in the document as it is (pigeonhole). An automaton finds all
pieces of all items in one pass over a text; around each hit, Myers' bit-parallel distance
decides whether the whole item is there within its edits, unless a count of shared grams
shows already that it cannot be.

Texts and items are compared in lower case with single blanks.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Edits for each character of an item.
RATE = 0.1
#: Items with fewer characters are too short to tell from chance and must be there exactly.
SHORT = 20
#: Characters of a gram. An edit breaks at most so many grams of an item; without enough of them no place can hold it.
GRAM = 5
#: Characters of the items in a block. Each block is one pass; it bounds what is sent to the tasks.
BLOCK_CHARS = 4_000_000


def plain(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def blocks(items: DataFrame, size: int | None = None) -> Iterator[list[tuple[int | None, str]]]:
    """Distinct items (item_id, text) in blocks of at most ``size`` (BLOCK_CHARS) characters, or of one item.

    The texts of one id are one item and never cut apart; a text without an id is an item
    of its own. The rows come one by one, so the driver holds one block. Null and empty
    texts are no items."""
    size = BLOCK_CHARS if size is None else size
    block: list[tuple[int | None, str]] = []
    chars = 0
    rows = items.select("item_id", "text").distinct().orderBy("item_id", "text")
    for item_id, text in rows.toLocalIterator():
        if not (text := plain(text)):
            continue
        if block and chars + len(text) > size and (item_id is None or item_id != block[-1][0]):
            yield block
            block, chars = [], 0
        block.append((item_id, text))
        chars += len(text)
    if block:
        yield block


def nearest(masks: dict[str, int], m: int, text: str, budget: int) -> tuple[int, int]:
    """Fewest edits that turn the pattern into some part of ``text``, and where that part ends.

    ``masks`` has the places of each character in the pattern of length ``m``. The search
    stops when no part can be within ``budget`` any more or one without edits is found."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    left = len(text)
    for i, char in enumerate(text):
        eq = masks.get(char, 0)
        x = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | ~(x | plus) & full, plus & x
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = up << 1 & full
        plus = (down << 1 & full) | ~((eq | minus) | up) & full
        minus = up & (eq | minus)
        left -= 1
        if score < best:
            best, end = score, i + 1
            if not best:
                break
        if score - left > budget and best > budget:
            break
    return best, end


class Matcher:
    """The pieces of a block of items, and the search in a text."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float = RATE):
        self.items, self.masks, self.grams = [], [], []
        pieces: dict[str, list[tuple[int, int]]] = {}
        for n, (item_id, text) in enumerate(items):
            m = len(text)
            budget = int(m * rate) if m >= SHORT else 0
            # Texts without an id are told apart by themselves.
            self.items.append(((None, text) if item_id is None else item_id, text, budget))
            masks: dict[str, int] = {}
            for i, char in enumerate(text):
                masks[char] = masks.get(char, 0) | 1 << i
            self.masks.append(masks)
            self.grams.append((frozenset(text[i : i + GRAM] for i in range(m - GRAM + 1)), m - GRAM + 1 - budget * GRAM))
            cuts = [m * i // (budget + 1) for i in range(budget + 2)]
            for a, b in zip(cuts, cuts[1:]):
                pieces.setdefault(text[a:b], []).append((n, a))
        self.automaton = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def find(self, text: str) -> dict[int | tuple[None, str], tuple[int, int, int]]:
        """Items in a plain text: item_id, or (None, item) without one, to (edits, budget, end), the fewest edits, then the first place."""
        near: dict[int, list[int]] = {}
        for end, (size, places) in self.automaton.iter(text):
            for n, offset in places:
                near.setdefault(n, []).append(end + 1 - size - offset)
        found: dict[int | tuple[None, str], tuple[int, int, int]] = {}
        for n, starts in near.items():
            item_id, item, budget = self.items[n]
            best = found.get(item_id, (len(item), 0, 0))
            # Hits whose windows overlap are searched as one stretch.
            starts.sort()
            a = b = starts[0]
            stretches = []
            for s in starts[1:]:
                if s - b > len(item) + 2 * budget:
                    stretches.append((a, b))
                    a = s
                b = s
            stretches.append((a, b))
            for a, b in stretches:
                begin = max(0, a - budget)
                window = text[begin : b + len(item) + budget]
                grams, least = self.grams[n]
                if item in window:
                    edits, end = 0, window.index(item) + len(item)
                elif sum([window[i : i + GRAM] in grams for i in range(len(window) - GRAM + 1)]) < least:
                    continue
                else:
                    edits, end = nearest(self.masks[n], len(item), window, budget)
                if edits <= budget and (item_id not in found or edits < best[0]):
                    best = found[item_id] = (edits, budget, begin + end)
        return found


def matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row for each document and item in it: doc_id, item_id, n_edits, budget.

    Documents without an item have no row, nor have null texts; a document row that is
    repeated has its rows repeated, and one without a doc_id has rows without one. Items with
    equal id and different texts are all searched, and the nearest counts; each item without
    an id has its own row, with a null item_id. No shuffle of the documents.
    """
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, item_id long, n_edits int, budget int"
    found = None
    for block in blocks(items):
        one = with_known(docs).where("text is not null").mapInPandas(_search(docs, block), schema)
        found = one if found is None else found.unionByName(one)
    return found if found is not None else docs.sparkSession.createDataFrame([], schema)


def with_known(docs: DataFrame) -> DataFrame:
    """doc_id (0 for null, as pandas would make doubles of the others), known, text."""
    kind = dict(docs.dtypes)["doc_id"]
    known = F.col("doc_id").isNotNull().alias("known")
    return docs.select(F.coalesce("doc_id", F.lit(0).cast(kind)).alias("doc_id"), known, "text")


def _search(docs: DataFrame, block: list[tuple[int, str]]):
    sent = docs.sparkSession.sparkContext.broadcast(block)
    whole = dict(docs.dtypes)["doc_id"] != "string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(sent.value)
        for batch in batches:
            at, rows = [], []
            for n, text in enumerate(batch["text"]):
                for item_id, (edits, budget, _) in matcher.find(plain(text)).items():
                    at.append(n)
                    rows.append((None if isinstance(item_id, tuple) else item_id, edits, budget))
            out = pd.DataFrame(rows, columns=["item_id", "n_edits", "budget"], dtype=object)
            out = out.astype({"item_id": "Int64", "n_edits": "int32", "budget": "int32"})
            out.insert(0, "doc_id", [i if known else None for i, known in zip(batch["doc_id"].iloc[at], batch["known"].iloc[at])])
            yield out.astype({"doc_id": "Int64" if whole else object})

    return run


def _clean(docs: DataFrame, block: list[tuple[int, str]]):
    """A column function that is true for texts without an item of the block."""
    sent = docs.sparkSession.sparkContext.broadcast(block)

    def clean(texts):
        matcher = Matcher(sent.value)
        for batch in texts:
            yield pd.Series([not matcher.find(plain(t)) for t in batch], dtype=bool)

    clean.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(clean, "boolean")


def without_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no item, all their columns as they are; null texts hold none."""
    for block in blocks(items):
        docs = docs.where(_clean(docs, block)(docs["text"]))
    return docs
