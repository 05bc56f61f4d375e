"""Toxic documents by multiple-instance learning.

A document is a bag of sentences; only the document has a label. A sentence's score is a
logistic function of its words' features (the word, its beginning, its character groups),
and the document's is the noisy-or of its sentences: it is toxic if any sentence is. The
weights are fitted to the documents' labels through the noisy-or, so they tell afterwards
which sentences offend.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm.common import fold

#: Labelled documents of each class that the model is fitted to at most, those first by a hash.
SAMPLE = {1: 2000, 0: 4000}
#: Rows with this remainder are held out.
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
#: A feature must be in this many toxic documents of the sample, and this many times likelier there.
LEAST_DOCS, LEAST_LIFT = 6, 3.0
STEPS, RATE, RIDGE = 300, 0.1, 2e-4

_SENTENCE = re.compile(r"[.!?]+(?=\s|$)|\n+")
_TRIM = " \t\r\n.,;:!?\"'()[]{}<>|*#$%&_-+=~`^/\\@0123456789"


def sentences(text: str) -> list[tuple[int, int]]:
    """Places of the sentences of a text; none if it is empty."""
    out, at = [], 0
    for m in _SENTENCE.finditer(text):
        if text[at : m.end()].strip():
            out.append((at, m.end()))
        at = m.end()
    if text[at:].strip():
        out.append((at, len(text)))
    return out


def plain_words(sentence: str) -> list[str]:
    return [w for w in (x.strip(_TRIM) for x in sentence.lower().split()) if w]


def features(word: str) -> list[str]:
    """The word, and what its beginning and its inside are made of."""
    out = [word] + ["^" + word[:n] for n in (3, 4, 5, 6) if len(word) > n]
    marked = f"^{word}$"
    return out + ["~" + marked[i : i + 4] for i in range(len(marked) - 3)]


class Model:
    """Weights of features; the weight of a word is the sum of those of its features."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self.words: dict[str, float] = {}

    def word(self, word: str) -> float:
        value = self.words.get(word)
        if value is None:
            if len(self.words) > 500_000:
                self.words.clear()
            value = self.words[word] = sum(self.weights.get(f, 0.0) for f in set(features(word)))
        return value

    def sentence_scores(self, text: str) -> np.ndarray:
        z = [sum(map(self.word, set(plain_words(text[a:b])))) for a, b in sentences(text)]
        return 1 / (1 + np.exp(-(np.clip(np.array(z, dtype=float) + self.bias, -50, 50))))

    def score(self, text: str) -> float:
        """Noisy-or of the sentences; 0 for a text without any."""
        return float(-np.expm1(np.log1p(-np.minimum(self.sentence_scores(text), 1 - 1e-12)).sum()))

    def offending(self, text: str, least: float = 0.5) -> list[tuple[int, int, float]]:
        """Sentences (start, end, score) that score ``least`` or more."""
        scores = self.sentence_scores(text)
        return [(a, b, float(s)) for (a, b), s in zip(sentences(text), scores) if s >= least]


def fit(texts: list[str], labels: list[int]) -> Model:
    """Fit the weights by gradient steps on the likelihood of the labels under the noisy-or.

    Without a toxic or without a clean document the model is the share of toxic ones at most
    one half: every score is then near 0.
    """
    y = np.array(labels, dtype=float)
    if not len(y) or y.min() == y.max():
        return Model({}, -12.0)
    bags = [[set(plain_words(t[a:b])) for a, b in sentences(t)] for t in texts]
    n1, n0 = y.sum(), len(y) - y.sum()
    toxic: Counter[str] = Counter()
    for bag, label in zip(bags, y):
        if label:
            toxic.update({f for w in set().union(*bag) for f in features(w)})
    toxic = Counter({f: c for f, c in toxic.items() if c >= LEAST_DOCS})
    clean: Counter[str] = Counter()
    for bag, label in zip(bags, y):
        if not label:
            clean.update({f for w in set().union(*bag) for f in features(w) if f in toxic})
    names = sorted(f for f, c in toxic.items() if c / n1 >= LEAST_LIFT * (clean[f] + 0.5) / n0)
    place = {f: i for i, f in enumerate(names)}
    hits: dict[str, list[int]] = {}
    for w in {w for bag in bags for words in bag for w in words}:
        if own := [place[f] for f in set(features(w)) if f in place]:
            hits[w] = own
    cols, rows, docs = [], [], []
    n_sentences = 0
    for d, bag in enumerate(bags):
        for sentence in bag:
            own = [i for w in sentence for i in hits.get(w, ())]
            cols += own
            rows += [n_sentences] * len(own)
            docs.append(d)
            n_sentences += 1
    cols, rows, docs = np.array(cols, int), np.array(rows, int), np.array(docs, int)
    weights, bias = np.zeros(len(names)), -6.0
    m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(rows, weights[cols], n_sentences) + bias
        p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        none = np.bincount(docs, np.log1p(-np.minimum(p, 1 - 1e-12)), len(y))
        whole = np.clip(-np.expm1(none), 1e-9, 1.0)
        # d loss / d z: p in clean documents; -p (1 - P) / P in toxic ones.
        grad = np.where(y[docs] > 0, -p * ((1 - whole) / whole)[docs], p) / len(y)
        full = np.append(np.bincount(cols, grad[rows], len(names)) + RIDGE * weights, grad.sum())
        m, v = 0.9 * m + 0.1 * full, 0.999 * v + 0.001 * full**2
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1], min(-4.0, bias - move[-1])
    return Model({f: float(w) for f, w in zip(names, weights) if abs(w) > 1e-3}, float(bias))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit to a bounded sample of the labelled rows that are not held out.

    Labels that are null or neither 0 nor 1 do not count, nor do null texts; of several
    labels of a document the highest does.
    """
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    order = F.xxhash64("doc_id")
    picked = [known.where(F.col("toxic") == c).orderBy(order, "doc_id").limit(n) for c, n in SAMPLE.items()]
    # At most 6,000 ids: small enough to send to every task, so that no text is shuffled.
    sample = F.broadcast(picked[0].unionByName(picked[1]))
    rows = docs.where("text is not null").select("doc_id", "text").join(sample, "doc_id").select("doc_id", "text", "toxic")
    got = sorted((r["doc_id"], r["text"], r["toxic"]) for r in rows.collect())
    return fit([t for _, t, _ in got], [y for _, _, y in got])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row for each document: doc_id, held_out, score, predicted, and its most offending sentence.

    Empty and null texts score 0. ``worst_start`` and ``worst_end`` are code points; both are
    null where no sentence scores one half."""
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Model(*sent.value)
        for batch in batches:
            rows = []
            for text in batch["text"]:
                value = own.score(text)
                worst = max(own.offending(text), key=lambda s: s[2], default=(None, None, 0.0)) if value >= 0.5 else (None, None, 0.0)
                rows.append((value, int(value >= THRESHOLD), worst[0], worst[1]))
            out = pd.DataFrame(rows, columns=["score", "predicted", "worst_start", "worst_end"])
            out["worst_start"], out["worst_end"] = out["worst_start"].astype("Int64"), out["worst_end"].astype("Int64")
            out.insert(0, "doc_id", batch["doc_id"].array)
            yield out

    kind = dict(docs.dtypes)["doc_id"]
    scored = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInPandas(
        run, f"doc_id {kind}, score double, predicted int, worst_start long, worst_end long"
    )
    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted", "worst_start", "worst_end")
