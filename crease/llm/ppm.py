"""Scores of texts under prediction by partial matching, trained on a part of the corpus.

The model is the byte-context trie of order 4: how often each byte followed each context of
up to four bytes in the training documents. A byte is coded in the longest context that was
seen; if it never followed there, the escape (as many times as the context has successors)
leads to the context without its first byte, where the successors of the longer one are
excluded, and so on to equal shares of the bytes never seen. Texts are coded in lower case
after four zero bytes, and end with one.

What a byte costs depends on its five-byte window alone, so the trie is a table of windows,
which Spark sums, joins and keeps in parts. Documents are dealt into buckets of bounded
size; each gets the costs of its own windows and the counts of its own words, and nothing
else, so no task and no driver ever holds the model of the corpus.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from crease.llm.common import fold
from crease.session import staged

#: Rows with remainder 0 are held out.
FOLDS, HELD_OUT = 10, 0
#: Bytes of a bucket, about, and bytes whose windows are numbered at once.
BUCKET_BYTES, CHUNK = 14_000_000, 2_000_000
SMOOTH = 0.1
#: Bytes of the longest context; a window has one more, and its number must fit into a long.
ORDER = 4
#: Windows, about, whose costs are computed together.
MODEL_ROWS = 200_000
#: Windows whose costs may be sent to every task (32 MB); beyond that the join is shuffled.
MOST_SENT = 2_000_000


def _numbered(codes: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and the number of each code among them. All are under ``below``."""
    if below > 1 << 25:
        return np.unique(codes, return_inverse=True)
    met = np.zeros(below, bool)
    met[codes] = True
    return np.flatnonzero(met), (np.cumsum(met, dtype=np.int32) - 1)[codes]


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct windows (as numbers), the number of each window of each text in turn among
    them, and where each text's windows begin. A text of n bytes has n + 1."""
    raw = np.frombuffer(b"".join(bytes(ORDER) + t + b"\0" for t in texts), np.uint8)
    sizes = np.array([len(t) + 1 for t in texts])
    own = np.ones(len(raw), bool)
    ends = np.cumsum(sizes + ORDER)
    for back in range(1, ORDER + 1):
        own[ends - back] = False
    every = np.flatnonzero(np.bincount(raw, minlength=256))
    a = len(every)
    turn = np.zeros(256, np.int32)
    turn[every] = np.arange(a, dtype=np.int32)
    sign = turn[raw]
    # The first three bytes as one number, then one byte more at a time, numbered anew each time.
    last = len(raw) - ORDER
    code = (sign[:last] * a + sign[1 : last + 1]) * a + sign[2 : last + 2]
    named, number = _numbered(code, a**3)
    named = every[named // (a * a)] << 16 | every[named // a % a] << 8 | every[named % a]
    for i in range(3, ORDER + 1):
        wide = len(named) * a >= 1 << 31
        code = number.astype(np.int64 if wide else np.int32) * a + sign[i : last + i]
        if i == ORDER:
            code = code[own[:last]]
        found, number = _numbered(code, len(named) * a)
        named = named[found // a] << 8 | every[found % a]
    return named, number, np.cumsum(sizes) - sizes


def chunks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Texts in chunks of about CHUNK bytes, with the place of the first."""
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK:
            yield begin, texts[begin : i + 1]
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, texts[begin:]


def log10_costs(window: np.ndarray, count: np.ndarray, order1: np.ndarray) -> np.ndarray:
    """log10 of the probability of the last byte of each window after those before it.

    ``window`` are distinct windows, with complete for each two bytes before the last;
    ``count`` is how often each is in the training texts (0: only in others); ``order1``
    (256 x 256) how often a byte follows a byte there.
    """
    keys, counts, rows = [window], [count.astype(float)], [np.arange(len(window))]
    for order in range(ORDER - 1, 1, -1):
        key, place = np.unique(keys[-1] & ((1 << 8 * (order + 1)) - 1), return_inverse=True)
        counts.append(np.bincount(place, counts[-1]))
        rows.append(place[rows[-1]])
        keys.append(key)
    before, last = keys[-1] >> 8 & 0xFF, keys[-1] & 0xFF
    order0 = order1.sum(0).astype(float)
    counts += [order1[before, last].astype(float), order0[last]]
    rows += [rows[-1], rows[-1]]
    # By level: occurrences and successors of the context, and what the shorter one has of these successors.
    levels = []
    for i, key in enumerate(keys):
        _, context = np.unique(key >> 8, return_inverse=True)
        met = counts[i] > 0
        place = np.searchsorted(keys[i + 1], key & ((1 << 8 * (ORDER - i)) - 1)) if i + 1 < len(keys) else slice(None)
        shorter = counts[i + 1][place]
        sums = np.bincount(context, counts[i]), np.bincount(context, met), np.bincount(context, np.where(met, shorter, 0.0))
        levels.append(tuple(x[context] for x in sums))
    met = order1 > 0
    levels.append((order1.sum(1)[before], met.sum(1)[before], (met @ order0)[before]))
    kinds0 = int((order0 > 0).sum())
    levels.append((np.full(len(last), order0.sum()), np.full(len(last), kinds0), None))
    cost, open_ = np.zeros(len(window)), np.ones(len(window), bool)
    excluded = fewer = np.zeros(len(window))
    with np.errstate(divide="ignore", invalid="ignore"):
        for c, row, (n, d, e) in zip(counts, rows, levels):
            c, new = c[row], d[row] - fewer
            whole = n[row] - excluded + new
            here = open_ & (c > 0)
            cost[here] += np.log10((c / whole)[here])
            open_ &= ~here
            escape = open_ & (new > 0)
            cost[escape] += np.log10((new / whole)[escape])
            if e is not None:
                excluded, fewer = e[row], d[row]
    cost[open_] -= math.log10(max(1, 256 - kinds0))
    return cost


def _low(texts: pd.Series) -> list[bytes]:
    return [t.encode().lower() for t in texts]


def _count_words(texts: list[bytes], learn: np.ndarray) -> tuple[Counter[bytes], set[bytes]]:
    """How often each word is in the training texts, and the words of the others."""
    words: Counter[bytes] = Counter()
    others: set[bytes] = set()
    for text, known in zip(texts, learn):
        (words if known else others).update(text.split())
    return words, others


def _gather(group: pd.DataFrame) -> pd.DataFrame:
    """What the documents of a bucket hold: words and windows, with their number in training documents."""
    texts, learn = _low(group["text"]), ~group["held_out"].to_numpy()
    words, others = _count_words(texts, learn)
    found, counts = [], []
    for begin, some in chunks(texts):
        named, number, starts = windows(some)
        sizes = np.diff(np.append(starts, len(number)))
        trained = np.repeat(learn[begin : begin + len(some)], sizes)
        found.append(named)
        counts.append(np.bincount(number[trained], minlength=len(named)))
    named, place = np.unique(np.concatenate(found), return_inverse=True)
    count = np.bincount(place, np.concatenate(counts)).astype(np.int64)
    vocabulary = [*words, *(others - words.keys())]
    return pd.DataFrame(
        {
            "bucket": int(group["bucket"].iloc[0]),
            "word": pd.Series([*vocabulary, *[None] * len(named)], dtype=object),
            "gram": pd.array([*[None] * len(vocabulary), *named.tolist()], dtype="Int64"),
            "c": np.append(np.array([words[w] for w in vocabulary], np.int64), count),
        }
    )


def score(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes.

    Null text counts as empty: the end alone. Documents without id are held out. Repeated
    rows are documents of their own; an empty table gives no rows.
    """
    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(True))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), held.alias("held_out"))
    sums = rows.agg(
        F.sum(F.octet_length("text") + 1).alias("size"), F.count(F.when(~F.col("held_out"), 1)).alias("learned")
    ).head()
    buckets = max(1, -(-(sums["size"] or 0) // BUCKET_BYTES))
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets).cast("long")))
    held_in = staged(dealt.groupBy("bucket").applyInPandas(_gather, "bucket long, word binary, gram long, c long"), "counts")

    # Counts of words over all buckets. A word that is in one bucket alone is counted there,
    # so only the others are sent back. A word has one row for each bucket here, no more.
    by_word = Window.partitionBy("word")
    words = held_in.where("word is not null").select("bucket", "word", "c").withColumn("total", F.sum("c").over(by_word))
    words = words.withColumn("first", F.col("bucket") == F.min("bucket").over(by_word))
    seen = Observation()
    words = words.observe(
        seen, F.sum("c").alias("n"), F.count(F.when(F.col("first") & (F.col("total") > 0), 1)).alias("v")
    )
    words = staged(words.where("total <> c").select("bucket", "word", "total"), "words")
    ends = sums["learned"]  # each training document has one end
    n, v = (seen.get["n"] or 0) + ends, seen.get["v"] + (ends > 0)

    grams = held_in.where("gram is not null").groupBy("gram").agg(F.sum("c").alias("c"))
    order1 = np.zeros(1 << 16, np.int64)
    pairs = grams.groupBy((F.col("gram") % (1 << 16)).alias("b")).agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()
    for r in pairs:  # 65,536 rows at most
        order1[r["b"]] = r["c"]
    order1 = order1.reshape(256, 256)

    def costs(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("gram")
        window = group["gram"].to_numpy()
        return pd.DataFrame({"gram": window, "cost": log10_costs(window, group["c"].to_numpy(), order1)})

    # Windows by the two bytes before their last: of such a pair there are at most 2 ** 24.
    parts = max(1, -(-sum(r["n"] for r in pairs) // MODEL_ROWS))
    part = F.pmod(F.hash(F.shiftright("gram", 8) % (1 << 16)), F.lit(parts))
    model = staged(grams.groupBy(part.alias("part")).applyInPandas(costs, "gram long, cost double"), "model")
    if sum(r["n"] for r in pairs) <= MOST_SENT:
        model = F.broadcast(model)
    values = words.select("bucket", "word", F.lit(None).cast("long").alias("gram"), F.col("total").cast("double").alias("value"))
    values = values.unionByName(
        held_in.where("gram is not null").select("bucket", "gram").join(model, "gram")
        .select("bucket", F.lit(None).cast("binary").alias("word"), "gram", F.col("cost").alias("value"))
    )
    least = n + SMOOTH * (v + 1)

    def of_bucket(group: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        is_word = known["word"].notna()
        texts = _low(group["text"])
        counts, others = _count_words(texts, ~group["held_out"].to_numpy())
        counts = dict.fromkeys(others, 0) | counts
        some = known[is_word]
        counts.update(zip(map(bytes, some["word"]), some["value"].tolist()))
        of_word = dict(zip(counts, np.log10((np.fromiter(counts.values(), float, len(counts)) + SMOOTH) / least).tolist()))
        some = known[~is_word].sort_values("gram")
        grams, cost = some["gram"].to_numpy().astype(np.int64), some["value"].to_numpy()
        never, end = math.log10(SMOOTH / least), math.log10((ends + SMOOTH) / least)
        scores = []
        for _, part in chunks(texts):
            named, number, starts = windows(part)
            scores.append(np.add.reduceat(cost[np.searchsorted(grams, named)][number], starts))
        base, n_tokens, n_known = [], [], []
        for text in texts:
            w = text.split()
            x = np.fromiter(map(of_word.__getitem__, w), float, len(w))
            base.append(float(x.sum()) + end)
            n_tokens.append(len(w) + 1)
            n_known.append(int((x > never + 1e-9).sum()) + (ends > 0))
        return pd.DataFrame(
            {
                "doc_id": group["doc_id"].array, "held_out": group["held_out"].array, "n_tokens": n_tokens, "n_known": n_known,
                "train_tokens": n, "base_score": base, "score": np.concatenate(scores), "n_bytes": list(map(len, texts)),
            }
        )

    return dealt.groupBy("bucket").cogroup(values.groupBy("bucket")).applyInPandas(
        of_bucket,
        f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double, n_bytes long",
    )
