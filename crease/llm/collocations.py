"""Collocations by Toivonen's sampling: phrases of two to four words that hold together.

The texts are cut once into chunks: the distinct words of some megabytes of text with their
counts, and the text as numbers of these words. Summed up, the counts are exact for words.
Phrases are then mined level by level in the chunks of a sample of the documents, one in
``SAMPLE``, down to ``SAMPLE_LEAST`` occurrences there. What is frequent in the sample is
proposed; the negative border is what is not, but both of its parts without the last and
without the first word are. One full pass counts both exactly. A phrase of the border that
turns out frequent is a failure of the sample: it is added to what is known, and a further
pass counts what that opens, until no failure is left. So no frequent phrase is missed,
whatever the sample; a poor one costs passes.

A phrase is the hashes of its words, 8 bytes each. They tell words apart: two words of one
hash are looked for among all words, and if there are any, another seed is taken. What is known is sent
to the tasks as a bit map of at most ``2 ** MOST_BITS`` bits, by a key of 8 bytes. A wrongly
set bit only lets a phrase be counted that need not be, as counts are by the whole phrase.
"""

from __future__ import annotations

import itertools
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crease.llm.common import fold
from crease.session import shared_folder, staged

#: Words of the longest phrase, occurrences of a candidate, per cent of a longer one that drop it, phrases per language.
LONGEST, LEAST, COVERS, TOP = 4, 30, 80, 2000
#: One document in so many is in the sample, and occurrences there that propose a phrase.
SAMPLE, SAMPLE_LEAST = 8, 2
#: Bytes of text in a chunk, about, and phrases sent back at once.
CHUNK, SENT = 4_000_000, 100_000
#: Bytes of a row group of chunks, about: a task holds one of them, and Spark cuts files between them. A chunk has pages of its own.
GROUP = 16_000_000
#: The bit map has 16 bits for each phrase, but no more than 2 ** 30 (128 MB); so many phrases are expected for each word.
LEAST_BITS, MOST_BITS, KNOWN = 20, 30, 8
#: Keys that a task gathers before it sends them; at least 2 ** BUCKET_BITS buckets of keys, of no more than so many sent keys, about.
GATHERED, BUCKET_BITS, BUCKET = 2_000_000, 10, 4_000_000

_TEXT = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + 9 * b"\n")
_END, _BLANK = -1, -2


class _Chunk:
    """Words of some texts by language, and the texts as their numbers; pieces end with -1."""

    def __init__(self):
        self.numbers, self.parts, self.size = itertools.count(), [], 0
        self.words: dict[str, dict[bytes, int]] = {}

    def add(self, lang: str, text: bytes) -> None:
        if lang not in self.words:
            self.words[lang] = defaultdict(self.numbers.__next__, {b"\n": _END, b"": _BLANK})
        cut = text.translate(_TEXT).replace(b"\n", b" \n ").split(b" ")
        ids = np.fromiter(map(self.words[lang].__getitem__, cut), np.int32, len(cut))
        self.parts += [ids[ids != _BLANK], np.array([_END], np.int32)]
        self.size += len(text)

    def batch(self, sample: int, seed: int) -> pa.RecordBatch:
        ids = np.concatenate(self.parts)
        ids = ids[np.append(True, (ids[1:] >= 0) | (ids[:-1] >= 0))]
        n = sum(len(own) - 2 for own in self.words.values())
        words, hashes, langs = [b""] * n, [0] * n, np.zeros(n, np.int32)
        for number, (lang, own) in enumerate(self.words.items()):
            before = b"%d:" % len(lang.encode()) + lang.encode()
            for word, i in own.items():
                if i >= 0:
                    words[i], hashes[i], langs[i] = word, xxhash.xxh64_intdigest(before + word, seed), number
        row = {
            "sample": pa.array([sample], pa.int32()),
            "langs": pa.array([list(self.words)], pa.list_(pa.string())),
            "lang_of": _blob(langs),
            "words": pa.array([b"\n".join(words)], pa.binary()),
            "counts": _blob(np.bincount(ids[ids >= 0], minlength=n).astype(np.int64)),
            "hashes": _blob(np.array(hashes, np.uint64)),
            "ids": _blob(ids),
        }
        return pa.RecordBatch.from_pydict(row)


def _blob(values: np.ndarray) -> pa.Array:
    return pa.array([values.tobytes()], pa.binary())


#: A chunk: whether its texts are of the sample, its languages, then by word the number of its language, the word (words
#: have no line ends), its occurrences and hash, and the texts as numbers of words.
CHUNKS = "sample int, langs array<string>, lang_of binary, words binary, counts binary, hashes binary, ids binary"


def _cutter(seed: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, _Chunk] = {}
        for batch in batches:
            for sample, lang, text in zip(*(batch.column(i) for i in range(3))):
                chunk = open_.setdefault(sample.as_py(), _Chunk())
                chunk.add(lang.as_py(), text.as_py())
                if chunk.size >= CHUNK:
                    yield open_.pop(sample.as_py()).batch(sample.as_py(), seed)
        for sample, chunk in open_.items():
            yield chunk.batch(sample, seed)

    return cut


def chunks(docs: DataFrame, seed: int) -> DataFrame:
    """The texts of ``docs`` (doc_id, text, lang) cut into chunks, and stored by ``sample`` (1 or 0)."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        (fold(F.coalesce(docs["doc_id"].cast("string"), text), SAMPLE) == 0).cast("int").alias("sample"),
        F.coalesce("lang", F.lit("und")).alias("lang"),
        text.cast("binary").alias("text"),
    )
    path = f"{shared_folder(docs.sparkSession)}/chunks-{uuid.uuid4().hex}"
    # Sizes of pages and row groups are looked at after each row, not after a hundred: some rows are megabytes.
    checks = {"parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1, "parquet.enable.dictionary": False}
    written = rows.mapInArrow(_cutter(seed), CHUNKS).write.options(**checks, **{"parquet.block.size": GROUP, "compression": "zstd"})
    written.partitionBy("sample").parquet(path)
    return docs.sparkSession.read.schema(CHUNKS).parquet(path)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for langs, lang_of, words_, counts, hashes in zip(*(batch.column(i) for i in range(5))):
            lang_of, counts, hashes = _array(lang_of, np.int32), _array(counts, np.int64), _array(hashes, np.int64)
            langs, own = pa.array(langs.as_py(), pa.string()), words_.as_py().split(b"\n")
            for i in range(0, len(counts), SENT):
                part = slice(i, i + SENT)
                columns = [langs.take(pa.array(lang_of[part])), pa.array(own[part], pa.binary()), pa.array(hashes[part]), pa.array(counts[part])]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "hash", "f"])


def _array(blob: pa.Scalar, kind: type) -> np.ndarray:
    return np.frombuffer(blob.as_buffer(), kind)


def _bytes(number: str) -> Column:
    return F.unhex(F.lpad(F.hex(number), 16, "0"))


def words(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The chunks, and their words with language, hash (``gram``) and occurrences (``f``); no two have the same hash."""
    for seed in itertools.count():
        cut = chunks(docs, seed)
        each = cut.select("langs", "lang_of", "words", "counts", "hashes").mapInArrow(_listed, "lang string, word binary, hash bigint, f bigint")
        named = each.groupBy("lang", "word", "hash").agg(F.sum("f").alias("f")).withColumn("gram", _bytes("hash"))
        named = staged(named, "words")
        # A hash of 0 stands for no word.
        if not named.groupBy("hash").count().where("count > 1 or hash = 0").head(1):
            return cut, named


class Bits:
    """Set of phrases as a bit map."""

    def __init__(self, bits: np.ndarray):
        self.log2, self.bits = (8 * len(bits)).bit_length() - 1, bits

    @classmethod
    def empty(cls, n: int) -> Bits:
        """Map for about n phrases."""
        return cls(np.zeros(1 << min(MOST_BITS, max(LEAST_BITS, (16 * n).bit_length())) >> 3, np.uint8))

    def places(self, keys: np.ndarray) -> np.ndarray:
        return ((keys ^ (keys >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.log2)).astype(np.int64)

    def has(self, keys: np.ndarray) -> np.ndarray:
        places = self.places(keys)
        return (self.bits[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)


def _key(mixed: np.ndarray, n: int) -> np.ndarray:
    """Key of phrases of n words: the last two bits are n - 1."""
    return mixed & ~np.uint64(3) | np.uint64(n - 1)


def _longer(keys: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Keys of phrases that have become n words long."""
    keys = (keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + hashes
    return _key((keys ^ (keys >> np.uint64(32))) * np.uint64(0x94D049BB133111EB), n)


def added(known: Bits, keys: DataFrame) -> Bits | None:
    """``known`` with the keys, if it has not all their bits, else None.

    Tasks set bits in parts of 32,768, so the driver gets the map and never the phrases.
    """
    sent = keys.sparkSession.sparkContext.broadcast(known.bits)

    def places(batches):
        there = Bits(sent.value)
        for batch in batches:
            own = batch.column(0).to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(there.places(own[~there.has(own)]) + 1)], ["place"])

    parts = (
        keys.select("key").mapInArrow(places, "place bigint")
        .groupBy(F.bitmap_bucket_number("place").alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
        .collect()  # at most 2 ** (MOST_BITS - 15) rows of 4 KB
    )
    sent.unpersist()
    if not parts:
        return None
    more = known.bits.copy()
    for part in parts:
        new = np.frombuffer(part["bits"], np.uint8)
        at = (part["part"] - 1) << 12
        more[at : at + 4096] |= new[: len(more) - at]
    return Bits(more)


def count_chunk(ids, hashes, before: Bits, known: Bits, longest: int, sieve: Bits | None = None) -> Iterator[tuple]:
    """Phrases of a chunk that ``known`` opens and ``before`` does not: keys, rows of hashes, counts.

    A phrase is open when it is there without its last and without its first word, and these two
    are open themselves. With a ``sieve``, only those that it has."""
    v = len(hashes)
    h = np.append(hashes, np.uint64(0))[ids]
    key = _key(h, 1)
    is_word = ids >= 0
    new, old = is_word & known.has(key), is_word & before.has(key)
    wide = ids.astype(np.int64)
    for n in range(2, longest + 1):
        m = len(new) - 1
        if m < 1:
            return
        at = np.flatnonzero(new[:m] & new[1:])
        done = old[at] & old[at + 1]
        key[at] = _longer(key[at], h[at + n - 1], n)
        todo = at[~done]
        if sieve is not None:
            todo = todo[sieve.has(key[todo])]
        if len(todo):
            code = wide[todo]
            for i in range(1, n):
                if i > 1:
                    code = np.unique(code, return_inverse=True)[1]
                code = code * v + wide[todo + i]
            _, first, counts = np.unique(code, return_index=True, return_counts=True)
            first = todo[first]
            yield key[first], h[first[:, None] + np.arange(n)], counts
        new, old = np.zeros(m, bool), np.zeros(m, bool)
        new[at] = known.has(key[at])
        old[at[done]] = before.has(key[at[done]])


def _opened(cut: DataFrame, before: Bits, known: Bits, longest: int, sieve: Bits | None):
    """Function of a batch of chunks: keys, rows of hashes and counts of the phrases of each chunk, by length."""
    context = cut.sparkSession.sparkContext
    sent = [bits and context.broadcast(bits.bits) for bits in (before, known, sieve)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        maps = [bits and Bits(bits.value) for bits in sent]
        for batch in batches:
            for hashes, ids in zip(batch.column(0), batch.column(1)):
                hashes = _array(hashes, np.uint64)
                if len(hashes):
                    yield from count_chunk(_array(ids, np.int32), hashes, maps[0], maps[1], longest, maps[2])
                pa.default_memory_pool().release_unused()

    return run


_HASHES = ["h0", "h1", "h2", "h3"]


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Keys in ascending order, each once, and the sums of their counts."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[first], np.add.reduceat(count[order], first, dtype=np.int64)


def _bucketed(keys: list[np.ndarray], counts: list[np.ndarray], least: int, bits: int) -> Iterator[pa.RecordBatch]:
    """A row for each bucket, the keys that begin with the same ``bits``; batches of SENT keys and less than a bucket more."""
    key, count = _summed(keys, counts)
    count = np.minimum(count, least).astype(np.min_scalar_type(least))
    bucket = (key >> np.uint64(64 - bits)).astype(np.int64)
    at = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
    parts = np.append(np.searchsorted(at, np.arange(0, len(key), SENT)), len(at) - 1)
    for first, last in itertools.pairwise(np.unique(parts)):
        own = at[first : last + 1]
        columns = [bucket[own[:-1]], *(pa.array([x[a:b].tobytes() for a, b in itertools.pairwise(own)], pa.binary()) for x in (key, count))]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0]), *columns[1:]], ["bucket", "keys", "counts"])


def sieved(cut: DataFrame, before: Bits, known: Bits, least: int, longest: int, size: int) -> DataFrame:
    """Keys (key) whose open phrases have ``least`` occurrences together, in texts of ``size`` words.

    Nearly all keys are rare, so they are no rows: a bucket has the keys that begin with the same
    bits, and a row is what a task has of a bucket. A count above ``least`` tells no more than ``least``."""
    opened, small = _opened(cut, before, known, longest, None), np.min_scalar_type(least)
    bits = max(BUCKET_BITS, (size * (longest - 1) // BUCKET).bit_length())

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = [], []
        for key, _, count in opened(batches):
            keys.append(key)
            counts.append(count)
            if sum(map(len, keys)) >= GATHERED:
                yield from _bucketed(keys, counts, least, bits)
                keys, counts = [], []
        if keys:
            yield from _bucketed(keys, counts, least, bits)

    def total(rows: pa.Table) -> pa.Table:
        key, count = _summed(*([_array(x, kind) for x in rows[name]] for name, kind in (("keys", np.uint64), ("counts", small))))
        return pa.table({"key": key[count >= least].view(np.int64)})

    rows = cut.select("hashes", "ids").mapInArrow(gather, "bucket bigint, keys binary, counts binary")
    return staged(rows.groupBy("bucket").applyInArrow(total, "key bigint"), "keys")


def counted(cut: DataFrame, before: Bits, known: Bits, sieve: Bits | None) -> DataFrame:
    """Open phrases (gram, key, f) with LEAST occurrences, by all their words."""
    opened = _opened(cut, before, known, LONGEST, sieve)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, grams, counts in opened(batches):
            for i in range(0, len(counts), SENT):
                part = slice(i, i + SENT)
                own = [np.ascontiguousarray(grams[part, j]).view(np.int64) for j in range(grams.shape[1])]
                none = np.zeros(len(own[0]), np.int64)
                columns = [*own, *[none] * (LONGEST - len(own)), counts[part].astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [*_HASHES, "f"])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [batch.column(i).to_numpy().view(np.uint64) for i in range(LONGEST)]
            key = _key(hashes[0], 1)
            for n, own in enumerate(hashes[1:], 2):
                key = np.where(own != 0, _longer(key, own, n), key)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key.view(np.int64))], [*_HASHES, "f", "key"])

    kinds = ", ".join(f"{c} bigint" for c in [*_HASHES, "f"])
    rows = cut.select("hashes", "ids").mapInArrow(listed, kinds)
    summed = rows.groupBy(*_HASHES).agg(F.sum("f").alias("f")).where(F.col("f") >= LEAST).mapInArrow(keyed, f"{kinds}, key bigint")
    gram = F.concat(*[F.when(F.col(c) != 0, _bytes(c)).otherwise(F.unhex(F.lit(""))) for c in _HASHES])
    return staged(summed.select(gram.alias("gram"), "key", "f"), "phrases")


def proposed(sample: DataFrame, words_: Bits, size: int) -> Bits:
    """``words_`` and the phrases that the sample proposes, level by level; the longest open nothing and are left out."""
    before, known = Bits(np.zeros_like(words_.bits)), words_
    while known:
        before, known = known, added(known, sieved(sample, before, known, SAMPLE_LEAST, LONGEST - 1, size))
    return before


def mine(cut: DataFrame, known: Bits, size: int) -> DataFrame:
    """All phrases (gram, f) with LEAST occurrences in ``size`` words; ``known`` has their words, and what is proposed.

    The border of the first pass is large: it is counted by key first, and only phrases whose
    key has enough by all their words. The later passes count what failures open."""
    before = Bits(np.zeros_like(known.bits))
    keys = sieved(cut, before, known, LEAST, LONGEST, size)
    sieve, found = added(Bits.empty(keys.count()), keys) or Bits.empty(0), None
    while known:
        more = counted(cut, before, known, sieve)
        found = more if found is None else found.unionByName(more)
        before, known = known, added(known, more.where(F.col("key").bitwiseAND(F.lit(3)) < LONGEST - 1))
        sieve = None
    return found.select("gram", "f")


def _n(gram: str = "gram") -> Column:
    return F.expr(f"cast(length({gram}) div 8 as int)")


def top_phrases(named: DataFrame, phrases: DataFrame) -> DataFrame:
    """Scores, what longer candidates cover dropped, and the first TOP phrases of each language."""
    inside = "flatten(transform(sequence(2, n - 1), m -> transform(sequence(0, n - m), s -> substring(gram, 8 * s + 1, 8 * m))))"
    longer = phrases.withColumn("n", _n()).where("n > 2").select(F.expr(f"explode({inside})").alias("gram"), "f")
    longer = longer.groupBy("gram").agg(F.max("f").alias("longest"))
    left = phrases.join(longer, "gram", "left").where(f"longest is null or 100 * longest < {COVERS} * f")
    parts = named.select("gram", "f").unionByName(phrases)
    first = parts.select(F.col("gram").alias("first"), F.col("f").alias("l"))
    rest = parts.select(F.col("gram").alias("rest"), F.col("f").alias("r"))
    cuts = left.select("gram", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), _n() - 1)).alias("k")).selectExpr(
        "*", "substring(gram, 1, 8 * k) as first", "substring(gram, 8 * k + 1) as rest"
    )
    score = F.expr("cast(cast(a as decimal(19, 0)) * 2000000BD div (cast(l as decimal(19, 0)) + r) as bigint)")
    best = (
        cuts.join(first, "first").join(rest, "rest").withColumn("score", score)
        .groupBy("gram", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
        .select("gram", "a", "best.*")
    )
    each = best.withColumn("i", F.explode(F.sequence(F.lit(0), _n() - 1))).selectExpr("*", "substring(gram, 8 * i + 1, 8) as word_gram")
    spelt = named.select(F.col("gram").alias("word_gram"), "lang", F.col("word").cast("string").alias("word"))
    whole = (
        each.join(spelt, "word_gram").groupBy("gram", "lang", "a", "l", "r", "score")
        .agg(F.array_join(F.expr("transform(array_sort(collect_list(struct(i, word))), x -> x.word)"), " ").alias("phrase"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = whole.withColumn("rank", F.row_number().over(order)).where(f"rank <= {TOP}")
    totals = named.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame) -> DataFrame:
    """The phrases of each language that hold together best: lang, rank, phrase, a, l, r, n, score.

    Null text is empty and null lang is ``und``; an empty table, or one without candidates,
    gives no rows. Repeated rows count as often as they are there, and a null id is an id
    like any other. Equal scores and counts are ranked by the phrase. Other columns are
    not read.
    """
    cut, named = words(docs)
    often = named.where(F.col("f") >= LEAST).select(F.expr("hash & ~3L").alias("key"))
    known = Bits.empty(often.count() * KNOWN)
    known = added(known, often) or known
    size = named.agg(F.sum("f")).head()[0] or 0
    return top_phrases(named, mine(cut, proposed(cut.where("sample = 1"), known, size), size))
