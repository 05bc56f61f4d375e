"""Collocations, licence notices and vector codes against brute force, and on odd rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from crease.llm import collocations, licence_scan, vector_codes

VOCABULARY = ["new", "york", "of", "the", "state", "city", "été", "x1", "a-b", "in"]


def phrase_texts():
    rng = random.Random(5)
    rows = []
    for i in range(300):
        words = [rng.choice(VOCABULARY) for _ in range(rng.choice([1, 5, 40]))]
        for _ in range(rng.choice([0, 1, 3])):
            words.insert(rng.randrange(len(words) + 1), rng.choice(["New York city", "State of the", "x1 x1"]))
        rows.append((i, "".join(w + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n"]) for w in words), rng.choice(["en", "en", "de", None])))
    return rows + [(7, None, "en"), (None, "", "en"), (None, " \t\n", None), (None, "New York city", "fr"), rows[3], rows[3]]


def brute_phrases(rows, least, top):
    counts, totals = {}, Counter()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(low)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            own.update(tuple(words[i : i + n]) for n in range(1, 5) for i in range(len(words) - n + 1))
    out = []
    for lang, own in counts.items():
        often = {g: a for g, a in own.items() if a >= least and len(g) > 1}
        found = []
        for g, a in often.items():
            if any(len(h) > len(g) and 100 * b >= 80 * a and any(h[i : i + len(g)] == g for i in range(len(h))) for h, b in often.items()):
                continue
            score, k = min((2000000 * a // (own[g[:k]] + own[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), own[g[:k]], own[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def got_phrases(docs):
    columns = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(r[c] for c in columns) for r in collocations.collocations(docs).collect())


@pytest.mark.parametrize(
    "settings",
    [
        {},
        {"SAMPLE": 1, "CHUNK": 500},  # the sample is all there is
        {"SAMPLE": 10**6},  # no sample: all failures are found by further passes
        {"LEAST_BITS": 5, "MOST_BITS": 5, "KNOWN": 0},  # nearly all bits are set: all is counted
        {"TOP": 3, "SENT": 7},
    ],
)
def test_collocations_against_brute_force(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(collocations, name, value)
    rows = phrase_texts()
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, lang string, gram int, sample int").repartition(3)
    want = brute_phrases(rows, 30, settings.get("TOP", 2000))
    assert want and got_phrases(docs) == want


def test_rare_keys_are_never_rows(spark, monkeypatch):
    monkeypatch.setattr(collocations, "GATHERED", 40)
    monkeypatch.setattr(collocations, "CHUNK", 500)
    docs = spark.createDataFrame(phrase_texts(), "doc_id long, text string, lang string")
    cut, named = collocations.words(docs)
    known = collocations.added(collocations.Bits.empty(1000), named.selectExpr("hash & ~3L as key"))
    before = collocations.Bits(np.zeros_like(known.bits))
    plans, store = [], collocations.staged

    def staged(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, name)

    monkeypatch.setattr(collocations, "staged", staged)
    keys = [r["key"] for r in collocations.sieved(cut, before, known, 30, 2, 5000).collect()]
    pairs = [r for r in collocations.counted(cut, before, known, None).collect() if len(r["gram"]) == 16]
    assert sorted(keys) == sorted({r["key"] for r in pairs}) and len(keys) > 10
    assert "FlatMapGroupsInArrow" in plans[0] and "Aggregate" not in plans[0]


def test_tasks_hold_few_chunks_and_keys_at_once(spark, monkeypatch):
    for name, value in {"CHUNK": 500, "GROUP": 4000, "SENT": 50}.items():
        monkeypatch.setattr(collocations, name, value)
    docs = spark.createDataFrame(phrase_texts(), "doc_id long, text string, lang string").coalesce(1)
    cut, _ = collocations.words(docs)
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in cut.inputFiles()]
    groups = [f.row_group(i) for f in files for i in range(f.num_row_groups)]
    assert len(groups) > 10 and max(g.total_byte_size for g in groups) < 8000
    rng = np.random.default_rng(1)
    key, count = rng.integers(0, 2**64 - 1, 3000, np.uint64), rng.integers(1, 50, 3000)
    sent = list(collocations._bucketed([key[:1000], key[1000:]], [count[:1000], count[1000:]], 30, 8))
    sizes = [sum(len(k) // 8 for k in batch["keys"].to_pylist()) for batch in sent]
    assert sum(sizes) == 3000 and len(sizes) > 30 and max(sizes) < 100
    rows = [r for batch in sent for r in batch.to_pylist()]
    order = np.argsort(key)
    assert b"".join(r["keys"] for r in rows) == key[order].tobytes()
    assert b"".join(r["counts"] for r in rows) == np.minimum(count, 30)[order].astype(np.uint8).tobytes()
    assert all((np.frombuffer(r["keys"], np.uint64) >> np.uint64(56) == r["bucket"]).all() for r in rows)


def test_counted_rows_are_words_and_counts_alone(spark, monkeypatch):
    docs = spark.createDataFrame(phrase_texts(), "doc_id long, text string, lang string").repartition(2)
    cut, named = collocations.words(docs)
    known = collocations.added(collocations.Bits.empty(1000), named.selectExpr("hash & ~3L as key"))
    plans, store = [], collocations.staged

    def staged(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, name)

    monkeypatch.setattr(collocations, "staged", staged)
    rows = collocations.counted(cut, collocations.Bits(np.zeros_like(known.bits)), known, None).collect()
    assert re.findall(r"HashAggregate\(keys=\[(.*?)\]", plans[0]) and "key" not in "".join(re.findall(r"keys=\[(.*?)\]", plans[0]))
    for r in rows:
        hashes = np.frombuffer(bytes(r["gram"]), ">u8").astype(np.uint64)
        key = collocations._key(hashes[:1], 1)
        for n in range(2, len(hashes) + 1):
            key = collocations._longer(key, hashes[n - 1 : n], n)
        assert key.view(np.int64)[0] == r["key"]
    assert len(rows) > 10


def test_collocations_of_nothing(spark):
    schema = "doc_id long, text string, lang string"
    assert got_phrases(spark.createDataFrame([], schema)) == []
    assert got_phrases(spark.createDataFrame([(1, None, None), (2, "one two", "en")], schema)) == []
    long = spark.createDataFrame([(1, "b c " * 500_000, "en")], schema)
    assert [r[2] for r in got_phrases(long)] == ["b c b c", "c b c b"]


def test_words_with_one_hash_get_another_seed(spark, monkeypatch):
    true = collocations.xxhash.xxh64_intdigest

    class Poor:
        xxh64_intdigest = staticmethod(lambda data, seed: true(data, seed) % (7 if seed == 0 else 2**64))

    monkeypatch.setattr(collocations, "xxhash", Poor)
    rows = phrase_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert got_phrases(docs) == brute_phrases(rows, 30, 2000)


def brute_runs(sequences, text, least):
    for n, s in enumerate(sequences):
        for i in range(len(text)):
            for j in range(len(s)):
                if text[i] == s[j] and (i == 0 or j == 0 or text[i - 1] != s[j - 1]):
                    size = 0
                    while i + size < len(text) and j + size < len(s) and text[i + size] == s[j + size]:
                        size += 1
                    if size >= least[n]:
                        yield n, j + size, i + size, size


def test_matching_statistics_against_brute_force():
    rng = random.Random(1)
    for _ in range(400):
        sequences = [[rng.randrange(3) for _ in range(rng.randrange(1, 9))] for _ in range(rng.randrange(1, 4))]
        text = [rng.randrange(4) for _ in range(rng.randrange(0, 14))]
        least = [rng.randrange(1, 4) for _ in sequences]
        runs = licence_scan.Automaton(sequences).complete_runs(text, least)
        assert sorted(runs) == sorted(brute_runs(sequences, text, least))


def licence_rows():
    rng = random.Random(2)
    pieces = ["MIT License", "Apache license", "GNU general, public LICENSE", "cc-by", "CC BY", "mit", "license", "été", "x", "(c)"]
    rows = [(i, " ".join(rng.choice(pieces) for _ in range(rng.choice([0, 1, 3, 30])))) for i in range(200)]
    return rows + [(5, None), (None, ""), (6, "\x00"), (6, "\x00"), (7, "Released under the MIT license. " * 3000)]


def test_phrases_of_licences_against_brute_force(spark):
    rows = licence_rows()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, labels string, score int")
    want = Counter()
    for doc_id, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        found = sorted((i, label) for label, p in licence_scan.PHRASES for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
        places = [i for i, _ in found]
        base = ",".join(sorted({label for _, label in found}))
        want[doc_id, len(words), len(places), min(places, default=None), max(places, default=None), base] += 1
    columns = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    got = licence_scan.scan(docs).collect()
    assert Counter(tuple(r[c] for c in columns) for r in got) == want
    for r in got:
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
    assert max(len(r["spans"].split(",")) for r in got) == 3000
    assert licence_scan.scan(docs.limit(0)).count() == 0


def test_notices_are_found_with_some_words_changed():
    rng, finder = random.Random(3), licence_scan.Finder()
    noise = ["lorem", "of", "the", "software", "under", "license", "a"]
    for label, text in licence_scan.TEMPLATES:
        words = text.split()
        before, after = ([rng.choice(noise) for _ in range(rng.randrange(30))] for _ in range(2))
        _, _, notices, score = finder.find(" ".join([*before, *words, *after]).encode())
        assert label in {x[0] for x in notices} and score == 1
        if len(words) > 60:
            for i in (len(words) // 3, 2 * len(words) // 3):
                words[i] = "zzz"
            _, _, (notice, *_), score = finder.find(" ".join([*before, *words, *after]).encode())
            assert notice[0] == label and 0.9 < notice[3] < 1 and notice[1] <= len(licence_scan.words(" ".join(before).encode())) + 1
    assert finder.find(b"the terms of this agreement and the use of the software by any person are of interest")[2] == []


def test_chains_cover_words_once():
    # Two runs that overlap in the template, then one before them: best is 6 words, not 8.
    assert licence_scan.chains([(4, 4, 4), (6, 8, 4)], 10) == [(0, 8, 6)]
    assert licence_scan.chains([(10, 4, 4), (4, 9, 4)], 10) == [(0, 4, 4), (5, 9, 4)]
    assert licence_scan.chains([(4, 4, 4), (8, 40, 4)], 10) == [(0, 4, 4), (36, 40, 4)]


def brute_codes(rows, entries=256):
    kept = sorted((r for r in rows if r[1] and all(x is not None and np.isfinite(x) for x in r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    whole = np.array([[int(np.floor(1024 * np.float64(x))) for x in r[1]] for r in kept], dtype=object).reshape(len(kept), 4, -1)
    books = [[list(v[p]) for v in whole[:entries]] for p in range(4)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(v[p], e)), i) for i, e in enumerate(books[p])) for p in range(4)] for v in whole]

    for _ in range(4):
        near = assign()
        for p in range(4):
            for i in range(len(books[p])):
                own = [v[p] for v, n in zip(whole, near) if n[p][1] == i]
                if own:
                    books[p][i] = [sum(c) // len(own) for c in zip(*own)]
    near = assign()
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(d for d, _ in n) for n in near]
    by_label = Counter()
    for r, e in zip(kept, errors):
        by_label[r[2]] += e
    return sorted(((r[0], "".join(f"{i:02x}" for _, i in n), e, by_label[r[2]], sha) for r, n, e in zip(kept, near, errors)), key=repr)


def vector_rows(n, spread):
    rng = random.Random(n)
    rows = [(i, [float(np.float32(rng.gauss(i % 3, 1) * spread)) for _ in range(8)], rng.choice([1, 1, 2, None])) for i in range(n)]
    odd = [(1, None, 1), (2, [], 1), (3, [None] * 8, 2), (4, [float("nan")] * 8, 1), (5, [1.0] * 7 + [float("inf")], 1)]
    return rows + odd + [(None, rows[0][1], 2), (0, rows[1][1], 1), (0, rows[1][1], 1), *[(n + i, rows[0][1], 2) for i in range(n)], (9, [1.0] * 12, 1)]


@pytest.mark.parametrize("n, spread, owned", [(40, 1.0, 4096), (150, 0.02, 5), (20, 100_000.0, 4096)])
def test_codes_against_brute_force(spark, monkeypatch, n, spread, owned):
    monkeypatch.setattr(vector_codes, "OWNED", owned)
    monkeypatch.setattr(vector_codes, "ENTRIES", 16)
    rows = vector_rows(n, spread)
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, entry int, __label int").repartition(4)
    got = sorted((tuple(r) for r in vector_codes.codes(table).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)
    assert got == brute_codes(rows, 16)


def test_codes_of_nothing_and_of_too_much(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert vector_codes.codes(spark.createDataFrame([], schema)).count() == 0
    assert vector_codes.codes(spark.createDataFrame([(1, None, 1), (2, [1.0, 2.0], 1)], schema)).count() == 0
    with pytest.raises(Exception, match="too large"):
        vector_codes.codes(spark.createDataFrame([(1, [1e30] * 8, 1)], schema))


def test_members_that_stay_are_not_shuffled(spark):
    rows = vector_rows(60, 1.0)
    kept, size = vector_codes.kept_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    books = vector_codes.first_books(kept, size)
    members = vector_codes.Members(vector_codes._newcomers(kept, books), 4)
    plan = vector_codes._visited(members.table, books)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SelectedBucketsCount: 4 out of 4" in plan
    sums = members.sums(2)._jdf.queryExecution().executedPlan().toString()
    assert sums.count("Exchange") == 1 and sums.index("Exchange") < sums.index("salt")
    members.drop()


def test_nearest_with_large_numbers():
    rng = np.random.default_rng(0)
    for scale in (3, 2**20, 2**26):
        parts, book = rng.integers(-scale, scale, (300, 4)), rng.integers(-scale, scale, (16, 4))
        book[7] = book[2]
        entry, error = vector_codes.nearest(parts, book)
        full = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, e)) for e in book] for p in parts]
        assert entry.tolist() == [f.index(min(f)) for f in full] and error.tolist() == [min(f) for f in full]
