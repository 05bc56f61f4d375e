"""The corpus pipeline, stage by stage, against plain versions of its stages."""

import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from crease.llm import decontaminate, mixing, token_files
from crease.llm.queries import ORACLE, QUERIES
from llm.test_llm import near_classes

FOLDER = "/root/testdata/sf0.001"


def edits(item, text):
    """Fewest edits from the item to any part of the text, by the whole table."""
    before = np.zeros(len(text) + 1, int)
    signs = np.array(list(text))
    for i, c in enumerate(item):
        row = np.append(i + 1, np.minimum(before[:-1] + (signs != c), before[1:] + 1))
        places = np.arange(len(row))
        before = np.minimum.accumulate(row - places) + places
    return int(before.min())


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        out.append((docs, docs := stage(spark, docs, FOLDER)))
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_keep_the_columns(spark, stages):
    columns = spark.read.parquet(f"{FOLDER}/documents.parquet").columns
    assert all(after.columns == columns for _, after in stages[:-1])


def test_quality_stage(stages):
    duck = duckdb.connect()
    for name in ("documents", "labels"):
        duck.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    kept = duck.execute(f"select doc_id from ({ORACLE['op7_quality_rules']}) where kept order by doc_id").fetchall()
    assert ids(stages[0][1]) == [i for (i,) in kept]


def test_near_duplicate_stage(stages):
    rows = sorted((r["doc_id"], r["text"]) for r in stages[1][0].collect())
    classes = near_classes([t for _, t in rows])
    assert ids(stages[1][1]) == [rows[i][0] for i, (_, c) in classes.items() if i == c]


def first_of_each(rows):
    """Ids that are the least of their component, by all pairs: 5-word shingles, a similarity of 0.8."""
    sets, least = {}, {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i], least[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set(), i
    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and a and b and 100 * len(a & b) >= 80 * len(a | b) and least[i] != least[j]:
                x, y = sorted((least[i], least[j]))
                least = {k: x if v == y else v for k, v in least.items()}
    return sorted(i for i, v in least.items() if i == v)


def test_near_duplicate_stage_takes_five_words_and_four_fifths(spark, stages):
    words = [f"w{i}" for i in range(200)]
    rows = [(n, " ".join([*words, *(f"x{n}_{i}" for i in range(n))])) for n in (0, 30, 40, 49, 60)] + [(100, "w1 w2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert ids(corpus_pipeline.near_duplicates(spark, docs, FOLDER)) == first_of_each(rows) == [0, 60, 100]
    assert ids(stages[1][1]) == first_of_each([(r["doc_id"], r["text"]) for r in stages[1][0].collect()])


def test_decontamination_stage(spark, stages):
    items = [decontaminate.plain(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    clean = []
    for r in stages[2][0].collect():
        text = decontaminate.plain(r["text"])
        near = [i for i in items if sum(w in text for w in i.split()[:12]) > 7 or i in text]
        if all(edits(i, text) > int(len(i) * decontaminate.RATE) for i in near):
            clean.append(r["doc_id"])
    assert ids(stages[2][1]) == sorted(clean)


def test_mix_stage(stages):
    times = Counter(r["doc_id"] for r in mixing.mix(stages[3][0]).collect() if r["words"])
    assert Counter(ids(stages[3][1])) == times and set(times.values()) <= {1, 2}


def test_token_stage(stages):
    encoder = token_files.Encoder(token_files.TOKENIZER)
    start, want = 0, []
    for r in sorted(stages[4][0].collect(), key=lambda r: (r["doc_id"], r["text"])):
        tokens = np.array([*encoder.tokenizer.encode(r["text"], add_special_tokens=False).ids, 2], "<u4")
        want.append((r["doc_id"], start, len(tokens), zlib.crc32(tokens.tobytes())))
        start += len(tokens)
    assert sorted(tuple(r) for r in stages[4][1].collect()) == want


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_against_sql(spark, sf, name):
    from contract.check import compare, oracle

    assert compare(QUERIES[name](spark, sf), oracle(sf), ORACLE[name]) is None
