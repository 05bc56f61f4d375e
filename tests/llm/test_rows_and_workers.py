"""Rows that share an id, and workers that do not have the package."""

import os
import subprocess
import sys
from collections import Counter

from crease.llm import jaccard_join

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
COPY = "one two three four five six seven eight"
OTHER = "nothing of this is anywhere else in the table"


def kept(spark, rows):
    table = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, cid long")
    out = jaccard_join.one_of_each(table)
    assert out.columns == table.columns
    return Counter((r["doc_id"], r["text"]) for r in out.collect())


def test_rows_of_one_id_are_told_apart_by_their_texts(spark):
    rows = [(5, COPY), (8, COPY), (8, OTHER), (9, COPY.upper()), (10, "a third text")]
    assert kept(spark, rows) == Counter([(5, COPY), (8, OTHER), (10, "a third text")])


def test_one_of_repeated_rows_stays(spark):
    rows = [(7, COPY), (7, COPY), (7, COPY), (8, COPY), (9, None), (9, None), (9, " "), (None, ""), (None, "")]
    assert kept(spark, rows) == Counter({(7, COPY): 1, (9, None): 2, (9, " "): 1, (None, ""): 2})


def test_rows_without_an_id(spark):
    rows = [(None, COPY), (3, COPY), (None, OTHER), (None, OTHER), (None, "alone here")]
    assert kept(spark, rows) == Counter([(3, COPY), (None, OTHER), (None, "alone here")])


def test_two_classes_never_have_one_id(spark, monkeypatch):
    true = jaccard_join._class_ids
    monkeypatch.setattr(jaccard_join, "_class_ids", lambda n, k1, k2, seed: true(n, k1, k2, seed) % (2 if seed == 0 else 2**62))
    rows = [(i, f"{i} b{i} c{i} d{i} e{i}") for i in range(9)] + [(20, COPY), (21, COPY)]
    assert sum(kept(spark, rows).values()) == 10


SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from crease.llm import collocations, jaccard_join, licence_scan, vector_codes
from crease.session import get_spark
spark = get_spark("w", "local[2]", **{{"spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": {folder!r}}})
docs = spark.createDataFrame([(i, "new york is a b c d e " * 8 + str(i % 3), "en") for i in range(9)], "doc_id long, text string, lang string")
assert jaccard_join.join(docs).count() == 9 and jaccard_join.one_of_each(docs).count() == 3
assert collocations.collocations(docs).count() > 0 and licence_scan.scan(docs).count() == 9
vectors = spark.createDataFrame([(i, [float(i)] * 8, 1) for i in range(9)], "vec_id long, embedding array<float>, label int")
assert vector_codes.codes(vectors).count() == 9
from pyspark.sql import functions as F
try:
    spark.range(1).select(F.udf(lambda x: str(__import__("crease")))("id")).collect()
except Exception:
    print("workers without the package: fine")
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = SCRIPT.format(root=ROOT, folder=str(tmp_path / "shared"))
    run = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "workers without the package: fine" in run.stdout, run.stderr[-3000:]


def test_many_ids_are_found_by_a_bit_map(spark, monkeypatch):
    rows = [(5, COPY), (8, COPY), (8, OTHER), (9, COPY.upper()), (None, COPY), (None, OTHER), (None, "alone here"), (7, None), (7, None)]
    rows += [(20 + i, f"{i} b{i} c{i} d{i} e{i} f{i}") for i in range(40)]
    want = kept(spark, rows)
    monkeypatch.setattr(jaccard_join, "MOST_SENT", 0)
    assert kept(spark, rows) == want
    docs, ids = spark.range(4000).selectExpr("id as doc_id", "'x' as text"), spark.range(0, 4000, 40).selectExpr("id as i")
    found = jaccard_join._maybe_among(docs, ids)
    assert "hashpartitioning(doc_id" not in found._jdf.queryExecution().toString()
    assert found.columns == docs.columns and {r[0] for r in ids.collect()} <= {r[0] for r in found.collect()} and found.count() < 800
    assert jaccard_join._among(docs, ids.toDF("doc_id")).count() == 100 and jaccard_join._not_among(docs, ids.toDF("doc_id")).count() == 3900


def test_elements_are_stored_of_sets_that_may_be_linked_only(spark, monkeypatch):
    """Texts with one half in common share keys, but their cells tell that they are not similar."""
    half = " ".join(f"w{i}" for i in range(30))
    rows = [(i, half + " " + " ".join(f"x{i}y{k}" for k in range(20))) for i in range(60)] + [(100, half), (101, half + " more")]
    stored, staged = Counter(), jaccard_join.staged

    def counted(df, name):
        df = staged(df, name)
        stored[name, "tokens" in df.columns] += df.count()
        return df

    monkeypatch.setattr(jaccard_join, "staged", counted)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i if i < 101 else 100 for i, _ in rows}
    assert stored["sets", False] > 20
    assert sum(n for (_, tokens), n in stored.items() if tokens) < 10
