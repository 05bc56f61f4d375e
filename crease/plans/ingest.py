"""From a folder of match documents to stored tables."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crease import schemas
from crease.operators.normalize import normalized_tables
from crease.operators.summaries import batting_summary, bowling_summary, phase_summary
from crease.functions.scalars import rounded
from crease.session import staged
from crease.sources import files
from crease.sources.match_json import good_documents, listed_files, require_matches, scan_documents, skipped_files
from crease.sources.tables import read_table, refresh_table, table_paths

# Digits of the summaries when they are stored for display.
SUMMARY_DIGITS = {"bowling_summary": {"economy": 2}, "phase_summary": {"avg_runs": 2}}


#: Table of the files that were read: file, size, stamp.
MANIFEST = "loaded_files"
#: Paths of new files that one scan is given; they pass through the driver.
FILES_A_SCAN = 100_000


def ingest(spark: SparkSession, folder: str, target: str, kind: str = "parquet") -> dict[str, int]:
    """Read all documents, store the seven tables and the skipped files, return row counts.

    The documents are parsed once and kept in their nested form while the four tables
    are cut from them; the balls are stored before the summaries read them back. Each table
    is replaced in one step, and the manifest of the files last.
    """
    listed = staged(listed_files(spark, folder), "listing")
    parsed = staged(scan_documents(spark, folder), "documents")
    documents = require_matches(good_documents(parsed))
    counts = _store(spark, normalized_tables(documents), skipped_files(parsed), target, kind)
    refresh_table(listed, f"{target}/{MANIFEST}")
    return counts


def ingest_new(spark: SparkSession, folder: str, target: str, kind: str = "parquet") -> dict[str, int]:
    """Read the files that are new or have changed since the last call, and bring the tables up to date.

    Files are compared with the manifest by path, size and stamp; only those that differ are
    opened. The rows of a match are replaced by those of its new document. Rows of files that
    are gone stay. Without new files nothing is written and the counts are empty; without a
    manifest it is :func:`ingest`.
    """
    manifest = f"{target}/{MANIFEST}"
    if files.current_version(spark, manifest) is None:
        return ingest(spark, folder, target, kind)
    listed = staged(listed_files(spark, folder), "listing")
    fresh = listed.join(read_table(spark, manifest), ["file", "size", "stamp"], "left_anti").select("file")
    parsed = None
    paths = (r["file"] for r in fresh.toLocalIterator())
    while some := list(itertools.islice(paths, FILES_A_SCAN)):
        scanned = staged(scan_documents(spark, some), "documents")
        parsed = scanned if parsed is None else parsed.unionByName(scanned)
    if parsed is None:
        return {}
    replaced = parsed.select("match_id").distinct()
    places = table_paths(target, schemas.TABLES, kind)
    tables = {}
    for name, rows in normalized_tables(good_documents(parsed)).items():
        before = read_table(spark, places[name], schemas.TABLES[name], kind)
        tables[name] = before.join(replaced, "match_id", "left_anti").select(*rows.columns).unionByName(rows)
    skipped = read_table(spark, table_paths(target, ["skipped_files"], kind)["skipped_files"], _SKIPPED, kind)
    skipped = skipped.join(parsed.select("file").distinct(), "file", "left_anti").unionByName(skipped_files(parsed))
    counts = _store(spark, tables, skipped, target, kind)
    refresh_table(listed, manifest)
    return counts


_SKIPPED = T.StructType([T.StructField("file", T.StringType()), T.StructField("error", T.StringType())])


def _store(spark: SparkSession, tables: dict[str, DataFrame], skipped: DataFrame, target: str, kind: str) -> dict[str, int]:
    places = table_paths(target, [*schemas.TABLES, "skipped_files"], kind)
    counts = {name: refresh_table(table, places[name], kind) for name, table in tables.items()}
    balls = read_table(spark, places["deliveries"], schemas.DELIVERIES, kind)
    for name, table in summary_tables(balls).items():
        table = rounded(table, SUMMARY_DIGITS.get(name, {}))
        counts[name] = refresh_table(table, places[name], kind)
    counts["skipped_files"] = refresh_table(skipped, places["skipped_files"], kind)
    return counts


def summary_tables(deliveries: DataFrame) -> dict[str, DataFrame]:
    return {
        "batting_summary": batting_summary(deliveries),
        "bowling_summary": bowling_summary(deliveries),
        "phase_summary": phase_summary(deliveries),
    }


def audit(matches: DataFrame) -> DataFrame:
    """Number of matches and range of seasons, as one row."""
    return matches.agg(
        F.count(F.lit(1)).alias("matches"),
        F.min("season").alias("first_season"),
        F.max("season").alias("last_season"),
    )
