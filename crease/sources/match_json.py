"""Scan of a folder of match documents, one JSON document per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.schemas import CORRUPT, MATCH_DOCUMENT


class NoMatches(ValueError):
    """No document of the folder could be read."""


def _file_stem(name: str) -> Column:
    """File name without its ending; Spark gives names with %-escapes but a bare plus."""
    return F.url_decode(F.regexp_replace(F.regexp_replace(name, r"\.json$", ""), r"\+", "%2B"))


def scan_documents(spark: SparkSession, folder: str, stream: bool = False, **options) -> DataFrame:
    """All documents, good and bad; the id is the name of the file without its ending.

    The schema is given, so nothing is inferred and each file is parsed once. A file
    that is no valid document has its text in the corrupt-record column. With
    ``stream`` the files are read as they arrive.
    """
    reader = spark.readStream if stream else spark.read
    return (
        reader.schema(MATCH_DOCUMENT)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", "*.json")
        .options(**options)
        .json(folder)
        .select(
            "info",
            "innings",
            CORRUPT,
            F.col("_metadata.file_path").alias("file"),
            _file_stem("_metadata.file_name").alias("match_id"),
        )
    )


def listed_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file, size, stamp) of the documents in a folder; their content is not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(folder)
    return found.select(F.col("path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("stamp"))


def good_documents(scanned: DataFrame) -> DataFrame:
    return scanned.filter(F.col(CORRUPT).isNull()).select("match_id", "info", "innings")


def skipped_files(scanned: DataFrame) -> DataFrame:
    """Files that could not be read, with the reason and the whole record."""
    # Naming a second column matters: Spark refuses to read the corrupt record alone.
    extent = F.when(F.col("info").isNull(), "no").otherwise("only partly a")
    reason = F.concat(extent, F.lit(" valid match document: "), F.col(CORRUPT))
    return scanned.filter(F.col(CORRUPT).isNotNull()).select("file", reason.alias("error"))


def require_matches(documents: DataFrame) -> DataFrame:
    """The documents, or an error when there is none."""
    if documents.select(F.size("innings")).first() is None:
        raise NoMatches("no match document could be read; check the input folder")
    return documents
