"""Expressions and helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import zlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words: blank and U+0009 to U+000D.
SPACE = "[\\x20\\x09-\\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words of a text; none when it is null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def fold(doc_id: Column, parts: int) -> Column:
    """CRC-32 of the id as text, modulo ``parts``."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts))


def fold_of(doc_id: int, parts: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % parts


def removed(spark: SparkSession, path: str) -> None:
    """Delete a written table that no job reads any more."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def settled(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of frames that are no longer referred to; it does so only after garbage is collected."""
    gc.collect()
    spark._jvm.System.gc()


def freed() -> None:
    """Give back what tasks before this one left in the same worker: garbage, and free memory that allocators keep for themselves."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
