"""Places in the file system that the session's tables lie in, by Hadoop's file API."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

#: File of a table that names its current version.
POINTER = "_current"


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing happens if there is none."""
    system, place = _place(spark, path)
    system.delete(place, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, oldest first."""
    system, place = _place(spark, path)
    if not system.exists(place):
        return []
    found = [f for f in system.listStatus(place) if f.isDirectory()]
    return [f.getPath().getName() for f in sorted(found, key=lambda f: (f.getModificationTime(), f.getPath().getName()))]


def swap_in(spark: SparkSession, source: str, target: str) -> None:
    """Put a written folder in the place of another; what was there goes last."""
    system, new = _place(spark, source)
    _, place = _place(spark, target)
    _, old = _place(spark, f"{target.rstrip('/')}.old-{uuid.uuid4().hex}")
    had = system.exists(place)
    if had and not system.rename(place, old):
        raise OSError(f"{target} could not be moved")
    if not system.rename(new, place):
        if had:
            system.rename(old, place)
        raise OSError(f"{source} could not be moved to {target}")
    if had:
        system.delete(old, True)


def point_to(spark: SparkSession, table: str, version: str) -> None:
    """Make a version of a table the current one. The pointer is replaced in one step."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    system, draft = _place(spark, f"{table}/{POINTER}.{uuid.uuid4().hex}")
    stream = system.create(draft)
    stream.write(bytearray(version.encode()))
    stream.close()
    _, pointer = _place(spark, f"{table}/{POINTER}")
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.makeQualified(system.getUri(), system.getWorkingDirectory()).toUri(), conf).rename(
        system.makeQualified(draft), system.makeQualified(pointer), options
    )


def current_version(spark: SparkSession, table: str) -> str | None:
    """Name of the version the pointer names; None if the table has no pointer."""
    system, pointer = _place(spark, f"{table.rstrip('/')}/{POINTER}")
    if not system.exists(pointer):
        return None
    stream = system.open(pointer)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
