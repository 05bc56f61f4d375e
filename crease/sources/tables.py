"""Reading and writing tables, and the registry of named ones."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crease import schemas
from crease.functions.scalars import blank_to_null
from crease.sources import files


class MissingTable(FileNotFoundError):
    """A table that must be there is not."""


def current_path(spark: SparkSession, path: str) -> str:
    """Where the rows of a table lie: its current version if it has versions, else the folder itself."""
    version = files.current_version(spark, path)
    return f"{path.rstrip('/')}/{version}" if version else path


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, text_only: bool = False
) -> DataFrame:
    """CSV with a header, in the given schema; blank text is read as NULL.

    With ``text_only`` every column stays text, for the tolerant conversions of
    :mod:`crease.functions.scalars`.
    """
    wanted = schemas.all_text(schema) if text_only else schema
    path = current_path(spark, path)
    df = (
        spark.read.schema(wanted)
        .option("header", True)
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    texts = [f.name for f in wanted.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({name: blank_to_null(name) for name in texts}) if texts else df


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, kind: str = "parquet", **options
) -> DataFrame:
    path = current_path(spark, path)
    if kind == "csv":
        return read_csv(spark, path, schema, **options)
    if kind == "json":
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.json(path)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.format(kind).load(path)


def write_table(
    df: DataFrame,
    path: str,
    kind: str = "parquet",
    columns: Sequence[str] | None = None,
    partition_by: Sequence[str] = (),
) -> int:
    """Replace a plain folder and return the number of rows written, counted on the way.

    The rows are written beside the folder and take its place when all are there, so a
    write that fails leaves the old rows. With ``partition_by`` the rows are rebalanced by
    these columns first: one file set per value, and a value with very many rows is split
    over several tasks.
    """
    spark, draft = df.sparkSession, f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    try:
        rows = _write(df, draft, kind, columns, partition_by)
    except BaseException:
        files.remove(spark, draft)
        raise
    files.swap_in(spark, draft, path)
    return rows


def refresh_table(
    df: DataFrame,
    path: str,
    kind: str = "parquet",
    columns: Sequence[str] | None = None,
    partition_by: Sequence[str] = (),
    keep: int = 2,
) -> int:
    """Replace a table by a new version of it in one step, and return the number of rows.

    Versions are folders in ``path``; a pointer file names the current one and is replaced
    last. So ``df`` may read the table itself, readers always find a whole table, and a
    write that fails changes nothing. The ``keep`` latest versions stay, for reads that
    have begun.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    version = f"version-{uuid.uuid4().hex}"
    try:
        rows = _write(df, f"{path}/{version}", kind, columns, partition_by)
    except BaseException:
        files.remove(spark, f"{path}/{version}")
        raise
    files.point_to(spark, path, version)
    written = [v for v in files.folders(spark, path) if v.startswith("version-") and v != version]
    for old in written[: max(0, len(written) + 1 - keep)]:
        files.remove(spark, f"{path}/{old}")
    return rows


def _write(df: DataFrame, path: str, kind: str, columns: Sequence[str] | None, partition_by: Sequence[str]) -> int:
    if columns:
        df = df.select(*columns)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    counted = Observation()
    writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).write.format(kind)
    if kind == "csv":
        writer = writer.options(
            header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return counted.get["rows"]


def table_paths(folder: str, names: Iterable[str], kind: str = "parquet") -> dict[str, str]:
    ending = ".csv" if kind == "csv" else ""
    return {name: f"{folder.rstrip('/')}/{name}{ending}" for name in names}


def register_tables(
    spark: SparkSession,
    folder: str,
    kind: str = "parquet",
    names: Mapping[str, T.StructType] = schemas.TABLES,
) -> dict[str, DataFrame]:
    """Read all named tables and make each a view; a missing one is an error."""
    tables = {}
    for name, path in table_paths(folder, names, kind).items():
        try:
            tables[name] = read_table(spark, path, names[name], kind)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            raise MissingTable(f"missing table {name}: {path}") from error
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    return tables


def save_metrics(metrics: DataFrame, path: str) -> None:
    """One-row frame of figures as JSON."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def load_metrics(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return read_table(spark, path, schema, "json")
