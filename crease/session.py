"""Session settings the operators count on."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "crease", master: str | None = None, **settings: str) -> SparkSession:
    """Session with adaptive execution on, UTC times and no web page."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``, or, where that is unset, a
    folder in the warehouse, if all executors are in this process or the warehouse is not on a
    local disk. Otherwise a ValueError: a folder of one machine would lose rows."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not is_shared(spark.sparkContext.master, warehouse):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return f"{warehouse}/staged"


def is_shared(master: str, folder: str) -> bool:
    """Whether executors of this master surely see one and the same folder."""
    one_process = master == "local" or master.startswith("local[")
    return one_process or not folder.startswith(("file:", "/"))


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a frame that several jobs read, and return the written table.

    It lies in the shared folder, so a lost executor costs nothing but its own tasks,
    and later jobs read only the columns they need. The folder is the cluster's to clean.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
