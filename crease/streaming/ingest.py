"""Match documents as they arrive, to the same tables as the batch ingestion.

A document holds a whole match, so each micro-batch can be normalized, and its over
checkpoints formed, by the batch operators; no state is carried between batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from crease.operators.checkpoints import checkpoint_frame
from crease.operators.normalize import deliveries_table, normalized_tables
from crease.session import staged
from crease.sources.match_json import good_documents, scan_documents, skipped_files
from crease.sources.tables import write_table


def arriving_documents(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    return scan_documents(spark, folder, stream=True, maxFilesPerTrigger=files_per_batch)


def store_tables(documents: DataFrame, target: str) -> StreamingQuery:
    """Write the tables of each micro-batch below ``target`` and stop when all is read.

    A batch replaces its own part, ``<table>/batch=<n>``, so a batch that runs again
    after a failure leaves no second copy. The progress lies beside the tables it counts
    for, so each target gets all documents, and a later run goes on where one ended.
    """

    def store(batch: DataFrame, number: int) -> None:
        parsed = staged(batch, "documents")
        tables = normalized_tables(good_documents(parsed))
        tables["checkpoints"] = checkpoint_frame(tables["deliveries"], tables["innings"])
        tables["skipped_files"] = skipped_files(parsed)
        for table, rows in tables.items():
            write_table(rows, f"{target}/{table}/batch={number}")

    return (
        documents.writeStream.foreachBatch(store)
        .option("checkpointLocation", f"{target}/_progress")
        .trigger(availableNow=True)
        .start()
    )


def arriving_deliveries(documents: DataFrame) -> DataFrame:
    """Balls of a stream of documents, a plain projection of it."""
    return deliveries_table(good_documents(documents))
