"""Contracts ingestion as a file stream.

The batch job re-reads a whole landing folder; here the file source tracks
which files were already ingested (in the checkpoint), so each run only
parses new documents.  A micro-batch goes through the batch load itself
(:meth:`Pipeline.load_contract_rows`), but is written as it comes: who reads a
table merges it with the rest (:meth:`Pipeline.settle_contracts` does for
good).  The newest publication of each contract stays, and rows without a key, values
that don't fit their type and the counts of both are kept under the batch's
id.  So the tables don't depend on how files fall into batches, in which order
they arrive, or which of them a batch load brought.  ``foreachBatch`` is
at-least-once; a batch replayed after a failure has the same id and changes
nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tenderlake import schemas
from tenderlake.plans.pipeline import Pipeline
from tenderlake.sinks.warehouse import Warehouse


def contract_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of landed contracts (one row per ``.marches[]`` element, values as text)
    from JSON documents landing in ``landing_dir``, one document per line."""
    reader = spark.readStream.schema(schemas.LANDED_DOCUMENT).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(landing_dir).select(F.explode("marches").alias("m")).select("m.*")


def ingest_contracts(spark: SparkSession, landing_dir: str, warehouse: Warehouse, checkpoint: str,
                     max_files_per_trigger: int | None = None, available_now: bool = True, name: str = "stream",
                     keep_versions: int | None = None) -> StreamingQuery:
    """Start the ingestion; with ``available_now`` it processes every file
    present and stops (a scheduled incremental run).

    ``name`` and the batch's number are its load id, so streams with their own
    checkpoint need their own name.  ``keep_versions`` bounds the storage of an
    endless stream.
    """
    pipe = Pipeline(spark, warehouse, check=False, keep_versions=keep_versions)
    writer = (contract_stream(spark, landing_dir, max_files_per_trigger).writeStream
              .foreachBatch(lambda df, batch: pipe.load_contract_rows(df, f"{name}-{batch}"))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
