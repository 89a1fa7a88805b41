"""Arriving ledger entries as a stream: each survey is run once, and the checkpoint is what remembers it.

The same incremental run as ``sources.ledger``, for ledgers that arrive as files. ``availableNow`` makes it a batch
that picks up where the last one stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.ledger import run_pending

LEDGER_SCHEMA = "survey string, title string, modified_on timestamp, processed_by array<string>"


def run_arrivals(spark: SparkSession, folder: str, out: str, checkpoint: str, step: str, work: Callable[[str], str]):
    """Run ``work`` for the pending surveys among new ledger files; the run log is appended to ``out``."""
    def batch(entries: DataFrame, batch_id: int) -> None:
        latest = entries.dropDuplicates(["survey"])
        _, log = run_pending(latest, step, work)
        log.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    query = (spark.readStream.schema(LEDGER_SCHEMA).json(folder).writeStream.foreachBatch(batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query
