"""Run snapshots arriving as files, each delivery of a run loaded once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tabmill.sources.history import load_raw


def ingest_runs(
    spark: SparkSession, landing: str, raw: str, version: str, schema: T.StructType, checkpoint: str
) -> StreamingQuery:
    """Load the files that have arrived, as one batch, and stop. A run may arrive in several batches.

    The checkpoint remembers the files, the RAW table the deliveries by their content: a repeated file is not read
    again, and the same rows of a run arriving as a new file, or in a batch which is retried after a failure, are not added
    again.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        load_raw(batch, raw, version, skip="part")

    return (
        spark.readStream.schema(schema)
        .parquet(landing)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
