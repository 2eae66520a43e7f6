"""New files since the last run: the incremental skip as a file stream.

The checkpoint remembers what was seen, so a rerun handles only what arrived.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def process_arrivals(
    spark: SparkSession,
    folder: str,
    schema: str,
    checkpoint: str,
    handle: Callable[[DataFrame, int], None],
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Hand every file that arrived since the last run to ``handle``, then stop.

    ``handle`` gets a batch and its number; a batch may be repeated after a failure,
    so it should overwrite by batch number or by recording.
    """
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
