"""Incremental load of a growing folder with Structured Streaming.

An addition to the batch cursor: new files are found by the stream's own
checkpoint, and each batch is written by a function that is told its number,
so a repeated batch replaces what it wrote before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def load_new_files(spark: SparkSession, folder: str, schema: T.StructType, out: str, state: str, change: Callable[[DataFrame], DataFrame] = lambda df: df, per_batch: int = 1_000) -> int:
    """Load all files not loaded yet, then stop; return the number of batches."""
    seen = []

    def write(df: DataFrame, batch: int) -> None:
        change(df).write.mode("overwrite").parquet(f"{out}/batch={batch}")
        seen.append(batch)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(folder)
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(seen)
