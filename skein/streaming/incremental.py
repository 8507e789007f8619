"""New files of a folder as a stream: each row once, by key, handed on batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def arrivals(spark: SparkSession, path: str, schema: str, key: str, time: str, late: str = "1 hour") -> DataFrame:
    """Rows of parquet files as they arrive; of equal keys within the watermark only the first."""
    return spark.readStream.schema(schema).parquet(path).withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def processed(rows: DataFrame, handle: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Applies handle to each batch and appends the result; what is there now, then stops."""

    def batch(df: DataFrame, number: int) -> None:
        handle(df).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
