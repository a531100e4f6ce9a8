"""File streams of captured records and their sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnwright.session import new_path


def stream_parquet(spark: SparkSession, folder: str, schema: T.StructType, glob: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def stream_capture(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Captured JSON lines, plain or gzip, as they arrive."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).json(folder)


def with_event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Event time as a zoned timestamp (a watermark refuses one without zone) with a watermark."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def drop_repeats(df: DataFrame, key: str) -> DataFrame:
    """Each key once within the watermark delay; the state is dropped as the watermark passes."""
    return df.dropDuplicatesWithinWatermark([key])


def run_to_table(stream: DataFrame, label: str = "stream") -> DataFrame:
    """Process what is there, append it to a Parquet table in the shared folder, and read that table."""
    spark = stream.sparkSession
    path, state = new_path(spark, label), new_path(spark, f"{label}-state")
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def run_batches(stream: DataFrame, act: Callable[[DataFrame, int], None], label: str = "batches", mode: str = "append") -> None:
    """Process what is there, handing each micro-batch to ``act``."""
    state = new_path(stream.sparkSession, f"{label}-state")
    query = (
        stream.writeStream.foreachBatch(act)
        .outputMode(mode)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
