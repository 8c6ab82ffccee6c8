"""Incremental work over shards as they arrive: every new file exactly once, by Structured Streaming's checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def new_shards(spark: SparkSession, folder: str, schema: T.StructType, *, files_per_batch: int = 1000) -> DataFrame:
    """A stream of the JSON lines of a folder's new files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder).withColumn("file", F.input_file_name())


def process_new(stream: DataFrame, operate: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> None:
    """Applies an operator to all that is new and appends its rows; running it again takes only later files."""
    query = operate(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()


def fold_new(stream: DataFrame, fold: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hands every batch of new rows, with its number, to a fold that keeps its own state."""
    query = stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def windowed_counts(stream: DataFrame, time: str, key: str, window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Rows by key and event-time window, rows later than the watermark left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")


def distinct_stream(stream: DataFrame, key: str, time: str, late: str = "1 hour") -> DataFrame:
    """First rows of each key, the state of a key kept until the watermark has passed it."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
