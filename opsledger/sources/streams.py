"""Event streams as streaming DataFrames, and sinks that a restart cannot duplicate."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from opsledger.sources.tables import path_exists, table_exists


def read_messages(spark: SparkSession, path: str | None = None, fmt: str = "text", **options: str) -> DataFrame:
    """Raw messages, one JSON text per row in `value`.

    `fmt="text"` follows a folder; any installed message source works too, its bytes being decoded.
    Where reading starts (earliest or latest) is a source option, e.g. `startingOffsets`.
    """
    reader = spark.readStream.format(fmt).options(**options)
    df = reader.load(path) if path else reader.load()
    return df.withColumn("value", F.col("value").cast("string"))


def read_rows(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options: str) -> DataFrame:
    """Typed rows appearing in a folder."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


class Unfinished(TimeoutError):
    """A stream was stopped before it had taken in everything that was there."""


def drain(writer, timeout: int | None = None) -> StreamingQuery:
    """Process everything available now, then stop. Beyond `timeout` seconds it is stopped and `Unfinished` raised."""
    running = writer.trigger(availableNow=True).start()
    if running.awaitTermination(timeout) is False:
        running.stop()
        raise Unfinished(f"not everything was processed within {timeout} seconds; the checkpoint holds what was")
    return running


def tail_messages(spark: SparkSession, path: str, seen: str, fmt: str = "text", **options: str) -> DataFrame:
    """Messages that arrive in a folder from now on: files there already are passed over.

    `seen` is a small folder for the names of those files; it is written once, so a restart goes on where it was.
    Message sources that know it take `startingOffsets=latest` in `read_messages` instead.
    """
    if not table_exists(spark, seen):
        there = spark.read.format("binaryFile").load(path).select("path") if path_exists(spark, path) else spark.createDataFrame([], "path string")
        there.write.parquet(seen)
    old = spark.read.parquet(seen).withColumnRenamed("path", "_path")
    rows = spark.readStream.format(fmt).options(**options).load(path).select(F.col("value").cast("string").alias("value"), F.col("_metadata.file_path").alias("_path"))
    return rows.join(old, "_path", "left_anti").select("value")


def run_for(writer, seconds: int) -> StreamingQuery:
    """Follow a stream for a limited time."""
    running = writer.start()
    if not running.awaitTermination(seconds):
        running.stop()
    return running


def each_batch(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]):
    """A writer that hands every micro-batch to `handle(batch, batch_id)`."""
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle)


def append_sink(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet"):
    """An append-only table sink; the checkpoint makes it exactly-once."""
    return stream.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint).option("path", path)


def write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet", by: str | None = None) -> None:
    """Write one micro-batch to its own partition folder, below it by the values of `by`. Repeating the batch replaces it."""
    # Rebalancing brings the rows of a value together and splits values with very many.
    writer = df.write if by is None else df.hint("rebalance", by).write.partitionBy(by)
    writer.format(fmt).mode("overwrite").save(f"{path}/batch_id={batch_id}")
