"""Attempt logs as streams.

Micro-batches of attempts are appended to a Parquet log; the state of a key is the latest row of the log, so a batch
that is written twice after a failure changes nothing. Failed keys of a pass make up the next pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelwright.operators.records import TERMINAL, upsert

LOG = "query_key string, source string, commune string, manzana string, predio string, status string, attempts int, queried_at timestamp, response string, error string, seq long"


def append(stream: DataFrame, log: str, checkpoint: str) -> None:
    """Append everything that is available now. ``batch_id`` names the folder, so a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log}/batch={batch_id}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def state(spark: SparkSession, log: str) -> DataFrame:
    """The current row of every key."""
    return upsert(spark.read.schema(LOG).option("recursiveFileLookup", True).parquet(log))


def retry(spark: SparkSession, log: str) -> DataFrame:
    """The keys that a second pass must ask again."""
    return state(spark, log).where(~F.col("status").isin(*TERMINAL)).select("query_key")


def failures(spark: SparkSession, log: str, listed: int = 10) -> DataFrame:
    """The first failed keys by name, for the message that ends a run."""
    return state(spark, log).where("status = 'error'").orderBy("query_key").limit(listed).select("query_key", F.substring("error", 1, 500).alias("error"))


def status_by_window(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Attempts by event-time window and status, as a stream or a table."""
    timed = events.withWatermark("queried_at", late) if events.isStreaming else events
    return timed.groupBy(F.window("queried_at", window).alias("w"), "status").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "status", "n")
