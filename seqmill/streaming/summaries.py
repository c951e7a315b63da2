"""Streaming forms of the summaries; the batch operators have no streams, so these go beyond them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _timed(events: DataFrame, late: str) -> DataFrame:
    """A stream with a watermark, whose column must be a timestamp with a zone; a batch as it is."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if events.isStreaming else events


def event_counts(events: DataFrame, size: str = "1 hour", late: str = "10 minutes", keys: tuple[str, ...] = ("event_type",)) -> DataFrame:
    """Counts and sums by window and key; rows later than ``late`` behind the newest are left out of a stream."""
    rows = _timed(events, late)
    out = rows.groupBy(F.window("ts", size).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes", key: str = "user_id") -> DataFrame:
    """Activity of each key with no pause longer than ``gap``."""
    rows = _timed(events, late)
    out = rows.groupBy(key, F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return out.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def read_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)
