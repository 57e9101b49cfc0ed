"""Streams of arriving files and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def arriving_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stream of (path, fingerprint, modified) of page files as they arrive."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.sha2("content", 256).alias("fingerprint"), F.col("modificationTime").alias("modified"))


def new_pages(pages: DataFrame, within: str = "7 days") -> DataFrame:
    """Pages whose fingerprint did not arrive before within the time."""
    return pages.withWatermark("modified", within).dropDuplicatesWithinWatermark(["fingerprint"])


def tumbling(events: DataFrame, at: str = "ts", width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """(start, event_type, n, total) per window and type; works for streams and tables."""
    rows = events.withWatermark(at, late) if events.isStreaming else events
    return rows.groupBy(F.window(at, width), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, at: str = "ts", gap: str = "6 hours", late: str = "1 hour") -> DataFrame:
    """(user_id, start, n) per session of a user."""
    rows = events.withWatermark(at, late) if events.isStreaming else events
    return rows.groupBy(F.session_window(at, gap), "user_id").agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("session_window.start").alias("start"), "n")
