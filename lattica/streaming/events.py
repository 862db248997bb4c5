"""Windowed aggregates over a stream of timed events.

An extension: results of bounded queries are all that the relational and document forms
know.  The same function serves a batch, so the two can be compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def windowed(events: DataFrame, time: str, keys: list[str], aggregates: list[Column], width: str, slide: str | None = None, late: str | None = None) -> DataFrame:
    """Aggregates by window and key.  On a stream ``late`` bounds how late events come, and so
    the state: windows that end before the watermark are closed and dropped from it."""
    rows = events.withColumn(time, F.col(time).cast("timestamp"))
    if late:
        rows = rows.withWatermark(time, late)
    window = F.window(time, width, slide) if slide else F.window(time, width)
    grouped = rows.groupBy(window.alias("window"), *keys).agg(*aggregates)
    return grouped.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *[c for c in grouped.columns if c != "window"])


def sessions(events: DataFrame, time: str, keys: list[str], aggregates: list[Column], gap: str, late: str | None = None) -> DataFrame:
    """Aggregates by session: events of a key with no gap of ``gap`` or more between them."""
    rows = events.withColumn(time, F.col(time).cast("timestamp"))
    if late:
        rows = rows.withWatermark(time, late)
    grouped = rows.groupBy(F.session_window(time, gap).alias("window"), *keys).agg(*aggregates)
    return grouped.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *[c for c in grouped.columns if c != "window"])


def open_stream(spark: SparkSession, folder: str, like: DataFrame, files: int = 1, pattern: str = "*.parquet") -> DataFrame:
    """A stream of the Parquet files of a folder, a few per batch."""
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files).option("pathGlobFilter", pattern).parquet(folder)


def write_stream(df: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Closed windows to Parquet, once each, until what is there has been read."""
    return df.writeStream.outputMode("append").format("parquet").option("path", folder).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
