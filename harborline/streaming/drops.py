"""Streams: late-tolerant window counts of events, and entity builds of dropped files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def event_windows(events: DataFrame, size: str = "1 hour", late: str = "2 hours",
    slide: str | None = None) -> DataFrame:
    """Count and value by window and type; works on a stream (with watermark) and on a table alike."""
    window = F.window("ts", size, slide) if slide else F.window("ts", size)
    return (
        events.withWatermark("ts", late).groupBy(window.alias("w"), "event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).cast("double")
            .alias("total_value"))
        .select(F.col("w.start").alias("window_start"), "event_type", "n", "total_value")
    )


def watch_folder(spark: SparkSession, folder: str, schema: str, build: Callable[[DataFrame, int], None],
    checkpoint: str) -> StreamingQuery:
    """Run ``build(batch, id)`` on each set of files that newly lies in a drop folder."""
    stream = spark.readStream.schema(schema).option("header", "true").option("escape", '"').csv(folder)
    return stream.writeStream.foreachBatch(build).option("checkpointLocation",
        checkpoint).trigger(availableNow=True).start()
