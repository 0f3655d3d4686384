"""Streaming forms of the usage operators.  Event time must be a timestamp column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_usage(events: DataFrame, keys: list[str], at: str, tokens: str, size: str = "60 seconds", slide: str | None = None, late: str = "2 minutes") -> DataFrame:
    """Requests and tokens of sliding windows; events later than the watermark are dropped."""
    window = F.window(at, size, slide) if slide else F.window(at, size)
    counted = events.withWatermark(at, late).groupBy(window.alias("window"), *keys)
    return counted.agg(F.count(F.lit(1)).alias("requests"), F.sum(tokens).alias("used_tokens")).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "requests", "used_tokens"
    )


def sessions(events: DataFrame, keys: list[str], at: str, gap: str, late: str = "2 minutes") -> DataFrame:
    """Activity of each key between pauses of ``gap``."""
    counted = events.withWatermark(at, late).groupBy(F.session_window(at, gap).alias("s"), *keys)
    return counted.agg(F.count(F.lit(1)).alias("n")).select(F.col("s.start").alias("started"), F.col("s.end").alias("ended"), *keys, "n")


def new_jobs(jobs: DataFrame, key: str, at: str, late: str = "1 hour") -> DataFrame:
    """Each job once, however often it is enqueued within the watermark."""
    return jobs.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def staged(stream: DataFrame, stages: list[Callable[[DataFrame, int], None]], checkpoint: str):
    """Runs each stage on every micro-batch of what has arrived so far, then stops; a restart goes on after the last batch."""

    def run(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            for stage in stages:
                stage(batch, number)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
