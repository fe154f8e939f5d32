"""Decoding and windowed counts (ST5-ST7, ST11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def decode(messages: DataFrame, ddl: str, value: str = "value") -> DataFrame:
    """ST5: message bytes to text to columns.

    ``inline`` keeps the parse in one place of the plan: a filter on a decoded column stays above
    it, where it would otherwise be pushed below and parse every message again.
    """
    return messages.select(F.inline(F.array(F.from_json(F.col(value).cast("string"), ddl))))


def windowed_counts(
    df: DataFrame,
    event_time: str,
    key: str,
    window: str = "10 minutes",
    slide: str = "5 minutes",
    lateness: str = "10 minutes",
) -> DataFrame:
    """ST6, ST7: counts per sliding window and key; the watermark bounds the state kept.

    On a plain table the watermark has no effect, so the batch answer is the same expression.
    """
    return (
        df.withWatermark(event_time, lateness)
        .groupBy(F.window(event_time, window, slide), key)
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            F.col("window.start").alias("start_time"),
            F.col("window.end").alias("end_time"),
            key,
            "count",
        )
    )


def word_events(messages: DataFrame, ddl: str) -> DataFrame:
    """One row per word of each timed message."""
    decoded = decode(messages, ddl).withColumn("event_time", F.col("event_time").try_cast("timestamp"))
    return decoded.select("event_time", F.explode(F.split("data", " ")).alias("word"))
