"""Structured Streaming forms of de-duplication and windowed counts.

State is bounded by the watermark: rows later than it are dropped by Spark, and the state of closed windows is released.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LATE = "2 hours"


def once(events: DataFrame, key: str = "event_id", at: str = "ts", late: str = LATE) -> DataFrame:
    """Each key once within the watermark."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def hourly(events: DataFrame, at: str = "ts", late: str = LATE) -> DataFrame:
    """Tumbling hourly counts and sums by type; the number of users is an approximation, the exact one has no bounded state."""
    w = events.withWatermark(at, late).groupBy(F.window(at, "1 hour").alias("w"), "event_type")
    return w.agg(F.count("*").alias("n"), F.approx_count_distinct("user_id").alias("users"), F.sum("value").alias("total")).select(F.col("w.start").alias("hour"), "event_type", "n", "users", "total")


def sessions(events: DataFrame, at: str = "ts", late: str = LATE, gap: str = "30 minutes") -> DataFrame:
    """Sessions of each user."""
    w = events.withWatermark(at, late).groupBy(F.session_window(at, gap).alias("w"), "user_id")
    return w.agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def new_texts(texts: DataFrame, at: str = "loaded_at", late: str = LATE) -> DataFrame:
    """Streaming exact de-duplication of texts by fingerprint."""
    from curatrix.functions.text import preprocess

    keyed = texts.withColumn("fingerprint", F.md5(preprocess(F.col("text"))))
    return keyed.withWatermark(at, late).dropDuplicatesWithinWatermark(["fingerprint"])
