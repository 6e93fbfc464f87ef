"""Event time: late events and repeats, bounded by a watermark.

An event's time is its rating time, but never after the batch's clock: one event
dated far ahead would otherwise make every other event late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("uid", "mid", "score", "timestamp")


def on_time_events(events: DataFrame, delay: str, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Every distinct event once, unless its first arrival was late.

    Late: more than ``delay`` (such as ``"2 days"``) older than the newest event time of earlier batches.  The state
    holds the events of the last ``delay`` only.  A repeat carries the same time, so it is either late itself or meets its
    first arrival in the state: no repeat passes.  An event dated ahead of the clock passes again at most once per
    ``delay``.  A watermark begins at 1970, so an event at or before its first second is late.  On a batch nothing is late.  Parsed events
    have no null time; any column but ``timestamp`` may be null (nulls are equal).
    """
    now = F.unix_timestamp(F.current_timestamp())
    seconds = F.greatest(F.least(F.col("timestamp").cast("long"), now), F.lit(0))
    stamped = events.withColumn("event_time", F.timestamp_seconds(seconds))
    if not events.isStreaming:
        return stamped.dropDuplicates(list(keys)).drop("event_time")
    return stamped.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(list(keys)).drop("event_time")
