"""The suggestion table: each micro-batch is appended, the newest list per user is read.

A batch is one partition of an ordinary partitioned table, so a replay
overwrites its own rows.  Which list is newest is decided before, by the state
of :mod:`tasteflow.streaming.history`: an event older than the user's newest one
gives no list.  The reader still compares, so arrival order never matters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteflow.operators.topk import newest_per_key

ORDER = ("event_time", "event_mid", "event_score")


def append_lists(rows: DataFrame, path: str, batch_id: int) -> None:
    """Add the lists of a batch; the same batch id again replaces them."""
    rows.withColumn("batch", F.lit(int(batch_id))).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def newest_lists(spark: SparkSession, path: str) -> DataFrame:
    """(uid, recs, event_time, event_mid, event_score): the list of each user's newest event."""
    return newest_per_key(spark.read.parquet(path).drop("batch"), "uid", ORDER)


def compact(spark: SparkSession, path: str, to: str) -> None:
    """The newest lists as a table of their own, in one batch; an ordinary job, for a new ``to``."""
    append_lists(newest_lists(spark, path), to, 0)
