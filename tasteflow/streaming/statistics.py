"""Rating statistics kept up to date by a stream.

One streaming aggregation in update mode keeps (rows, scores, sum of scores) per item and month, and every batch
appends the groups it changed.  The three statistics are sums of these, so one shuffle and one state serve all, and
seeds counted from stored ratings are simply added.

The table has one partition per batch: a replay overwrites its own, and the reader takes each group's newest row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteflow.functions.time import format_year_month, year_month_number
from tasteflow.sources.text import parse_rating_events
from tasteflow.streaming.event_time import on_time_events
from tasteflow.streaming.logs import read_line_stream

SCHEMA = "mid int, ym int, n_rows bigint, n_scores bigint, total double, batch bigint"
SEED, FOLDED = -1, -2  # partitions that no micro-batch has
_SUMS = ("n_rows", "n_scores", "total")


def partial_statistics(ratings: DataFrame) -> DataFrame:
    """(mid, ym, n_rows, n_scores, total) of ratings, batch or stream; a hot item is reduced before the shuffle."""
    keyed = ratings.select("mid", "score", year_month_number("timestamp").alias("ym"))
    return keyed.groupBy("mid", "ym").agg(
        F.count("mid").alias("n_rows"), F.count("score").alias("n_scores"), F.sum("score").alias("total"))


def _put(rows: DataFrame, path: str, batch: int) -> None:
    rows.withColumn("batch", F.lit(batch).cast("bigint")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def seed_statistics(ratings: DataFrame, path: str) -> None:
    """Count the ratings stored before the stream began; again replaces the earlier seed."""
    _put(partial_statistics(ratings), path, SEED)


def start_statistics(
    spark: SparkSession,
    source: str,
    path: str,
    checkpoint: str,
    source_format: str = "text",
    source_options: dict[str, str] | None = None,
    trigger: dict | None = None,
    max_files_per_trigger: int | None = None,
    delay: str | None = None,
):
    """Rating event lines -> changed groups per batch under ``path``.

    Without ``delay`` every event counts, however old and often repeated; with it, see :func:`on_time_events`.
    """
    lines = read_line_stream(spark, source, source_format, max_files_per_trigger, source_options)
    events = parse_rating_events(lines).rows
    if delay:
        events = on_time_events(events, delay)
    return partial_statistics(events).writeStream.foreachBatch(lambda df, batch: _put(df, path, int(batch))).outputMode(
        "update").option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "2 seconds"})).start()


def _newest(rows: DataFrame) -> DataFrame:
    newest = rows.groupBy("mid", "ym").agg(F.max(F.struct("batch", *_SUMS)).alias("at"))
    return newest.select("mid", "ym", *[F.col(f"at.{c}").alias(c) for c in _SUMS])


def maintained(spark: SparkSession, path: str) -> DataFrame:
    """The table's present state, like :func:`partial_statistics`; a group may have a seed row beside its streamed one."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    seed = rows.where(F.col("batch") == SEED).drop("batch")
    return _newest(rows.where(F.col("batch") != SEED)).unionByName(seed)


def fold(spark: SparkSession, path: str, to: str) -> None:
    """A stopped query's table in two partitions under a new path, with which the query may be started again."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    _put(_newest(rows.where(F.col("batch") != SEED)), to, FOLDED)
    _put(rows.where(F.col("batch") == SEED).drop("batch"), to, SEED)


def rating_counts(parts: DataFrame) -> DataFrame:
    """As :func:`tasteflow.operators.stats.rating_counts`, from the maintained sums."""
    return parts.groupBy("mid").agg(F.sum("n_scores").alias("rating_count")).orderBy(F.desc("mid"))


def monthly_counts(parts: DataFrame) -> DataFrame:
    """As :func:`tasteflow.operators.stats.monthly_counts`, from the maintained sums."""
    counts = parts.groupBy("ym", "mid").agg(F.sum("n_rows").alias("rating_count"))
    return counts.select(format_year_month("ym").alias("year_month"), "mid", "rating_count").orderBy(
        F.desc("year_month"), F.desc("rating_count"), F.asc("mid"))


def average_scores(parts: DataFrame) -> DataFrame:
    """As :func:`tasteflow.operators.stats.average_scores`, from the maintained sums."""
    mean = F.sum("total") / F.nullif(F.sum("n_scores"), F.lit(0))
    return parts.groupBy("mid").agg(mean.alias("avg_score"))
