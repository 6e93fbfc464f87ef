"""Compose delimited text lines from typed rows, and land them as text files.

Used to feed the text parsers and the file-source streams with data that
Spark derives from the given tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteflow.schemas import MOVIE_FIELDS

# Fixed value: the marker that tags rating payloads inside application log lines.
RATING_LOG_MARKER = "MOVIE_RATING_PREFIX:"


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def movie_lines(movies: DataFrame, sep: str = "^") -> DataFrame:
    return movies.select(F.concat_ws(sep, *[_text(c) for c in MOVIE_FIELDS]).alias("value"))


def rating_lines(ratings: DataFrame, sep: str = ",") -> DataFrame:
    return ratings.select(F.concat_ws(sep, *[_text(c) for c in ("uid", "mid", "score", "timestamp")]).alias("value"))


def tag_lines(tags: DataFrame, sep: str = ",") -> DataFrame:
    return tags.select(F.concat_ws(sep, *[_text(c) for c in ("uid", "mid", "tag", "timestamp")]).alias("value"))


def rating_event_lines(ratings: DataFrame, sep: str = "|") -> DataFrame:
    """Rating events ``uid|mid|score|timestamp`` with their event time."""
    return ratings.select(
        F.concat_ws(sep, *[_text(c) for c in ("uid", "mid", "score", "timestamp")]).alias("value"),
        F.col("timestamp").alias("event_time"),
    )


def rating_log_lines(ratings: DataFrame, marker: str = RATING_LOG_MARKER) -> DataFrame:
    """Application log lines carrying a rating payload after the marker."""
    payload = F.concat_ws("|", *[_text(c) for c in ("uid", "mid", "score", "timestamp")])
    return ratings.select(
        F.concat(F.lit("INFO rating "), F.col("timestamp").cast("string"), F.lit(" "), F.lit(marker), payload).alias("value"),
        F.col("timestamp").alias("event_time"),
    )


def activity_log_lines(tags: DataFrame) -> DataFrame:
    """Other application log lines (no marker), e.g. clicks and views."""
    return tags.select(
        F.concat(F.lit("INFO "), F.col("tag"), F.lit(" user="), F.col("uid").cast("string"),
                 F.lit(" item="), F.coalesce(F.col("mid").cast("string"), F.lit("none"))).alias("value"),
        F.col("timestamp").alias("event_time"),
    )


def write_lines(lines: DataFrame, path: str) -> str:
    """Write a ``value`` column as text files, one per partition of ``lines``."""
    lines.select("value").write.mode("overwrite").text(path)
    return path
