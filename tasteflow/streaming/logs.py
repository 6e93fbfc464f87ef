"""Application log lines -> rating payloads -> rating rows.

Works on batch and streaming DataFrames alike.  A line is forwarded when
it contains the marker; the payload is the text after the first marker
(up to a second one), JVM-trimmed.  A marker with nothing after it is
quarantined.  Each forwarded record carries a constant key and the wall
clock at ingestion.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteflow.functions.text import jvm_trim, payload_after
from tasteflow.sources.compose import RATING_LOG_MARKER
from tasteflow.sources.text import Parsed, parse_rating_events
from tasteflow.streaming.event_time import on_time_events

# Fixed value: the key every forwarded record carries.
FORWARD_KEY = "logProcessor"


@dataclass(frozen=True)
class Filtered:
    forwarded: DataFrame  # key, value (payload), ingest_time
    rejects: DataFrame  # value, reason


def filter_rating_logs(
    lines: DataFrame, marker: str = RATING_LOG_MARKER, key: str = FORWARD_KEY, value: str = "value"
) -> Filtered:
    raw = F.col(value)
    payload = jvm_trim(payload_after(raw, marker))
    staged = lines.where(F.instr(raw, marker) > 0).select(raw.alias("value"), payload.alias("payload"))
    forwarded = staged.where(F.col("payload") != "").select(
        F.lit(key).alias("key"), F.col("payload").alias("value"), F.current_timestamp().alias("ingest_time")
    )
    rejects = staged.where(F.col("payload") == "").select("value", F.lit("empty_payload").alias("reason"))
    return Filtered(forwarded, rejects)


def rating_events_from_logs(lines: DataFrame, marker: str = RATING_LOG_MARKER) -> Parsed:
    """Log lines -> filtered payloads -> typed rating events (rows + quarantine)."""
    filtered = filter_rating_logs(lines, marker)
    parsed = parse_rating_events(filtered.forwarded.select("value"))
    return Parsed(parsed.rows, parsed.rejects.unionByName(filtered.rejects))


def read_line_stream(
    spark: SparkSession,
    source: str,
    fmt: str = "text",
    max_files_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A stream of text lines (``value``) from files or from a message topic.

    ``fmt='text'``: files landing in ``source``.  ``fmt='kafka'``: ``options``
    carry the broker and topic (``kafka.bootstrap.servers``, ``subscribe``);
    the record value is decoded as UTF-8.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if fmt == "text":
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return reader.load(source)
    if fmt == "kafka":
        return reader.load().select(F.col("value").cast("string").alias("value"))
    return reader.load(source).select(F.col("value").cast("string").alias("value"))


def start_log_forwarder(
    spark: SparkSession,
    source: str,
    sink: str,
    checkpoint: str,
    marker: str = RATING_LOG_MARKER,
    sink_format: str = "parquet",
    sink_options: dict[str, str] | None = None,
    source_format: str = "text",
    source_options: dict[str, str] | None = None,
    trigger: dict | None = None,
    max_files_per_trigger: int | None = None,
):
    """Source -> marker filter -> sink, as one Structured Streaming query.

    A ``kafka`` sink gets the ``key``/``value`` columns (topic in
    ``sink_options``); file sinks also keep the ingestion time.
    ``trigger`` defaults to 2-second micro-batches.
    """
    lines = read_line_stream(spark, source, source_format, max_files_per_trigger, source_options)
    out = filter_rating_logs(lines, marker).forwarded
    if sink_format == "kafka":  # a topic record carries only key and value
        out = out.select("key", "value")
    writer = out.writeStream.format(sink_format).option("checkpointLocation", checkpoint).options(**(sink_options or {}))
    if sink_format not in ("kafka", "memory", "console"):
        writer = writer.option("path", sink)
    writer = writer.trigger(**(trigger or {"processingTime": "2 seconds"}))
    return writer.start()


def start_event_parser(
    spark: SparkSession,
    source: str,
    sink: str,
    checkpoint: str,
    marker: str = RATING_LOG_MARKER,
    trigger: dict | None = None,
    max_files_per_trigger: int | None = None,
    rejects_sink: str | None = None,
    delay: str | None = None,
):
    """Log lines -> typed rating events in a Parquet sink.

    Returns ``(events_query, rejects_query)``; the second is ``None`` unless
    ``rejects_sink`` is given, in which case quarantined lines stream there
    with their own checkpoint.  With ``delay`` repeats and late events stay out, see :func:`on_time_events`.
    """
    lines = read_line_stream(spark, source, "text", max_files_per_trigger)
    parsed = rating_events_from_logs(lines, marker)
    rows = on_time_events(parsed.rows, delay) if delay else parsed.rows
    trig = trigger or {"processingTime": "2 seconds"}
    query = (
        rows.writeStream.format("parquet").option("path", sink)
        .option("checkpointLocation", checkpoint).trigger(**trig).start()
    )
    rejects_query = None
    if rejects_sink:
        rejects_query = (
            parsed.rejects.writeStream.format("parquet").option("path", rejects_sink)
            .option("checkpointLocation", checkpoint.rstrip("/") + "-rejects").trigger(**trig).start()
        )
    return query, rejects_query
