"""Wiring of the two long-running queries.

1. log forwarder: raw application log lines -> rating payloads (topic or files)
2. real-time recommender: rating events -> per-user suggestion lists (keyed upsert)

Checkpoint locations default to folders under the session's shared
``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tasteflow.session import shared_dir
from tasteflow.streaming.logs import start_log_forwarder
from tasteflow.streaming.recommender import BOOST_ABOVE, CANDIDATE_K, MIN_SIM, RECENT_K, RealtimeRecommender


def start_forwarder(spark: SparkSession, source: str, sink: str, checkpoint: str | None = None, **kw):
    return start_log_forwarder(spark, source, sink, checkpoint or shared_dir(spark, "streams", "log-forwarder"), **kw)


def start_recommender(
    spark: SparkSession,
    source: str,
    similarity: DataFrame,
    ratings: DataFrame | None,
    table_path: str,
    checkpoint: str | None = None,
    recent_k: int = RECENT_K,
    candidate_k: int = CANDIDATE_K,
    min_sim: float = MIN_SIM,
    boost_above: float = BOOST_ABOVE,
    job_options: dict | None = None,
    **kw,
):
    """Start the real-time job; returns ``(query, job)``; ``job.close()`` stops it and drops its snapshot.

    The default checkpoint location is stable, so a restarted job resumes
    where it stopped, with the users' histories; replayed micro-batches are idempotent in the sink.
    """
    job = RealtimeRecommender(similarity, ratings, table_path, recent_k, candidate_k, min_sim, boost_above, **(job_options or {}))
    query = job.start(spark, source, checkpoint or shared_dir(spark, "streams", "recommender"), **kw)
    return query, job
