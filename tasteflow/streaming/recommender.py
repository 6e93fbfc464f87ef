"""Real-time suggestions from a stream of rating events.

Lines ``uid|mid|score|timestamp`` -> the users' histories in Spark's state
store (:mod:`tasteflow.streaming.history`) -> per micro-batch, as joins on the
whole batch: unseen similar candidates, scored against the user's newest
ratings, one list per asking user (empty when nothing scored) -> append.

Ratings are live.  The stored ratings are the initial state; ``ratings_source``
streams in ratings that others store meanwhile, and ``store_ratings`` adds
the events themselves.  The similarity table is a snapshot taken at start, as in
the original job: an ordinary partitioned table, joined by item, or the factors
that it comes from, of which a batch computes the rows that it reads.  ``refresh``
takes a new one, ``close`` drops it.  Nothing is collected to the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteflow.operators import realtime
from tasteflow.operators.similarity import clean_factors, cosine_pairs, similar_lists
from tasteflow.schemas import FACTOR
from tasteflow.session import scratch_dir
from tasteflow.sources.text import parse_rating_events
from tasteflow.streaming import history, sink
from tasteflow.streaming.logs import read_line_stream
from tasteflow.streaming.metrics import BatchTimes

# List sizes and thresholds of the real-time job.
RECENT_K, CANDIDATE_K = 10, 10
MIN_SIM, BOOST_ABOVE = 0.6, 3.0


class SimilaritySnapshot:
    """The similarity table with each partner's place, stored as a bucketed table."""

    def __init__(self, similarity: DataFrame, buckets: int):
        self.spark, self.name = similarity.sparkSession, f"similarity_{uuid.uuid4().hex[:12]}"
        realtime.ranked_partners(similarity).write.bucketBy(buckets, "mid").sortBy("mid").saveAsTable(self.name)

    def of(self, items: DataFrame) -> DataFrame:
        """The rows of the given items (``mid``)."""
        return items.sparkSession.table(self.name).join(items.select("mid").distinct(), "mid", "left_semi")

    def known(self, asked: DataFrame) -> DataFrame:
        """The rows whose item is in the table: no other has a candidate."""
        return asked.join(asked.sparkSession.table(self.name).select("mid").distinct(), "mid", "left_semi")

    def partners(self, asked: DataFrame, words: DataFrame, k: int) -> DataFrame:
        """What :func:`realtime.unseen_by_words` reads."""
        return self.of(asked)

    def pairs(self, candidates: DataFrame, recent: DataFrame) -> DataFrame:
        """What :func:`realtime.realtime_scores` reads."""
        return self.of(candidates)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


class FactorSimilarity:
    """The similarity table of item factors, of which each batch computes the rows that it reads.

    The table grows with the square of the items; the snapshot is a stored copy of the factors.
    """

    def __init__(self, factors: DataFrame, threshold: float):
        self.sparkSession, self.threshold = factors.sparkSession, threshold
        self.path = scratch_dir(self.sparkSession, "factors")
        clean_factors(factors).write.parquet(self.path)

    def _factors(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(FACTOR).parquet(self.path)

    def known(self, asked: DataFrame) -> DataFrame:
        """The rows whose item has factors: no other has a candidate."""
        return asked.join(self._factors(asked.sparkSession).select(F.col("id").alias("mid")).distinct(), "mid", "left_semi")

    def partners(self, asked: DataFrame, words: DataFrame, k: int) -> DataFrame:
        lists = similar_lists(self._factors(asked.sparkSession), self.threshold, reach=realtime.item_reach(asked, words, k))
        return lists.withColumnRenamed("rank", "place")

    def pairs(self, candidates: DataFrame, recent: DataFrame) -> DataFrame:
        return cosine_pairs(self._factors(candidates.sparkSession), self.threshold, asked=realtime.scored_pairs(candidates, recent))

    def drop(self) -> None:
        pass


class RealtimeRecommender:
    def __init__(
        self,
        similarity: DataFrame | FactorSimilarity,
        ratings: DataFrame | None,
        table: str,
        recent_k: int = RECENT_K,
        candidate_k: int = CANDIDATE_K,
        min_sim: float = MIN_SIM,
        boost_above: float = BOOST_ABOVE,
        similarity_buckets: int = 64,
        store_ratings: bool = False,
        rejects_to: str | None = None,
        metrics_to: str | None = None,
    ):
        """``similarity``: the table, stored at once, or the factors of a table that grows too large.

        ``ratings``: stored ones, the initial state of a new checkpoint.  ``table``: folder of the suggestion table.

        ``store_ratings``: each batch's events count as ratings from the next batch on.  ``rejects_to``: folder for
        malformed lines, written by a query of its own.  ``metrics_to``: folder for the durations of the batches.
        """
        self.spark, self.buckets = similarity.sparkSession, similarity_buckets
        self.similarity = self._snapshot(similarity)
        self.ratings, self.table = ratings, table
        self.recent_k, self.candidate_k = recent_k, candidate_k
        self.min_sim, self.boost_above = min_sim, boost_above
        self.store_ratings, self.rejects_to, self.metrics_to = store_ratings, rejects_to, metrics_to
        self.batch = scratch_dir(self.spark, "batch")  # tables of one batch, replaced by the next
        self.adaptive = self.spark.conf.get("spark.sql.adaptive.enabled")
        self.query = self.rejects = self.times = None

    def _snapshot(self, similarity: DataFrame | FactorSimilarity) -> SimilaritySnapshot | FactorSimilarity:
        return similarity if isinstance(similarity, FactorSimilarity) else SimilaritySnapshot(similarity, self.buckets)

    def refresh(self, similarity: DataFrame | FactorSimilarity) -> None:
        """Take a new similarity snapshot; call between micro-batches."""
        old, self.similarity = self.similarity, self._snapshot(similarity)
        old.drop()

    def close(self) -> None:
        """Stop the queries, write the batch times, drop the snapshot."""
        for query in (self.query, self.rejects):
            if query is not None and query.isActive:
                query.stop()
        self._end_times()
        self.similarity.drop()

    def _end_times(self) -> None:
        if self.times is not None:
            self.times.write(self.spark, self.metrics_to)
            self.times = None

    def known(self, asked: DataFrame) -> DataFrame:
        """The rows of :func:`history.asked` that can have candidates, for :meth:`candidates` and :meth:`lists`."""
        return history.rated_counts(self.similarity.known(asked))

    def candidates(self, asked: DataFrame) -> DataFrame:
        """(uid, rank, mid, sim) for each row of :func:`history.asked`."""
        words = history.words_of(asked)
        return realtime.unseen_by_words(asked, self.similarity.partners(asked, words, self.candidate_k), words, self.candidate_k)

    def lists(self, asked: DataFrame, candidates: DataFrame, known: DataFrame | None = None) -> DataFrame:
        """(uid, recs, event_time, event_mid, event_score): the scored candidates of each asking user."""
        recent = history.recent_of(asked if known is None else known)
        scores = realtime.realtime_scores(candidates, recent, self.similarity.pairs(candidates, recent), self.min_sim, self.boost_above)
        users = asked.select("uid", F.col("timestamp").alias("event_time"), F.col("mid").alias("event_mid"),
                             F.col("score").alias("event_score"))
        return realtime.user_lists(users, scores, distinct_users=False)

    def _stored(self, rows: DataFrame, name: str) -> DataFrame:
        path = f"{self.batch}/{name}"
        rows.write.mode("overwrite").parquet(path)
        return rows.sparkSession.read.schema(rows.schema).parquet(path)

    def process_batch(self, asked: DataFrame, batch_id: int) -> None:
        spark, name = asked.sparkSession, "spark.sql.adaptive.enabled"
        before = spark.conf.get(name)
        spark.conf.set(name, self.adaptive)  # off in a stream for its state; a batch's joins have no state
        try:
            # the stateful operator runs once, in the partitions of its state; several joins read the stored rows
            asked = self._stored(asked, "asked")
            known = self._stored(self.known(asked), "known")
            candidates = self._stored(self.candidates(known), "candidates")
            sink.append_lists(self.lists(asked, candidates, known), self.table, batch_id)
        finally:
            spark.conf.set(name, before)
        if self.times is not None and batch_id % 50 == 49:
            self.times.write(asked.sparkSession, self.metrics_to)

    def start(
        self,
        spark: SparkSession,
        source: str,
        checkpoint: str,
        source_format: str = "text",
        source_options: dict[str, str] | None = None,
        trigger: dict | None = None,
        max_files_per_trigger: int | None = None,
        ratings_source: str | None = None,
    ):
        trigger = trigger or {"processingTime": "2 seconds"}
        parsed = parse_rating_events(read_line_stream(spark, source, source_format, max_files_per_trigger, source_options))
        events = parsed.rows.withColumn("asks", F.lit(True))
        if ratings_source:
            told = parse_rating_events(read_line_stream(spark, ratings_source)).rows
            events = events.unionByName(told.withColumn("asks", F.lit(False)))
        asked = history.asked(events, self.ratings, self.recent_k, self.store_ratings)
        self.query = asked.writeStream.foreachBatch(self.process_batch).outputMode("update").option(
            "checkpointLocation", checkpoint).trigger(**trigger).start()
        self._end_times()  # of a query started before
        if self.metrics_to:
            self.times = BatchTimes(self.query)
        if self.rejects_to:
            self.rejects = parsed.rejects.writeStream.format("parquet").option("path", self.rejects_to).option(
                "checkpointLocation", checkpoint.rstrip("/") + "-rejects").trigger(**trigger).start()
        return self.query
