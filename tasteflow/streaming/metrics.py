"""Durations of micro-batches, written as a table by the job itself."""

from __future__ import annotations

from pyspark.sql import SparkSession

SCHEMA = "query string, batch bigint, rows bigint, batch_ms bigint, add_ms bigint, started string, late bigint"


class BatchTimes:
    """The progress of one query's batches; ``write`` appends the batches since the last call to a table.

    ``late`` counts the rows that a watermark kept out.

    A query keeps its last hundred progress records; call ``write`` more often than that.
    """

    def __init__(self, query) -> None:
        self.query, self.last = query, -1

    def write(self, spark: SparkSession, path: str) -> None:
        rows = [(str(p["id"]), p["batchId"], p["numInputRows"], p["durationMs"].get("triggerExecution"),
                 p["durationMs"].get("addBatch"), p["timestamp"],
                 sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"]))
                for p in self.query.recentProgress if p["batchId"] > self.last and p["numInputRows"]]
        if rows:
            self.last = max(r[1] for r in rows)
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
