"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteflow.session import shared_dir

#: A word: no space and none of \\x09-\\x0D.  Python's ``bytes.split()`` cuts at exactly these six bytes.
WORD = "[^\\x20\\x09-\\x0D]+"

#: Bytes of text that one call of a kernel handles; one longer document is a call of its own.
CALL_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written(df: DataFrame, label: str, batch_rows: int | None = None) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back: cuts the lineage, survives lost executors.

    ``batch_rows``: rows of an Arrow batch while it is written, for kernels whose rows are large.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "tasteflow-llm", f"{label}-{uuid.uuid4().hex[:12]}")
    usual = spark.conf.get(BATCH_ROWS)
    try:
        if batch_rows:
            spark.conf.set(BATCH_ROWS, str(batch_rows))
        df.write.parquet(path)
    finally:
        if batch_rows:
            spark.conf.set(BATCH_ROWS, usual)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text (null text: none)."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where ``body`` uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def blob(text: str) -> Column:
    """The UTF-8 bytes of a text column; null is empty."""
    return F.coalesce(F.col(text).cast("binary"), F.lit(b""))


def calls(batches: Iterable[pa.RecordBatch], sized: str, limit: int = CALL_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the Arrow batches whose binary column ``sized`` holds about ``limit`` bytes, so memory stays bounded."""
    for batch in batches:
        at, total = 0, 0
        column = batch.column(batch.schema.get_field_index(sized))
        for i, n in enumerate(pa.compute.binary_length(column).to_pylist()):
            if total and total + (n or 0) > limit:
                yield batch.slice(at, i - at)
                at, total = i, 0
            total += n or 0
        if at < batch.num_rows:
            yield batch.slice(at)
