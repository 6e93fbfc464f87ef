"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

A document becomes a few statistics of its whole text.  Random Fourier features
of the standardised statistics approximate a Gaussian kernel.  Each partition of
the labelled rows sums its normal equations (a fixed-size matrix), the sums are
added in two steps, and the driver solves one system of ``features`` unknowns.
The raw scores of the labelled rows are counted in fixed bins and pooled into a
rising step function that turns raw scores into probabilities.

Only statistics of the text enter a score; labels, ids, language and source do
not.  All labelled rows outside the held-out third are used.

Defined results: null and empty texts have all-zero statistics and are scored
like any other; labels given twice for one id are averaged, null labels are
ignored; without any label the score is 0.5; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteflow.llm.common import blob, calls, written

#: The statistics, in order.
STATISTICS = ["log_words", "log_lines", "word_length", "line_words", "distinct_words", "distinct_triples",
              "distinct_lines", "commonest_word", "symbols", "bars", "exclamations", "upper", "digits", "stops",
              "spaces", "non_ascii", "entropy"]
_CLASSES = [(b"#*$%&|<>"), (b"|"), (b"!"), bytes(range(65, 91)), bytes(range(48, 58)), (b".,;:?"), (b" \t\n\x0b\x0c\r"),
            bytes(range(128, 256))]
_WEIGHTS = np.array([[float(b in c) for b in range(256)] for c in _CLASSES]).T


def statistics(text: bytes) -> list[float]:
    """Numbers that describe a whole text; all zero without a word."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    lines = [x for x in text.split(b"\n") if x.strip()]
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    p = counts[counts > 0] / len(text)
    distinct: dict[bytes, int] = {}
    for w in words:
        distinct[w] = distinct.get(w, 0) + 1
    triples = len(set(zip(words, words[1:], words[2:]))) / max(n - 2, 1) if n > 2 else 1.0
    return [np.log1p(n), np.log1p(len(lines)), len(text) / n, np.log1p(n / max(len(lines), 1)), len(distinct) / n,
            triples, len(set(lines)) / max(len(lines), 1), max(distinct.values()) / n,
            *(counts @ _WEIGHTS / len(text)).tolist(), float(-(p * np.log(p)).sum())]


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def described(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, x): the statistics of every document."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in calls(batches, "text"):
            x = [statistics(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["id", "x"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), blob(text_col).alias("text")).mapInArrow(
        kernel, f"id {id_type}, x array<double>")


@dataclass(frozen=True)
class Kernel:
    """Random features of a Gaussian kernel over standardised statistics."""

    mean: np.ndarray
    scale: np.ndarray
    features: int = 256
    bandwidth: float = 3.0
    seed: int = 20

    def map(self, x: np.ndarray) -> np.ndarray:
        draws = np.random.RandomState(self.seed)
        w = draws.normal(size=(x.shape[1], self.features)) / self.bandwidth
        phase = draws.uniform(0, 2 * np.pi, self.features)
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([np.ones((len(x), 1)), np.sqrt(2 / self.features) * np.cos(z @ w + phase)])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def normal_equations(taught: DataFrame, kernel: Kernel, branches: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """Sums of z z' and z y over all rows: per partition, then per branch, then on the driver."""
    width = kernel.features + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width + 1))
        for batch in batches:
            if batch.num_rows:
                z = kernel.map(_matrix(batch.column(0)))
                total += z.T @ np.column_stack([z, np.asarray(batch.column(1))])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = sorted(p for batch in batches for p in batch.column(0).to_pylist())
        if parts:
            total = sum((np.frombuffer(p) for p in parts[1:]), np.frombuffer(parts[0]).copy())
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    parts = taught.select("x", "y").mapInArrow(partial, "part binary").repartition(branches, F.xxhash64("part"))
    sums = sorted(bytes(r.part) for r in parts.mapInArrow(added, "part binary").collect())
    total = sum((np.frombuffer(p) for p in sums), np.zeros(width * (width + 1))).reshape(width, width + 1)
    return total[:, :-1], total[:, -1]


def rising_steps(bins: list[tuple[float, float, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators over (raw score, weight, mean label), sorted: knots and rising values."""
    pools: list[list[float]] = []
    for at, weight, mean in bins:
        pools.append([at * weight, weight, mean * weight])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.array([p[0] / p[1] for p in pools]), np.array([p[2] / p[1] for p in pools])


@dataclass(frozen=True)
class Model:
    kernel: Kernel
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.kernel.map(x) @ self.weights, -1, 2)

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0, 1)


def _raw_scores(rows: DataFrame, model: Model) -> DataFrame:
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(model.raw(_matrix(batch.column(0)))), batch.column(1)], names=["raw", "y"])

    return rows.select("x", "y").mapInArrow(kernel, "raw double, y double")


def fit(taught: DataFrame, ridge: float = 0.1, bins: int = 1000, **kernel) -> Model | None:
    """A model from (x, y) rows; None without rows."""
    n = len(STATISTICS)
    sums = taught.agg(F.count("*"), *[f(F.col("x")[i]) for i in range(n) for f in (F.avg, F.stddev_pop)]).first()
    if not sums[0]:
        return None
    moments = np.array(sums[1:], dtype=float).reshape(n, 2)
    shape = Kernel(moments[:, 0], np.where(moments[:, 1] > 1e-9, moments[:, 1], 1.0), **kernel)
    a, b = normal_equations(taught, shape)
    model = Model(shape, np.linalg.solve(a + ridge * np.eye(len(a)), b), np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    binned = _raw_scores(taught, model).groupBy(F.round(F.col("raw") * bins).alias("bin")).agg(
        F.count("*").alias("n"), F.avg("y").alias("y")).orderBy("bin").collect()  # 3 x bins rows at most
    knots, values = rising_steps([(r.bin / bins, float(r.n), r.y) for r in binned])
    return Model(shape, model.weights, knots, values)


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "quality", **options) -> DataFrame:
    """Per document: id, held_out, score, predicted."""
    rows = written(described(docs, id_col, text_col), "statistics")
    means = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.avg(label_col).cast("double").alias("y"))
    taught = written(rows.where(~held_out(F.col("id"))).join(means, "id").select("x", "y"), "taught")
    model = fit(taught, **options)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = model.score(_matrix(batch.column(1))) if model else np.full(batch.num_rows, 0.5)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["id", "score"])

    id_type = docs.schema[id_col].dataType.simpleString()
    out = rows.select("id", "x").mapInArrow(kernel, f"id {id_type}, score double")
    return out.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
