"""Language identification: multinomial naive Bayes over hashed character n-grams.

Features.  A text is lower-cased; letters stay, everything else becomes one
blank.  Its n-grams of 1 to 3 characters (no blank alone) are hashed into
``BUCKETS`` buckets.

Learning.  Each task sums the bucket counts of its documents by language and
gives the non-zero ones; Spark sums them over all tasks.  All labelled
documents count.

Scoring.  The matrix of log probabilities (buckets by languages) is broadcast,
at most ``BLOCK`` languages at a time (8 MB); with more languages the rows pass
once per block and carry the best language so far.  A task gathers the matrix
rows of a text's n-grams and adds them up.  The score is the posterior of the
predicted language.

Defined results: a null text or one without a letter is ``und`` with score 0,
and so is every text where nothing was learned; null languages are not learned
from; a null id counts as the empty text in the split; repeated rows get equal
results and count again in learning; a very long text is read in pieces, as if a
blank stood between them; equal scores go to the smallest language name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteflow.llm.common import calls, written

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
BLOCK = 32              # languages of one broadcast matrix
SMOOTHING = 0.5
CALL = 1 << 19          # bytes of text handled at once
PIECE = 1 << 18         # characters of one text handled at once
UNKNOWN = "und"
_C = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def _pieces(text: str) -> Iterator[str]:
    """A very long text in pieces, cut as a blank would cut it."""
    for at in range(0, max(len(text), 1), PIECE):
        yield text[at:at + PIECE]


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of every n-gram, text numbers ascending within each order."""
    parts = [np.frombuffer(f" {t} ".encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    code = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    number = np.repeat(np.arange(len(parts)), size)
    letter = _letters()[code]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[np.cumsum(size) - size] = True
    code, letter, number = np.where(letter, code, 32)[keep].astype(np.uint64), letter[keep], number[keep]
    whose, buckets = [], []
    h = np.zeros(len(code), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        if len(code) < n:
            break
        h = (h[:len(code) - n + 1] + code[n - 1:]) * _C
        h ^= h >> np.uint64(29)
        if n not in ORDERS:
            continue
        inside = number[:len(h)] == number[n - 1:]
        if n == 1:
            inside = letter
        whose.append(number[:len(h)][inside])
        buckets.append(((h[inside] * _C) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64))
    return (np.concatenate(whose), np.concatenate(buckets)) if whose else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _lowered(text: str | None) -> str:
    return (text or "").lower()


def held_out(id_: Column, of: int = 3, rest: int = 1) -> Column:
    """Whether the CRC-32 of the id's text leaves that remainder."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % of == rest


def learned(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, bucket, n) summed over all rows; bucket -1 counts the documents."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def send() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at - 1, pa.int32()),
                                                  pa.array(counts[at], pa.int64())], names=["lang", "bucket", "n"])
            held.clear()

        for batch in calls(batches, "text", CALL):
            langs = batch.column(0).to_pylist()
            texts = [_lowered(t) for t in batch.column(1).cast(pa.string()).to_pylist()]
            for lang in set(langs):
                if lang not in held:
                    if len(held) == BLOCK:
                        yield from send()
                    held[lang] = np.zeros(BUCKETS + 1, np.int64)
                mine = [t for t, of in zip(texts, langs) if of == lang]
                held[lang][0] += len(mine)
                for part in _groups(mine):
                    held[lang][1:] += np.bincount(features(part)[1], minlength=BUCKETS)
        yield from send()

    rows = labelled.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"),
                                                              F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(kernel, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def _groups(texts: list[str]) -> Iterator[list[str]]:
    """All texts, long ones in pieces, in portions of bounded size."""
    held, size = [], 0
    for text in texts:
        for piece in _pieces(text):
            if held and size + len(piece) > PIECE:
                yield held
                held, size = [], 0
            held.append(piece)
            size += len(piece)
    if held:
        yield held


def _matrix(counts: DataFrame, langs: list[str], total_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Log probabilities (buckets by languages) and log priors of at most BLOCK languages."""
    place = {lang: i for i, lang in enumerate(langs)}
    table = counts.where(F.col("lang").isin(langs)).toArrow()
    dense = np.zeros((BUCKETS + 1, len(langs)))
    column = np.array([place[x] for x in table["lang"].to_pylist()], dtype=np.int64)
    dense[np.asarray(table["bucket"]) + 1, column] = np.asarray(table["n"])
    prior = np.log(dense[0] / total_docs)
    grams = dense[1:] + SMOOTHING
    return np.log(grams / grams.sum(axis=0)).astype(np.float32), prior


def _scorer(model, langs: list[str]):
    """A kernel over (row, text, lang, best, whole): best log score so far and log of the sum of all."""

    def totals(texts: list[str]) -> np.ndarray:
        matrix, prior = model.value
        out = np.zeros((len(texts), len(langs)))
        owner, parts = [], []
        for i, text in enumerate(texts):
            for piece in _pieces(text):
                owner.append(i)
                parts.append(piece)
        at = 0
        while at < len(parts):
            end, size = at, 0
            while end < len(parts) and (end == at or size + len(parts[end]) <= PIECE):
                size += len(parts[end])
                end += 1
            number, bucket = features(parts[at:end])
            if len(number):
                first = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
                sums = np.add.reduceat(matrix[bucket], first, axis=0, dtype=np.float64)
                np.add.at(out, np.array(owner[at:end])[number[first]], sums)
            at = end
        return out + prior

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(langs, dtype=object)
        for batch in calls(batches, "text", CALL):
            texts = [_lowered(t) for t in batch.column("text").cast(pa.string()).to_pylist()]
            known = np.array([any(map(str.isalpha, t)) for t in texts], dtype=bool)
            scores = totals(texts)
            top = scores.argmax(axis=1)
            best = scores[np.arange(len(texts)), top]
            whole = np.log(np.exp(scores - best[:, None]).sum(axis=1)) + best
            old_best = np.asarray(batch.column("best").to_numpy(zero_copy_only=False), dtype=float)
            old_whole = np.asarray(batch.column("whole").to_numpy(zero_copy_only=False), dtype=float)
            old_lang = np.array(batch.column("lang").to_pylist(), dtype=object)
            better = known & (best > old_best)
            lang = np.where(better, names[top], old_lang)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("text"), pa.array(lang.tolist(), pa.string()),
                 pa.array(np.where(better, best, old_best)),
                 pa.array(np.where(known, np.logaddexp(old_whole, whole), old_whole))],
                names=["row", "text", "lang", "best", "whole"])

    return kernel


def predicted(docs: DataFrame, counts: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
              block: int = BLOCK) -> DataFrame:
    """The ``keep`` columns with ``lang_pred`` and ``score``, by the counts of :func:`learned` (a stored table)."""
    known = counts.where("bucket = -1").orderBy("lang").collect()  # a row per language
    langs, total = [r["lang"] for r in known], sum(r["n"] for r in known)
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), docs[text_col].cast("binary").alias("text"),
                       F.lit(UNKNOWN).alias("lang"), F.lit(float("-inf")).alias("best"), F.lit(float("-inf")).alias("whole"))
    for at in range(0, len(langs), block):
        some = langs[at:at + block]
        model = docs.sparkSession.sparkContext.broadcast(_matrix(counts, some, total))
        rows = rows.mapInArrow(_scorer(model, some), rows.schema)
        if at + block < len(langs):
            rows = written(rows, "language-scores")
    score = F.when(F.col("best") == float("-inf"), F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.exp(F.col("best") - F.col("whole"))))
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], F.col("lang").alias("lang_pred"), score.alias("score"))


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per document: id, ``held_out``, ``lang_pred`` and ``score``; learned from the documents that are not held out."""
    out = held_out(docs[id_col])
    counts = written(learned(docs.where(~out), lang_col, text_col), "language-counts")
    return predicted(docs, counts, text_col, keep=(id_col,)).select(
        id_col, held_out(F.col(id_col)).alias("held_out"), "lang_pred", "score")
