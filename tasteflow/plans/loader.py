"""Load job: three delimited text inputs -> Movie, Rating, Tag tables (+ quarantine, + tag index).

Each input is scanned and parsed exactly once.  The parsed projection is
written in one pass, partitioned by ``status``: ``status=ok`` holds the
typed rows, ``status=reject`` the raw line and the reason (the raw column
is null for good rows, which Parquet stores almost for free).  Readers of
the clean table filter ``status = 'ok'``, a static partition filter.
``strict=True`` fails the writing job on the first bad line, like the
original loader.  The enriched movie index is built from the *written*
tables, so the index job has a short lineage and never re-parses text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteflow.operators.catalog import items_with_tags, tags_by_item
from tasteflow.operators.topk import newest_per_key
from tasteflow.schemas import MOVIE, RATING, TAG
from tasteflow.sources.tables import TableStore
from tasteflow.sources.text import Parsed, parse_movies, parse_ratings, parse_tags, read_lines

MOVIE_TABLE, RATING_TABLE, TAG_TABLE = "movie", "rating", "tag"
INDEX_TABLE = "movie_index"
OK, REJECT = "ok", "reject"


@dataclass(frozen=True)
class LoadedTables:
    movies: DataFrame
    ratings: DataFrame
    tags: DataFrame
    rejects: DataFrame


def write_parsed(
    parsed: Parsed, store: TableStore, name: str, columns: list[str], extra: dict | None = None, strict: bool = False
) -> None:
    """One pass: typed rows and quarantined lines into ``name``, partitioned by status.

    With layout columns the rows are first rebalanced on them, so a bucket is
    a few files of even size however many tasks parsed it; AQE splits a hot one.
    """
    ok = F.col("reason").isNull()
    extra = extra or {}
    bad = F.raise_error(F.concat(F.lit(f"{name}: "), "reason", F.lit(": "), "value")) if strict else F.lit(REJECT)
    out = parsed.staged.select(
        *columns,
        *[expr.alias(col) for col, expr in extra.items()],
        F.when(ok, F.lit(None).cast("string")).otherwise(F.col("value")).alias("raw"),
        "reason",
        F.when(ok, F.lit(OK)).otherwise(bad).alias("status"),
    )
    if extra:
        out = out.hint("rebalance", *extra)
    store.write(out, name, partition_by=["status", *extra])


def read_clean(spark: SparkSession, store: TableStore, name: str, schema, keep: tuple[str, ...] = ("uid_bucket",)) -> DataFrame:
    """The typed rows of a loaded table (``status = 'ok'`` partitions only).

    Layout columns listed in ``keep`` (the rating table's ``uid_bucket``)
    stay, so later per-user lookups can prune on them.
    """
    table = store.read(spark, name).where(F.col("status") == OK)
    extra = [F.col(c) for c in keep if c in table.columns]
    return table.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], *extra)


def read_rejects(spark: SparkSession, store: TableStore, names=(MOVIE_TABLE, RATING_TABLE, TAG_TABLE)) -> DataFrame:
    """All quarantined lines: (source, value, reason)."""
    out = None
    for name in names:
        part = store.read(spark, name).where(F.col("status") == REJECT).select(
            F.lit(name).alias("source"), F.col("raw").alias("value"), "reason"
        )
        out = part if out is None else out.unionByName(part)
    return out


def load_text_inputs(
    spark: SparkSession,
    movie_path: str,
    rating_path: str,
    tag_path: str,
    store: TableStore,
    strict: bool = False,
    rating_buckets: int | None = None,
    build_index: bool = True,
) -> LoadedTables:
    """Parse, store (overwrite) and return the three tables as read back from the store.

    ``rating_buckets`` partitions the rating table by a hash bucket of the
    user id, so per-user lookups (the real-time job's rated-set check) read
    only the buckets of the users they need.
    """
    movies = parse_movies(read_lines(spark, movie_path))
    ratings = parse_ratings(read_lines(spark, rating_path))
    tags = parse_tags(read_lines(spark, tag_path))

    write_parsed(movies, store, MOVIE_TABLE, MOVIE.fieldNames(), strict=strict)
    bucket = {"uid_bucket": F.pmod(F.xxhash64("uid"), F.lit(rating_buckets)).cast("int")} if rating_buckets else None
    write_parsed(ratings, store, RATING_TABLE, RATING.fieldNames(), extra=bucket, strict=strict)
    write_parsed(tags, store, TAG_TABLE, TAG.fieldNames(), strict=strict)

    loaded = LoadedTables(
        movies=read_clean(spark, store, MOVIE_TABLE, MOVIE),
        ratings=read_clean(spark, store, RATING_TABLE, RATING),
        tags=read_clean(spark, store, TAG_TABLE, TAG),
        rejects=read_rejects(spark, store),
    )
    if build_index:
        write_movie_index(loaded.movies, loaded.tags, store)
    return loaded


def write_movie_index(movies: DataFrame, tags: DataFrame, store: TableStore, index_store: TableStore | None = None) -> None:
    """Movies with their ``|``-joined distinct tags, written keyed by ``mid``: one document per id.

    Of several movies with one id, the last by name (then by its other fields) stays.  For a search-index connector pass ``index_store`` with its format and
    options (for example an id-mapping option naming ``mid``); the default
    is a Parquet table clustered by ``mid``.
    """
    index = items_with_tags(newest_per_key(movies, "mid", ["name"]), tags_by_item(tags)).select(*movies.columns, "tags")
    target = index_store or store
    if target.fmt == "parquet":
        index = index.repartitionByRange("mid").sortWithinPartitions("mid")
    target.write(index, INDEX_TABLE)
