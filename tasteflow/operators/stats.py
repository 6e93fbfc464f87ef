"""Rating statistics: counts, monthly counts, averages, genres, top-k per genre."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteflow.functions.text import quote_literal, split_literal
from tasteflow.functions.time import format_year_month, year_month_number
from tasteflow.operators.topk import top_k_per_key

# The genres the statistics job ranks when no list is given, in their original order.
DEFAULT_GENRES = [
    "Crime", "Romance", "Thriller", "Adventure", "Drama", "War", "Documentary", "Fantasy", "Mystery",
    "Musical", "Animation", "Film-Noir", "IMAX", "Horror", "Western", "Comedy", "Children", "Action", "Sci-Fi",
]


def rating_counts(ratings: DataFrame, order_by: str = "mid") -> DataFrame:
    """Ratings per movie.  Sorted by movie id descending, or by ``order_by='count'``."""
    counts = ratings.groupBy("mid").agg(F.count("score").alias("rating_count"))
    if order_by == "count":
        return counts.orderBy(F.desc("rating_count"), F.asc("mid"))
    return counts.orderBy(F.desc("mid"))


def monthly_counts(ratings: DataFrame) -> DataFrame:
    """Ratings per (yyyyMM in UTC, movie); newest month first, then most rated."""
    keyed = ratings.select("mid", year_month_number("timestamp").alias("ym"))
    counts = keyed.groupBy("ym", "mid").agg(F.count("mid").alias("rating_count"))
    return counts.select(format_year_month("ym").alias("year_month"), "mid", "rating_count").orderBy(
        F.desc("year_month"), F.desc("rating_count"), F.asc("mid")
    )


def average_scores(ratings: DataFrame) -> DataFrame:
    """Mean score per movie."""
    return ratings.groupBy("mid").agg(F.avg("score").alias("avg_score"))


def genre_tokens(movies: DataFrame, sep: str = "|") -> DataFrame:
    """(mid, genre) for every token of the ``|``-joined genres.

    Empty fields count, except trailing ones; a field of separators alone has no token.
    """
    text = F.col("genres")
    kept = F.regexp_replace(text, F.lit(f"({quote_literal(sep)})+\\z"), F.lit(""))
    tokens = F.when((kept == "") & (text != ""), F.array().cast("array<string>")).otherwise(split_literal(kept, sep))
    return movies.select("mid", F.explode(tokens).alias("genre"))


def distinct_genres(movies: DataFrame, sep: str = "|") -> DataFrame:
    return genre_tokens(movies, sep).select("genre").distinct()


def distinct_users(ratings: DataFrame) -> DataFrame:
    return ratings.select("uid").distinct()


def genre_top_k(
    movies: DataFrame,
    averages: DataFrame,
    genres: Sequence[str] | None = None,
    k: int = 10,
    match: str = "substring",
) -> DataFrame:
    """Best ``k`` movies by average score for each genre of a list.

    ``match='substring'``: case-insensitive substring of the genres field
    (the list is broadcast, the movies stream through a nested-loop join
    with the predicate inside it).  ``match='token'``: equality with one
    ``|``-separated token (hash join).  Ties by ascending movie id.
    Returns ranked rows ``(genre, rank, mid, avg_score)``.
    """
    genres = list(DEFAULT_GENRES if genres is None else genres)
    # the list becomes a literal array in the plan: a local relation, no Python-side data
    genre_df = movies.sparkSession.range(1).select(F.explode(F.array(*[F.lit(g) for g in genres])).alias("genre"))
    scored = movies.select("mid", "genres").join(averages.select("mid", "avg_score"), "mid")
    if match == "substring":
        hits = scored.join(genre_df, F.lower(scored["genres"]).contains(F.lower(genre_df["genre"])))
        hits = hits.select("genre", "mid", "avg_score")
    elif match == "token":
        # one row per (movie, distinct lower-cased token): a word listed twice must not count twice
        tokens = scored.select(
            "mid", "avg_score", F.explode(F.array_distinct(split_literal(F.lower("genres"), "|"))).alias("token")
        ).where(F.col("token") != "")
        keyed = genre_df.select("genre", F.lower("genre").alias("token"))
        hits = tokens.join(keyed, "token").select("genre", "mid", "avg_score")
    else:
        raise ValueError(f"unknown match mode {match!r}")
    # a NaN average (from a NaN rating) ranks last
    ranked = top_k_per_key(hits, "genre", [F.isnan("avg_score").asc(), F.desc("avg_score"), F.asc("mid")], k)
    return ranked.select("genre", F.col("rank").cast("int").alias("rank"), "mid", "avg_score")
