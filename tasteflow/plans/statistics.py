"""Statistics job: rating counts, monthly counts, averages, top-k per genre.

Two surfaces over the same operators: DataFrames (``run_statistics``) and, for
users of SQL, temp views and a SQL function (``register_views``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tasteflow.functions.lists import ranked_to_lists
from tasteflow.operators import stats
from tasteflow.sources.tables import TableStore

RATE_MORE, RATE_MORE_RECENTLY, AVERAGE, GENRES_TOP = (
    "rate_more_movies", "rate_more_recently_movies", "average_movies", "genres_top_movies",
)

# Names of the SQL function and of the view that uses it.
MONTH_FUNCTION, MONTH_VIEW = "changeDate", "ratingofYearMonth"

# The body is one expression, which the optimizer inlines: no UDF runs.  UTC, as functions/time.py.
_MONTH_SQL = f"""CREATE OR REPLACE TEMPORARY FUNCTION {MONTH_FUNCTION}(seconds BIGINT)
RETURNS STRING COMMENT 'yyyyMM of epoch seconds, in UTC'
RETURN date_format(date_from_unix_date(CAST(floor(seconds / 86400) AS INT)), 'yyyyMM')"""


def run_statistics(
    movies: DataFrame,
    ratings: DataFrame,
    store: TableStore | None = None,
    genres: Sequence[str] | None = None,
    k: int = 10,
    match: str = "substring",
) -> dict[str, DataFrame]:
    """Build the four statistics; write them when a store is given.

    The averages are computed once and persisted: they feed both the
    average table and the genre ranking.
    """
    averages = stats.average_scores(ratings)
    if store is not None:
        averages = averages.persist()
    genre_lists = ranked_to_lists(
        stats.genre_top_k(movies, averages, genres, k=k, match=match), "genre", score="avg_score"
    ).withColumnRenamed("genre", "genres")
    out = {
        RATE_MORE: stats.rating_counts(ratings),
        RATE_MORE_RECENTLY: stats.monthly_counts(ratings),
        AVERAGE: averages,
        GENRES_TOP: genre_lists,
    }
    if store is not None:
        try:
            for name, df in out.items():
                store.write(df, name)
        finally:
            averages.unpersist()
    return out


def register_views(ratings: DataFrame, movies: DataFrame | None = None) -> None:
    """What SQL users query: the inputs, each plain statistic under its table name, the month function and its view.

    ``changeDate(seconds)`` gives ``yyyyMM``; ``ratingofYearMonth`` holds (mid, score, yearMonth) of every rating.
    """
    views = {"ratings": ratings, RATE_MORE: stats.rating_counts(ratings), AVERAGE: stats.average_scores(ratings),
             RATE_MORE_RECENTLY: stats.monthly_counts(ratings)}
    if movies is not None:
        views["movies"] = movies
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    spark = ratings.sparkSession
    spark.sql(_MONTH_SQL)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {MONTH_VIEW} AS "
              f"SELECT mid, score, {MONTH_FUNCTION}(timestamp) AS yearMonth FROM ratings")
