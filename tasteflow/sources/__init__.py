"""Inputs: text parsing with quarantine, views over the test tables, named-table IO."""

from tasteflow.sources.adapters import factors_view, movies_view, ratings_view, tags_view
from tasteflow.sources.tables import TableStore, narrow
from tasteflow.sources.text import (
    Parsed,
    parse_movies,
    parse_rating_events,
    parse_ratings,
    parse_tags,
    read_lines,
)

__all__ = [
    "Parsed", "TableStore", "factors_view", "movies_view", "narrow", "parse_movies",
    "parse_rating_events", "parse_ratings", "parse_tags", "ratings_view", "read_lines",
    "tags_view",
]
