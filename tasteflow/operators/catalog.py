"""Catalogue enrichment: distinct tags per item, joined onto the item table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tags_by_item(tags: DataFrame, sep: str = "|") -> DataFrame:
    """(mid, tags): the distinct tags of each item, sorted, joined by ``sep``.

    Duplicates go first, spread over (mid, tag) and reduced within each map
    task, so an item's last step sees its distinct tags only.
    """
    distinct = tags.select("mid", "tag").distinct()
    listed = distinct.groupBy("mid").agg(F.sort_array(F.collect_list("tag")).alias("sorted"))
    return listed.select("mid", F.array_join("sorted", sep).alias("tags"))


def items_with_tags(movies: DataFrame, tag_rollup: DataFrame) -> DataFrame:
    """Every movie with its tag string (null when untagged)."""
    return movies.join(tag_rollup, "mid", "left")
