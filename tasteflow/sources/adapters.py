"""Domain views over the driver's test tables (see FIXTURES.md part B).

ratings  <- lineitem x orders    (uid = customer, mid = part, score from quantity)
movies   <- part                 (genres = type + name words, '|'-joined)
tags     <- events               (mid from the JSON property k, tag = event type)
factors  <- embeddings           (id = vec_id, features as double)

Only the needed columns are selected before any join so the Parquet
scans prune columns; all expressions are built-ins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteflow.functions.time import epoch_seconds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("int").alias("uid"),
        F.col("l_partkey").cast("int").alias("mid"),
        (F.ceil(F.col("l_quantity") / 5) / 2).cast("double").alias("score"),
        epoch_seconds("l_shipdate").alias("timestamp"),
    )


def movies_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").cast("int").alias("mid"),
        F.col("p_name").alias("name"),
        F.lit("").alias("descri"),
        F.concat(F.col("p_size").cast("string"), F.lit(" minutes")).alias("timelong"),
        F.lit("").alias("shoot"),
        F.lit("").alias("issue"),
        F.lit("English").alias("language"),
        F.concat(F.col("p_type"), F.lit("|"), F.replace(F.col("p_name"), F.lit(" "), F.lit("|"))).alias("genres"),
        F.col("p_brand").alias("actors"),
        F.col("p_brand").alias("directors"),
    )


def tags_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("user_id").cast("int").alias("uid"),
        F.get_json_object("props", "$.k").cast("int").alias("mid"),
        F.col("event_type").alias("tag"),
        epoch_seconds("ts").alias("timestamp"),
    )


def factors_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(
        F.col("vec_id").cast("int").alias("id"),
        F.col("embedding").cast("array<double>").alias("features"),
    )
