"""The listening-log data model as views over the supplied star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from songweave.sources.tables import scan


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return scan(spark, f"{folder}/{name}.parquet")


def interactions(spark: SparkSession, folder: str) -> DataFrame:
    """Dense log with all five event types, from ``events``."""
    ts = F.unix_timestamp("ts")
    item = F.regexp_extract("props", "([0-9]+)", 1).cast("long")
    heard = F.col("event_type").isin("view", "click")
    return _table(spark, folder, "events").select(
        F.col("user_id").alias("uid"),
        item.alias("item_id"),
        (ts - ts % 5).alias("timestamp"),
        F.when(heard, "listen")
        .when(F.col("event_type") == "purchase", "like")
        .when(F.col("event_type") == "error", "dislike")
        .when(F.col("event_id") % 2 == 0, "unlike")
        .otherwise("undislike")
        .alias("event_type"),
        F.when(heard, F.col("value")).alias("played_ratio_pct"),
        F.when(heard, 30 + (item * 37) % 400).alias("track_length_seconds"),
        (F.col("event_id") % 3 != 0).cast("int").alias("is_organic"),
        F.col("event_id").alias("seq"),
    )


def purchases(spark: SparkSession, folder: str) -> DataFrame:
    """Sparse log over a large catalogue, from ``lineitem`` and ``orders``."""
    heard = F.col("l_returnflag") != "R"
    lines = _table(spark, folder, "lineitem")
    orders = _table(spark, folder, "orders")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_custkey").alias("uid"),
        F.col("l_partkey").alias("item_id"),
        (F.unix_timestamp("l_shipdate") + F.col("l_linenumber") * 3600).alias("timestamp"),
        F.when(heard, "listen").otherwise("like").alias("event_type"),
        F.when(heard, F.col("l_quantity") * 3).alias("played_ratio_pct"),
        F.when(heard, 30 + (F.col("l_partkey") * 37) % 400).alias("track_length_seconds"),
        (F.col("l_linenumber") % 3 != 0).cast("int").alias("is_organic"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
    )


def items_meta(spark: SparkSession, folder: str) -> DataFrame:
    """Artist and album per item, with nulls."""
    key = F.col("p_partkey")
    brand = F.regexp_extract("p_brand", "([0-9]+)", 1).cast("long")
    return _table(spark, folder, "part").select(
        key.alias("item_id"),
        F.when(key % 17 != 0, brand).alias("artist_id"),
        F.when(key % 13 != 0, F.col("p_size").cast("long")).alias("album_id"),
        (30 + (key * 37) % 400).alias("track_length_seconds"),
    )


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Unit vectors by item, with the cluster label they were drawn from."""
    return _table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("item_id"), F.col("embedding").alias("normalized_embed"), "label"
    )


def embeddings_with_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors plus a second upload, under new ids, of every item with label 0 or 1."""
    base = embeddings(spark, folder)
    again = base.where(F.col("label") <= 1).withColumn("item_id", F.col("item_id") + 1000000)
    return base.unionByName(again)
