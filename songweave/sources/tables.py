"""Parquet sources and sinks, schema-aligned concatenation, embedding tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from songweave.functions.vectors import MIN_NORM, l2_norm, l2_normalize


def scan(spark: SparkSession, *paths: str, columns: list[str] | None = None) -> DataFrame:
    """Lazy parquet scan of files or folders of parts; projections and filters push down."""
    df = spark.read.parquet(*paths)
    return df.select(*columns) if columns else df


def sink(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Write parquet, optionally laid out by low-cardinality columns such as ``split``."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def transform_table(
    spark: SparkSession, source: str, target: str, fn: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Apply ``fn`` to a whole stored table and store the result elsewhere."""
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("source and target must differ: a job cannot overwrite what it reads")
    sink(scan(spark, source).transform(fn), target)
    return scan(spark, target)


def concat_aligned(first: DataFrame, second: DataFrame) -> DataFrame:
    """Stack two tables on the first one's schema: missing columns null, extra ones dropped."""
    aligned = [
        (F.col(f.name) if f.name in second.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in first.schema.fields
    ]
    return first.unionByName(second.select(*aligned))


def embeddings_in_catalogue(embeddings: DataFrame, log: DataFrame) -> DataFrame:
    """Vectors of items that occur in the interaction log."""
    items = log.select("item_id").where(F.col("item_id").isNotNull()).distinct()
    return embeddings.join(items, "item_id", "left_semi")


def embedding_table(embeddings: DataFrame, vector: str = "normalized_embed") -> DataFrame:
    """Search table: unit float32 vectors by item, without null or zero vectors."""
    usable = embeddings.where(F.col(vector).isNotNull()).where(l2_norm(F.col(vector)) > MIN_NORM)
    return usable.select(
        "item_id", l2_normalize(F.col(vector)).cast("array<float>").alias("normalized_embed")
    )
