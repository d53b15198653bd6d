"""Train / test split in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from songweave.functions.columns import DAY, latest


def split_column(df: DataFrame, test_days: float = 1, gap_seconds: int = 30) -> Column:
    """'train' before the gap, 'test' after it, null inside it (both bounds strict)."""
    last = latest(df)
    test_from = last - int(test_days * DAY)
    ts = F.col("timestamp")
    return F.when(ts < test_from - gap_seconds, "train").when(ts > test_from, "test")


def with_split(df: DataFrame, test_days: float = 1, gap_seconds: int = 30) -> DataFrame:
    """Rows outside the gap with their ``split``, ready to be stored by split."""
    tagged = df.withColumn("split", split_column(df, test_days, gap_seconds))
    return tagged.where(F.col("split").isNotNull())


def time_split_with_gap(
    df: DataFrame, test_days: float = 1, gap_seconds: int = 30
) -> tuple[DataFrame, DataFrame]:
    """(train, test) as two filters against one lazy scalar."""
    test_from = latest(df) - int(test_days * DAY)
    train = df.where(F.col("timestamp") < test_from - gap_seconds)
    return train, df.where(F.col("timestamp") > test_from)
