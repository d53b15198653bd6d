"""Scalar column expressions shared by the operators.

Timestamps are epoch seconds. Calendar parts come from integer arithmetic, so
they do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Scores are sums whose last bits depend on the order of addition. Lists are ordered by the
# score at this many significant digits, so equal scores tie, lists do not change with the
# partitioning, and small scores are told apart as well as large ones.
SCORE_DIGITS = 9

HOUR = 3600
DAY = 86400

LISTEN, LIKE, DISLIKE = "listen", "like", "dislike"


def epoch_day(ts: Column) -> Column:
    """Days since 1970-01-01."""
    return F.floor(ts / DAY).cast("long")


def hour_of_day(ts: Column) -> Column:
    return F.pmod(F.floor(ts / HOUR).cast("long"), F.lit(24))


def iso_weekday(ts: Column) -> Column:
    """1 = Monday … 7 = Sunday; day 0 of the epoch was a Thursday."""
    return F.pmod(epoch_day(ts) + 3, F.lit(7)) + 1


def decay_per_second(decay: float, hours: float) -> float:
    """Factor tau with tau ** (3600 * hours) == decay; 0 when the period is empty."""
    return 0.0 if hours == 0 else decay ** (1.0 / (HOUR * hours))


def latest(df: DataFrame, ts: str = "timestamp") -> Column:
    """The largest timestamp of ``df`` as a lazy scalar subquery (no driver round trip)."""
    return df.agg(F.max(ts)).scalar()


def unit_hash(seed: int, *keys: str) -> Column:
    """Uniform number in [0, 1) from the first 32 bits of md5(seed|key|...)."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def hash_order(seed: int, *keys: str) -> Column:
    """md5(seed|key|...) as an order that looks random but repeats on every run."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def comparable(score: str | Column) -> Column:
    """The score as lists are ordered by it: rounded to ``SCORE_DIGITS`` significant digits.

    Scores too small to be scaled up stay as they are.
    """
    value = (F.col(score) if isinstance(score, str) else score).cast("double")
    scale = F.pow(F.lit(10.0), SCORE_DIGITS - 1 - F.floor(F.log10(F.abs(value))))
    return F.when(F.abs(value) < 1e-290, value).otherwise(F.round(value * scale) / scale)


def top_per_key(
    df: DataFrame,
    key: str | list[str],
    score: str,
    n: int | None,
    tie: str = "item_id",
    rank: str = "rank",
) -> DataFrame:
    """Rank rows per key by score descending, ties by id, and keep the first ``n``."""
    keys = [key] if isinstance(key, str) else key
    order = Window.partitionBy(*keys).orderBy(comparable(score).desc(), F.asc(tie))
    ranked = df.withColumn(rank, F.row_number().over(order))
    return ranked if n is None else ranked.where(F.col(rank) <= n)
