"""Per (uid, item_id) aggregates of the interaction log."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from songweave.functions.columns import (
    DAY,
    DISLIKE,
    LIKE,
    LISTEN,
    decay_per_second,
    latest,
)

# Weights smaller than this count as zero.
NEGLIGIBLE = 1e-9


def flag(event: str) -> Column:
    """1 if the group has an event of this type, else 0."""
    return F.max((F.col("event_type") == event).cast("int"))


def interaction_counts(df: DataFrame, last_days: int = 300) -> DataFrame:
    """Listen count, best played ratio and like / dislike flags; nulls become 0.

    One conditional aggregate instead of three filtered copies joined together. Pairs that
    only have unlike / undislike events do not appear.
    """
    heard = F.col("event_type") == LISTEN
    recent = df.where(F.col("timestamp") > latest(df) - last_days * DAY)
    return (
        recent.where(F.col("event_type").isin(LISTEN, LIKE, DISLIKE))
        .groupBy("uid", "item_id")
        .agg(
            F.count_if(heard).alias("listen_count"),
            F.coalesce(F.max(F.when(heard, F.col("played_ratio_pct"))), F.lit(0.0)).alias(
                "played_ratio_max"
            ),
            flag(DISLIKE).alias("dislike_flag"),
            flag(LIKE).alias("like_flag"),
        )
    )


def decayed_sum(df: DataFrame, tau: float) -> DataFrame:
    """Sum of tau ** (user's last timestamp - timestamp) per (uid, item_id) as ``conf``.

    The user's last timestamp is not known while rows are summed, so rows are first summed
    per time block relative to the end of the block. That sum needs no window over raw rows
    and combines map-side, however many rows one user has; the blocks (one row per user,
    item and block) are then shifted to the user's last timestamp and added up.
    """
    ts = F.col("timestamp").cast("long")
    user = Window.partitionBy("uid")
    if tau == 0.0:
        # Only rows at the user's very last timestamp weigh anything.
        per_stamp = df.groupBy("uid", "item_id", ts.alias("_ts")).agg(
            F.count(F.lit(1)).alias("_n")
        )
        weight = F.when(F.col("_ts") == F.max("_ts").over(user), F.col("_n")).otherwise(F.lit(0))
        return (
            per_stamp.withColumn("_w", weight)
            .groupBy("uid", "item_id")
            .agg(F.sum("_w").cast("double").alias("conf"))
        )
    if tau == 1.0:
        return df.groupBy("uid", "item_id").agg(F.count(F.lit(1)).cast("double").alias("conf"))
    # Block length: tau ** length is about 1e-100, far above the smallest double.
    length = max(1, int(math.log(1e-100) / math.log(tau)))
    end = (F.floor(ts / length).cast("long") + 1) * length
    blocks = df.groupBy("uid", "item_id", end.alias("_end")).agg(
        F.sum(F.pow(F.lit(tau), end - ts)).alias("_sum"), F.max(ts).alias("_last")
    )
    shifted = blocks.withColumn("_user_last", F.max("_last").over(user))
    shift = F.pow(F.lit(tau), F.col("_user_last") - F.col("_end"))
    return shifted.groupBy("uid", "item_id").agg(F.sum(F.col("_sum") * shift).alias("conf"))


def decayed_play_weight(df: DataFrame, tau: float, min_ratio: float = 50) -> DataFrame:
    """Decayed count of real plays; ``weights`` is ``conf`` with negligible values set to 0."""
    plays = df.where((F.col("played_ratio_pct") > min_ratio) & (F.col("event_type") == LISTEN))
    weight = F.when(F.col("conf") < NEGLIGIBLE, F.lit(0.0)).otherwise(F.col("conf"))
    return decayed_sum(plays, tau).withColumn("weights", weight)


def ranking_target(df: DataFrame, last_days: int = 5, min_ratio: float = 50) -> DataFrame:
    """log1p of the plays of the last days, the label of the ranker."""
    recent = df.where(F.col("event_type") == LISTEN).where(
        (F.col("timestamp") > latest(df) - last_days * DAY)
        & (F.col("played_ratio_pct") > min_ratio)
    )
    return recent.groupBy("uid", "item_id").agg(F.log1p(F.count(F.lit(1))).alias("weights"))


def confidence_weights(counts: DataFrame, min_ratio: float = 50) -> DataFrame:
    """log1p of the listen count for pairs played past ``min_ratio``."""
    played = counts.where(F.col("played_ratio_max") > min_ratio)
    return played.withColumn("weights", F.log1p(F.col("listen_count").cast("double")))


def user_taste_history(
    df: DataFrame, hours: float = 0.5, decay: float = 0.9, min_ratio: float = 100
) -> DataFrame:
    """Items a user chose alone and finished or liked, shortly before their last such event."""
    chosen = df.where(
        (F.col("played_ratio_pct") >= min_ratio) | (F.col("event_type") == LIKE)
    ).where(F.col("is_organic") == 1)
    scored = decayed_sum(chosen, decay_per_second(decay, hours))
    return scored.where(F.col("conf") >= NEGLIGIBLE).select("uid", "item_id")
