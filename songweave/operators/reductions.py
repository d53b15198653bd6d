"""What all features of a log derive from: one reduction per (uid, item_id) and one per (uid, day).

Both come out of one pass over the log by grouping sets and are stored once. Another pass, over
the timestamps alone, finds the log's end, which recent plays are counted from.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from songweave.functions.columns import DAY, DISLIKE, LIKE, LISTEN, epoch_day, latest
from songweave.operators.features import (
    TIME_SUM_NAMES,
    item_stats_of,
    pair_profile_of,
    time_sums,
    user_stats_of,
)
from songweave.operators.interactions import flag
from songweave.session import cut_lineage


@dataclass(frozen=True)
class Reductions:
    """``pairs`` by uid and item_id, ``days`` by uid and day, ``last`` the log's end."""

    pairs: DataFrame
    days: DataFrame
    last: Column

    def user_music_stats(self) -> DataFrame:
        return user_stats_of(self.days, self.pairs, self.last)

    def item_stats(self) -> DataFrame:
        return item_stats_of(self.pairs, self.last)

    def pair_profile(self, meta: DataFrame) -> DataFrame:
        signals = self.pairs.where("reactions > 0").select(
            "uid",
            "item_id",
            F.when(F.col("listens") > 0, F.col("listens")).alias("listen_count"),
            "played_ratio_max",
            "last_listen_ts",
            "dislike_flag",
            "like_flag",
        )
        return pair_profile_of(signals, meta, self.last)


def reduce_log(df: DataFrame, mode: str = "iso") -> Reductions:
    """The stored reductions of a log.

    Rows with a null user, item or timestamp are counted under that null, as the features of the
    log itself do; other columns of the log are not looked at. An empty log has empty reductions.
    """
    ts, heard = F.col("timestamp"), F.col("event_type") == LISTEN
    age = latest(df) - ts
    keyed = df.select(
        "uid", "item_id", "timestamp", "event_type", "played_ratio_pct", "track_length_seconds",
        epoch_day(ts).alias("day"),
    )
    sums = keyed.groupingSets([["uid", "item_id"], ["uid", "day"]], "uid", "item_id", "day").agg(
        # The bit of a key is set where a row isn't grouped by it: day is the last, item_id before.
        (F.grouping_id() == 1).alias("by_item"),
        F.count(F.lit(1)).alias("plays"),
        F.count_if(heard).alias("listens"),
        F.count_if(F.col("event_type").isin(LISTEN, LIKE, DISLIKE)).alias("reactions"),
        F.max(F.when(heard, F.col("played_ratio_pct"))).alias("played_ratio_max"),
        F.max(F.when(heard, ts)).alias("last_listen_ts"),
        flag(DISLIKE).alias("dislike_flag"),
        flag(LIKE).alias("like_flag"),
        F.max("track_length_seconds").alias("track_length_seconds"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        F.count_if(age <= 5 * DAY).alias("p5"),
        F.count_if(age <= 30 * DAY).alias("p30"),
        *time_sums(ts, mode),
    )
    stored = cut_lineage(sums, "by_item")
    days = stored.where("not by_item").select(
        "uid", "day", "plays", "first_ts", "last_ts", *TIME_SUM_NAMES
    )
    pairs = stored.where("by_item").drop("by_item", "day", "last_ts")
    return Reductions(pairs, days, latest(days, "last_ts"))
