"""User, item and user-item features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from songweave.functions.columns import (
    DAY,
    DISLIKE,
    LIKE,
    LISTEN,
    epoch_day,
    hour_of_day,
    iso_weekday,
    latest,
)
from songweave.operators.interactions import flag

# Days since the last play of a pair that was never played.
NEVER_PLAYED = 9999

# First and last hour of each part of the day.
DAY_PARTS = {"morning": (6, 11), "day": (12, 17), "evening": (18, 23), "night": (0, 5)}


def _weekday_number(ts: Column, mode: str) -> Column:
    """Weekday as compared with 5: ISO 1-7 as executed, 0-6 as documented."""
    if mode not in ("iso", "documented"):
        raise ValueError(f"unknown weekday mode {mode!r}")
    return iso_weekday(ts) if mode == "iso" else iso_weekday(ts) - 1


def time_sums(ts: Column, mode: str = "iso") -> list[Column]:
    """Additive parts of a time profile; sums of sums stay right across levels."""
    hour, weekday = hour_of_day(ts), _weekday_number(ts, mode)
    parts = [F.count_if(hour.between(a, b)).alias(f"_{p}") for p, (a, b) in DAY_PARTS.items()]
    return parts + [
        F.count_if(weekday < 5).alias("_weekday"),
        F.count_if(weekday >= 5).alias("_weekend"),
        F.sum(hour).alias("_hours"),
        F.sum(weekday).alias("_weekdays"),
        F.count(ts).alias("_stamped"),
    ]


TIME_SUM_NAMES = [*(f"_{p}" for p in DAY_PARTS), "_weekday", "_weekend", "_hours", "_weekdays",
                  "_stamped"]


def add_up(names: list[str]) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def time_shares(plays: str, prefix: str = "", count_name: str | None = None) -> list[Column]:
    """Shares and means from the summed parts."""
    n = F.col(plays)
    shares = [
        (F.col(f"_{p}") / n).alias(f"{prefix}{p}_share")
        for p in [*DAY_PARTS, "weekday", "weekend"]
    ]
    means = [
        F.try_divide("_hours", "_stamped").alias(f"{prefix}avg_listen_hour"),
        F.try_divide("_weekdays", "_stamped").alias(f"{prefix}avg_listen_weekday"),
    ]
    return [n.alias(count_name or f"{prefix}plays_for_time_profile"), *shares, *means]


def time_profile(
    df: DataFrame, key: str, prefix: str = "", count_name: str | None = None, mode: str = "iso"
) -> DataFrame:
    """Plays by part of day and week per ``key``, as shares."""
    sums = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_plays"), *time_sums(F.col("timestamp"), mode)
    )
    return sums.select(key, *time_shares("_plays", prefix, count_name))


def item_time_profile(df: DataFrame, mode: str = "iso") -> DataFrame:
    return time_profile(df, "item_id", "item_", mode=mode)


def user_time_profile(df: DataFrame, mode: str = "iso") -> DataFrame:
    return time_profile(df, "uid", "", "user_plays_for_time_profile", mode)


def daily_plays(df: DataFrame, mode: str = "iso") -> DataFrame:
    """One row per user and day: the only pass over raw events that user statistics need."""
    return df.groupBy("uid", epoch_day(F.col("timestamp")).alias("day")).agg(
        F.count(F.lit(1)).alias("plays"),
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
        *time_sums(F.col("timestamp"), mode),
    )


def median_daily_plays(df: DataFrame) -> DataFrame:
    """Exact median of a user's daily event counts; the state is bounded by the number of days."""
    days = df.groupBy("uid", epoch_day(F.col("timestamp")).alias("day")).agg(
        F.count(F.lit(1)).alias("plays")
    )
    return days.groupBy("uid").agg(F.median("plays").alias("median_daily_plays"))


def user_music_stats(df: DataFrame, mode: str = "iso") -> DataFrame:
    """Activity, variety, recency, lifetime and time profile per user (all event types)."""
    tracks = df.groupBy("uid", "item_id").agg(F.lit(1).alias("_one"))
    return user_stats_of(daily_plays(df, mode), tracks, latest(df))


def user_stats_of(days: DataFrame, tracks: DataFrame, last: Column) -> DataFrame:
    """User statistics from one row per user and day and one per user and item."""
    per_user = days.groupBy("uid").agg(
        F.sum("plays").alias("user_total_plays"),
        F.count(F.lit(1)).alias("user_active_days"),
        F.median("plays").alias("median_daily_plays"),
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
        *add_up(TIME_SUM_NAMES),
    )
    # A null item counts as one more track.
    tracks = tracks.groupBy("uid").agg(F.count(F.lit(1)).alias("user_unique_tracks"))
    lifetime = (last - F.col("first_ts")) / DAY
    return per_user.join(tracks, "uid").select(
        "uid",
        "user_total_plays",
        "user_active_days",
        "user_unique_tracks",
        "median_daily_plays",
        (F.col("user_unique_tracks") / F.col("user_total_plays")).alias("unique_tracks_share"),
        ((last - F.col("last_ts")) / DAY).alias("days_since_last_play"),
        "first_ts",
        "last_ts",
        lifetime.alias("user_lifetime_days"),
        F.when(lifetime == 0, F.lit(1.0)).otherwise(lifetime).alias("user_lifetime_days_safe"),
        *time_shares("user_total_plays", "", "user_plays_for_time_profile"),
    )


def item_stats(df: DataFrame, mode: str = "iso") -> DataFrame:
    """Popularity, age, trend and time profile per item (all event types).

    Rows are first reduced per (item, user), which spreads a hot item over many tasks and
    makes the distinct user count a plain count on the second level.
    """
    last = latest(df)
    age = last - F.col("timestamp")
    per_user = df.groupBy("item_id", "uid").agg(
        F.count(F.lit(1)).alias("plays"),
        F.max("track_length_seconds").alias("track_length_seconds"),
        F.min("timestamp").alias("first_ts"),
        F.count_if(age <= 5 * DAY).alias("p5"),
        F.count_if(age <= 30 * DAY).alias("p30"),
        *time_sums(F.col("timestamp"), mode),
    )
    return item_stats_of(per_user, last)


def item_stats_of(per_user: DataFrame, last: Column) -> DataFrame:
    """Item statistics from one row per item and user."""
    per_item = per_user.groupBy("item_id").agg(
        F.sum("plays").alias("item_total_plays"),
        F.count(F.lit(1)).alias("item_unique_users"),
        F.max("track_length_seconds").alias("track_length_seconds"),
        F.min("first_ts").alias("first_ts"),
        F.sum("p5").alias("item_plays_last_5d"),
        F.sum("p30").alias("item_plays_last_30d"),
        *add_up(TIME_SUM_NAMES),
    )
    return per_item.select(
        "item_id",
        "item_total_plays",
        "item_unique_users",
        "track_length_seconds",
        "first_ts",
        "item_plays_last_5d",
        "item_plays_last_30d",
        ((last - F.col("first_ts")) / DAY).alias("item_age_days"),
        (F.col("item_plays_last_5d") / F.greatest("item_plays_last_30d", F.lit(1))).alias(
            "item_trend"
        ),
        F.col("item_plays_last_5d").alias("item_recent_popularity"),
        *time_shares("item_total_plays", "item_"),
    )


def pair_profile(df: DataFrame, meta: DataFrame) -> DataFrame:
    """Signals per (uid, item_id) plus the user's listens of the item's artist and album.

    Raw rows are reduced to pairs before anything is joined. Both artist and album sums run
    on one partitioning by user, where a user has at most one row per catalogue item. An item
    that the metadata repeats belongs to the smallest artist and the smallest album of its rows.
    """
    heard = F.col("event_type") == LISTEN
    listens = F.count_if(heard)
    pairs = (
        df.where(F.col("event_type").isin(LISTEN, LIKE, DISLIKE))
        .groupBy("uid", "item_id")
        .agg(
            F.when(listens > 0, listens).alias("listen_count"),
            F.max(F.when(heard, F.col("played_ratio_pct"))).alias("played_ratio_max"),
            F.max(F.when(heard, F.col("timestamp"))).alias("last_listen_ts"),
            flag(DISLIKE).alias("dislike_flag"),
            flag(LIKE).alias("like_flag"),
        )
    )
    return pair_profile_of(pairs, meta, latest(df))


def pair_profile_of(pairs: DataFrame, meta: DataFrame, last: Column) -> DataFrame:
    """The profile from the signals of one row per pair."""
    pairs = pairs.withColumn(
        "ui_days_since_last_play",
        F.coalesce((last - F.col("last_listen_ts")) / DAY, F.lit(float(NEVER_PLAYED))),
    )
    owners = meta.groupBy("item_id").agg(
        F.min("artist_id").alias("artist_id"), F.min("album_id").alias("album_id")
    )
    tagged = pairs.join(owners, "item_id", "left").repartition("uid")

    def listens_of(owner: str) -> Column:
        total = F.sum("listen_count").over(Window.partitionBy("uid", owner))
        return F.when(F.col(owner).isNotNull(), F.coalesce(total, F.lit(0)))

    counted = tagged.withColumn("artist_listen_count", listens_of("artist_id")).withColumn(
        "album_listen_count", listens_of("album_id")
    )
    return counted.select("uid", *[c for c in counted.columns if c != "uid"])
