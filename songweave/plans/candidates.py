"""Candidates of all models for all users, and the features that describe them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from songweave.models.base import RetrievalModel
from songweave.operators.reductions import Reductions, reduce_log

# How many candidates each model contributes.
CANDIDATE_LIMITS = {
    "MostPopular": 50,
    "NewItemsLastNDays": 50,
    "LastListenRecommender": 0,
    "ALS": 200,
    "BM25": 200,
    "ItemKNN": 200,
    "BPR": 0,
    "RandomWalkWithRestart": 100,
    "KMeansEmbedding": 100,
}

# Feature columns the ranker sees.
ITEM_FEATURES = [
    "item_plays_last_5d",
    "item_plays_last_30d",
    "item_age_days",
    "item_trend",
    "item_plays_for_time_profile",
    "item_morning_share",
    "item_day_share",
    "item_evening_share",
    "item_night_share",
    "item_weekday_share",
    "item_weekend_share",
    "item_avg_listen_hour",
    "item_avg_listen_weekday",
]
USER_FEATURES = [
    "user_total_plays",
    "user_active_days",
    "user_unique_tracks",
    "median_daily_plays",
    "unique_tracks_share",
    "days_since_last_play",
    "user_plays_for_time_profile",
    "morning_share",
    "day_share",
    "evening_share",
    "night_share",
    "weekday_share",
    "weekend_share",
    "avg_listen_hour",
    "avg_listen_weekday",
]
PAIR_FEATURES = ["ui_days_since_last_play", "artist_listen_count", "album_listen_count"]


def candidates_long(models: dict[RetrievalModel, int], users: DataFrame) -> DataFrame:
    """(uid, item_id, model, score, rank): each model's first ``limit`` items per user."""
    wanted = users.select("uid").distinct()
    parts = [
        model.recommend(wanted, limit).select(
            "uid",
            "item_id",
            F.lit(model.name).alias("model"),
            F.col("score").cast("double").alias("score"),
            F.col("rank").cast("int").alias("rank"),
        )
        for model, limit in models.items()
        if limit > 0
    ]
    return reduce(DataFrame.unionByName, parts)


def candidates_wide(long: DataFrame, names: list[str]) -> DataFrame:
    """One row per (uid, item_id) with ``score_<model>``, 0 where a model did not propose it.

    Hardly a (uid, item_id) repeats within a task, so rows travel as they are, once."""

    def best(name: str) -> Column:
        return F.max(F.when(F.col("model") == name, F.col("score")))

    scores = [F.coalesce(best(n), F.lit(0.0)).alias(f"score_{n}") for n in names]
    return long.repartition("uid").groupBy("uid", "item_id").agg(*scores)


def feature_parts(
    reduced: Reductions, meta: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The features of pairs, of items and of users."""
    return (
        reduced.pair_profile(meta).select("uid", "item_id", *PAIR_FEATURES),
        reduced.item_stats().select("item_id", *ITEM_FEATURES),
        reduced.user_music_stats().select("uid", *USER_FEATURES),
    )


def feature_table(train: DataFrame, meta: DataFrame) -> DataFrame:
    """Pair, item and user features of every pair with history, from two passes over the log."""
    return _with_item_and_user(*feature_parts(reduce_log(train), meta))


def _with_item_and_user(pairs: DataFrame, items: DataFrame, users: DataFrame) -> DataFrame:
    return pairs.join(items, "item_id", "left").join(users, "uid", "left")


def describe_candidates(
    candidates: DataFrame,
    train: DataFrame,
    meta: DataFrame,
    feature_mode: str = "pairs",
    features: DataFrame | None = None,
) -> DataFrame:
    """Candidates with features, nulls as 0.

    ``pairs``: features come from pairs with history, so an unheard candidate gets 0 for all
    of them. ``separate``: item and user features are looked up by their own key.

    ``features``: the ``feature_table`` of ``train`` and ``meta``, where several frames of candidates
    are described by one that is stored; for ``pairs`` only.
    """
    if feature_mode == "pairs":
        if features is None:
            features = feature_table(train, meta)
        joined = candidates.join(features, ["uid", "item_id"], "left")
    elif feature_mode == "separate":
        pairs, items, users = feature_parts(reduce_log(train), meta)
        joined = _with_item_and_user(
            candidates.join(pairs, ["uid", "item_id"], "left"), items, users
        )
    else:
        raise ValueError(f"unknown feature mode {feature_mode!r}")
    return joined.na.fill(0)
