"""A user's own items, most recently played first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from songweave.functions.columns import decay_per_second
from songweave.models.base import RetrievalModel, ranked
from songweave.operators.interactions import decayed_play_weight


class LastListenRecommender(RetrievalModel):
    name = "LastListenRecommender"

    def __init__(self, hour: float = 2, decay: float = 0.9):
        super().__init__(hour=hour, decay=decay)

    def fit(self, df: DataFrame) -> LastListenRecommender:
        weights = decayed_play_weight(df, decay_per_second(self.decay, self.hour))
        self.state = {
            "weights": weights.select("uid", "item_id", F.col("weights").alias("score"))
        }
        return self

    def recommend(self, users: DataFrame, n: int | None = None) -> DataFrame:
        own = self.state["weights"].join(users.select("uid").distinct(), "uid", "left_semi")
        return ranked(own, n)
