"""Learning to rank candidates, and the final list."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from songweave.functions.columns import top_per_key, unit_hash
from songweave.operators.cleaning import hash_sample
from songweave.operators.interactions import ranking_target
from songweave.operators.postprocess import diversify, drop_recently_played, epsilon_greedy_topk
from songweave.plans.candidates import (
    ITEM_FEATURES,
    PAIR_FEATURES,
    USER_FEATURES,
    describe_candidates,
)
from songweave.session import cut_lineage

UNITS = {"row": ("uid", "item_id"), "user": ("uid",)}


def ranking_dataset(
    candidates: DataFrame,
    train: DataFrame,
    meta: DataFrame,
    fraction: float = 0.3,
    seed: int = 42,
    unit: str = "row",
    feature_mode: str = "pairs",
    features: DataFrame | None = None,
) -> DataFrame:
    """Sampled candidates with features and the label ``weights`` (0 where not played);
    ``features`` as in ``describe_candidates``."""
    sampled = hash_sample(candidates, fraction, seed, UNITS[unit])
    labelled = sampled.join(ranking_target(train), ["uid", "item_id"], "left")
    return describe_candidates(labelled, train, meta, feature_mode, features)


def rankable_users(dataset: DataFrame) -> DataFrame:
    """Rows of users whose labels differ; others have nothing to rank.

    A user has as many rows as the candidate limits allow.
    """
    user = Window.partitionBy("uid")
    label = F.coalesce("weights", F.lit(0.0))
    mixed = F.min(label).over(user) < F.max(label).over(user)
    return dataset.withColumn("weights", label).withColumn("_mixed", mixed).where("_mixed").drop(
        "_mixed"
    )


def ranker_split(
    dataset: DataFrame, test_size: float = 0.2, seed: int = 42, unit: str = "row"
) -> DataFrame:
    """Rows with ``fold`` train or valid, by hash of the row or of the user."""
    fold = F.when(unit_hash(seed + 1, *UNITS[unit]) < test_size, "valid").otherwise("train")
    return dataset.withColumn("fold", fold)


class Ranker:
    """Gradient-boosted trees on the log play count of candidates, ranked per user."""

    def __init__(self, features: list[str], max_iter: int = 20, depth: int = 6,
                 learning_rate: float = 0.1, test_size: float = 0.2, seed: int = 42,
                 unit: str = "row"):
        self.features = features
        self.max_iter = max_iter
        self.depth = depth
        self.learning_rate = learning_rate
        self.test_size = test_size
        self.seed = seed
        self.unit = unit
        self.fitted: PipelineModel | None = None
        self.valid_rmse: float | None = None

    def fit(self, dataset: DataFrame) -> Ranker:
        rows = rankable_users(dataset)
        folds = cut_lineage(ranker_split(rows, self.test_size, self.seed, self.unit))
        trees = GBTRegressor(
            featuresCol="features",
            labelCol="weights",
            predictionCol="score",
            maxIter=self.max_iter,
            maxDepth=self.depth,
            stepSize=self.learning_rate,
            seed=self.seed,
        )
        assembler = VectorAssembler(inputCols=self.features, outputCol="features")
        self.fitted = Pipeline(stages=[assembler, trees]).fit(folds.where("fold = 'train'"))
        scored = self.fitted.transform(folds.where("fold = 'valid'"))
        judge = RegressionEvaluator(labelCol="weights", predictionCol="score")
        self.valid_rmse = judge.evaluate(scored)
        return self

    def predict(self, candidates: DataFrame) -> DataFrame:
        """(uid, item_id, score, rank) for described candidates."""
        scored = self.fitted.transform(candidates).select("uid", "item_id", "score")
        return top_per_key(scored, "uid", "score", None)

    def save(self, path: str) -> None:
        self.fitted.write().overwrite().save(path)

    @classmethod
    def load(cls, path: str) -> Ranker:
        fitted = PipelineModel.load(path)
        ranker = cls(fitted.stages[0].getInputCols())
        ranker.fitted = fitted
        return ranker


def all_features(model_names: list[str]) -> list[str]:
    return [
        *USER_FEATURES, *ITEM_FEATURES, *PAIR_FEATURES, *(f"score_{n}" for n in model_names)
    ]


def final_list(
    scored: DataFrame,
    train: DataFrame,
    meta: DataFrame,
    filter_candidates: bool = True,
    use_diversifier: bool = True,
    use_e_greedy: bool = True,
    max_per_artist: int = 1,
    max_per_album: int = 1,
    k: int = 10,
    exploration_rate: float = 0.2,
    seed: int = 42,
) -> DataFrame:
    """Scored candidates to the list that is shown; every step can be switched off."""
    rows = scored.select("uid", "item_id", "score")
    if filter_candidates:
        rows = drop_recently_played(rows, train)
    if use_diversifier:
        rows = diversify(rows, meta, max_per_artist, max_per_album)
    if use_e_greedy:
        return epsilon_greedy_topk(rows, k, exploration_rate, seed).select(
            "uid", "item_id", "score", "rank"
        )
    return top_per_key(rows.select("uid", "item_id", "score"), "uid", "score", None)
