"""Offline quality of recommendation lists.

``recs`` is (uid, item_id, rank) with ranks from 1, ``truth`` is (uid, item_id). Only users
with truth and a non-empty list are scored, as in a per-user evaluation loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from songweave.functions.vectors import dot
from songweave.session import cut_lineage

METRICS = ["recall", "ndcg", "coverage", "cos_sim"]

# Published scores at k = 10, in percent, in the order of METRICS.
# The first row is the best public baseline per metric on the same data set; it states no cos_sim.
PUBLISHED_AT_10 = {
    "Baseline": (3.700, 7.810, 2.570, None),
    "MostPopular": (1.530, 2.600, 0.000, 46.070),
    "NewItemsLastNDays": (0.660, 1.520, 0.000, 45.850),
    "ALS": (1.890, 4.140, 0.180, 61.280),
    "BM25": (3.360, 6.330, 9.460, 64.190),
    "ItemKNN": (4.307, 8.100, 2.620, 63.060),
    "BPR": (0.960, 2.430, 4.460, 64.350),
    "RandomWalkWithRestart": (5.600, 10.580, 5.650, 64.460),
    "KMeansEmbedding": (2.660, 4.350, 6.520, 69.226),
    "HybridModel": (9.858, 16.500, 6.759, 68.236),
}


def true_pairs(truth: DataFrame) -> DataFrame:
    return truth.select("uid", "item_id").distinct()


def top_k(recs: DataFrame, k: int) -> DataFrame:
    return recs.where(F.col("rank") <= k).select("uid", "item_id", "rank")


def ideal_dcg(n_true: Column, k: int) -> Column:
    places = F.sequence(F.lit(1), F.least(n_true.cast("int"), F.lit(k)))
    return F.aggregate(places, F.lit(0.0), lambda acc, i: acc + 1.0 / F.log2(i + 1.0))


def user_metrics(recs: DataFrame, truth: DataFrame, k: int = 10) -> DataFrame:
    """Precision, recall and nDCG at ``k`` per evaluated user."""
    pairs = true_pairs(truth)
    sizes = pairs.groupBy("uid").agg(F.count(F.lit(1)).alias("n_true"))
    marked = top_k(recs, k).join(pairs.withColumn("_hit", F.lit(1)), ["uid", "item_id"], "left")
    gain = F.when(F.col("_hit") == 1, 1.0 / F.log2(F.col("rank") + 1.0)).otherwise(0.0)
    hits = marked.groupBy("uid").agg(
        F.count(F.lit(1)).alias("n_rec"),
        F.count("_hit").alias("hits"),
        F.sum(gain).alias("dcg"),
    )
    return hits.join(sizes, "uid").select(
        "uid",
        "n_rec",
        "n_true",
        "hits",
        (F.col("hits") / F.col("n_rec")).alias("precision"),
        (F.col("hits") / F.col("n_true")).alias("recall"),
        (F.col("dcg") / ideal_dcg(F.col("n_true"), k)).alias("ndcg"),
    )


def precision_at_k(recs: DataFrame, truth: DataFrame, k: int = 10) -> DataFrame:
    return user_metrics(recs, truth, k).select("uid", "precision")


def recall_at_k(recs: DataFrame, truth: DataFrame, k: int = 10) -> DataFrame:
    return user_metrics(recs, truth, k).select("uid", "recall")


def ndcg_at_k(recs: DataFrame, truth: DataFrame, k: int = 10) -> DataFrame:
    return user_metrics(recs, truth, k).select("uid", "ndcg")


def coverage_at_k(recs: DataFrame, truth: DataFrame, train: DataFrame, k: int = 10) -> DataFrame:
    """Share of the train catalogue that evaluated users get recommended."""
    users = truth.select("uid").distinct()
    shown = top_k(recs, k).join(users, "uid", "left_semi").select("item_id").distinct()
    catalogue = train.select("item_id").distinct()
    marked = catalogue.join(shown.withColumn("_shown", F.lit(1)), "item_id", "left")
    share = F.try_divide(F.count("_shown"), F.count(F.lit(1)))
    return marked.agg(F.coalesce(share, F.lit(0.0)).alias("coverage"))


def cosine_similarity_at_k(
    recs: DataFrame,
    truth: DataFrame,
    embeddings: DataFrame,
    k: int = 10,
    vector: str = "normalized_embed",
) -> DataFrame:
    """Mean over the list of the best cosine to any true item; no vector counts as 0.

    Cosines stream from the join into the map-side maximum: no pair is shuffled and no task
    collects a user's items.
    """
    vectors = embeddings.select("item_id", vector)
    pairs = true_pairs(truth)
    listed = top_k(recs, k).join(pairs.select("uid").distinct(), "uid", "left_semi")
    rec_vectors = listed.join(vectors, "item_id").select(
        "uid", F.col("item_id").alias("rec_id"), F.col(vector).alias("_rec")
    )
    true_vectors = pairs.join(vectors, "item_id")
    best = true_vectors.join(rec_vectors, "uid").groupBy("uid", F.col("rec_id").alias("item_id")).agg(
        F.max(dot(F.col("_rec"), F.col(vector))).alias("_best")
    )
    scored = listed.join(best, ["uid", "item_id"], "left")
    return scored.groupBy("uid").agg(F.avg(F.coalesce("_best", F.lit(0.0))).alias("cos_sim"))


def evaluate_model(
    recs: DataFrame,
    truth: DataFrame,
    train: DataFrame,
    embeddings: DataFrame,
    k: int = 10,
) -> DataFrame:
    """One row: users scored and skipped, and the four mean metrics.

    The true pairs and the first ``k`` of each list are stored first, so that each table is read
    once, whatever plan it stands for.
    """
    truth, recs = cut_lineage(true_pairs(truth)), cut_lineage(top_k(recs, k))
    users = truth.agg(F.countDistinct("uid")).scalar()
    per_user = user_metrics(recs, truth, k).join(
        cosine_similarity_at_k(recs, truth, embeddings, k), "uid"
    )
    scored = F.count(F.lit(1))
    return per_user.agg(
        scored.alias("users_scored"),
        *[
            F.coalesce(F.avg(m), F.lit(0.0)).alias(m)
            for m in ("precision", "recall", "ndcg", "cos_sim")
        ],
    ).select(
        "users_scored",
        (users - F.col("users_scored")).alias("users_skipped"),
        "precision",
        "recall",
        "ndcg",
        coverage_at_k(recs, truth, train, k).scalar().alias("coverage"),
        "cos_sim",
    )


def evaluate_many(
    lists: DataFrame,
    truth: DataFrame,
    train: DataFrame,
    embeddings: DataFrame,
    ks: tuple[int, ...] = (10, 100),
    vector: str = "normalized_embed",
) -> DataFrame:
    """``evaluate_model`` of many models at many lengths at once: a row per (model, k).

    ``lists`` is (model, uid, item_id, rank). Every metric of every model and length comes from
    one pass over the lists; the cosines of a user's items are computed once, whichever models
    listed them. A model is in the result if it lists anything for an evaluated user.
    """
    pairs = cut_lineage(true_pairs(truth))
    users = pairs.agg(F.countDistinct("uid")).scalar()
    sizes = pairs.groupBy("uid").agg(F.count(F.lit(1)).alias("n_true"))
    listed = lists.where(F.col("rank") <= max(ks)).select("model", "uid", "item_id", "rank")
    listed = listed.join(sizes, "uid")
    vectors = embeddings.select("item_id", vector)
    shown = listed.select("uid", "item_id").distinct().join(vectors, "item_id").select(
        "uid", F.col("item_id").alias("rec_id"), F.col(vector).alias("_rec")
    )
    best = pairs.join(vectors, "item_id").join(shown, "uid").groupBy(
        "uid", F.col("rec_id").alias("item_id")
    ).agg(F.max(dot(F.col("_rec"), F.col(vector))).alias("_best"))
    marked = listed.join(pairs.withColumn("_hit", F.lit(1)), ["uid", "item_id"], "left").join(
        best, ["uid", "item_id"], "left"
    )

    def at(k: int) -> Column:
        within = F.col("rank") <= k
        hit = within & F.col("_hit").isNotNull()
        n = F.count_if(within)
        found = {
            "precision": F.try_divide(F.count_if(hit), n),
            "recall": F.try_divide(F.count_if(hit), F.first("n_true")),
            "ndcg": F.sum(F.when(hit, 1.0 / F.log2(F.col("rank") + 1.0)).otherwise(0.0))
            / ideal_dcg(F.first("n_true"), k),
            "cos_sim": F.try_divide(F.sum(F.when(within, F.coalesce("_best", F.lit(0.0)))), n),
        }
        named = [c.alias(name) for name, c in found.items()]
        return F.struct(F.lit(k).alias("k"), (n > 0).alias("any"), *named)

    per_user = marked.groupBy("model", "uid").agg(F.array(*map(at, ks)).alias("at"))
    means = (
        per_user.select("model", F.inline("at"))
        .where("any")
        .groupBy("model", "k")
        .agg(
            F.count(F.lit(1)).alias("users_scored"),
            *[F.avg(m).alias(m) for m in ("precision", "recall", "ndcg", "cos_sim")],
        )
    )
    catalogue = train.select("item_id").distinct()
    total = catalogue.agg(F.count(F.lit(1))).scalar()
    firsts = listed.groupBy("model", "item_id").agg(F.min("rank").alias("rank"))
    known = firsts.join(catalogue, "item_id", "left_semi")
    share = [F.struct(F.lit(k).alias("k"), F.count_if(F.col("rank") <= k).alias("items")) for k in ks]
    covered = known.groupBy("model").agg(F.array(*share).alias("at")).select("model", F.inline("at"))
    return means.join(covered, ["model", "k"], "left").select(
        "model",
        "k",
        "users_scored",
        (users - F.col("users_scored")).alias("users_skipped"),
        "precision",
        "recall",
        "ndcg",
        F.coalesce(F.try_divide("items", total), F.lit(0.0)).alias("coverage"),
        "cos_sim",
    )


def published_scores(spark: SparkSession) -> DataFrame:
    """PUBLISHED_AT_10 as (model, metric, published) rows."""
    rows = [
        (model, metric, value)
        for model, values in PUBLISHED_AT_10.items()
        for metric, value in zip(METRICS, values)
    ]
    return spark.createDataFrame(rows, "model string, metric string, published double")


def compare_to_baseline(metrics: DataFrame, model: str, baseline: str = "Baseline") -> DataFrame:
    """Measured metrics in percent next to the published baseline and model scores."""
    spark = metrics.sparkSession
    published = published_scores(spark)
    measured = metrics.select(*METRICS).unpivot([], METRICS, "metric", "value").select(
        F.lit(model).alias("model"), "metric", (F.col("value") * 100).alias("measured")
    )
    base = published.where(F.col("model") == baseline).select(
        "metric", F.col("published").alias("baseline")
    )
    own = published.where(F.col("model") == model).select("metric", "published")
    return (
        measured.join(F.broadcast(base), "metric")
        .join(F.broadcast(own), "metric", "left")
        .withColumn("above_baseline", (F.col("measured") > F.col("baseline")).cast("int"))
    )
