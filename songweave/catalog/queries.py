"""One query per operator, each over whole tables.

Doubles are rounded to six places so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from songweave.functions import vectors as vec
from songweave.functions.columns import decay_per_second
from songweave.models.decay import LastListenRecommender
from songweave.models.hybrid import HybridModel, enabled_models
from songweave.models.matrix import (
    ALS,
    BM25,
    BPR,
    bm25_weights,
    id_maps,
    map_with_id_maps,
    similar_items,
)
from songweave.models.matrix import user_item_weights as matrix_weights
from songweave.models.overlap import ItemKNN, play_matrices
from songweave.models.overlap import user_overlap as overlap_matrix
from songweave.models.popular import MostPopular, NewItemsLastNDays
from songweave.models.stratified import StratifiedBPR
from songweave.models.taste import KMeansEmbedding, track_kmeans
from songweave.models.walk import RandomWalkWithRestart, readable, transition, walk_edges
from songweave.operators import cleaning, features, interactions, metrics, postprocess, profiling
from songweave.operators.buckets import cell_topk, lsh_topk
from songweave.operators.similarity import vector_topk
from songweave.operators.splits import time_split_with_gap, with_split
from songweave.plans import preprocessing
from songweave.plans.candidates import (
    CANDIDATE_LIMITS,
    ITEM_FEATURES,
    PAIR_FEATURES,
    USER_FEATURES,
    candidates_long,
    candidates_wide,
    describe_candidates,
    feature_table,
)
from songweave.plans.ranking import (
    Ranker,
    all_features,
    final_list,
    rankable_users,
    ranker_split,
    ranking_dataset,
)
from songweave.plans.rankers import (
    ListwiseRanker,
    PairwiseRanker,
    listwise_gradients,
    ranker_train_pairs,
)
from songweave.session import apply_settings, cut_lineage
from songweave.sources import fixtures, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The walk keeps pairs with more listens than this; the supplied log has at most 4 per pair.
WALK_LISTENS = 0
# "New" on the sparse log, which spans seven years.
NEW_DAYS = 2300
# Matrix models on the sparse log look at its whole span.
FULL_SPAN = 3650


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    def tidy(name: str, kind: str):
        if name in ("rank", "stack_level"):
            return F.col(name).cast("long")
        return F.round(name, digits).alias(name) if kind in ("double", "float") else F.col(name)

    return df.select(*[tidy(n, k) for n, k in df.dtypes])


def query(what: Query | str):
    """Register a query under its function's name, or under the name given."""
    if isinstance(what, str):
        return lambda fn: _register(what, fn)
    return _register(what.__name__, what)


def _register(name: str, fn: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return rounded(fn(apply_settings(spark), folder))

    QUERIES[name] = run
    return fn


def users_of(df: DataFrame) -> DataFrame:
    return df.select("uid").distinct()


def train_log(spark: SparkSession, folder: str) -> DataFrame:
    return time_split_with_gap(fixtures.interactions(spark, folder))[0]


def test_truth(spark: SparkSession, folder: str) -> DataFrame:
    return preprocessing.preprocess_test(fixtures.interactions(spark, folder))


def last_listen_recs(spark: SparkSession, folder: str, n: int = 200) -> DataFrame:
    train = train_log(spark, folder)
    return LastListenRecommender().fit(train).recommend(users_of(train), n)


# --- sources ---------------------------------------------------------------


@query
def scan_interactions(spark, folder):
    return fixtures.interactions(spark, folder)


@query
def concat_aligned(spark, folder):
    log = fixtures.interactions(spark, folder)
    meta = fixtures.items_meta(spark, folder)
    return tables.concat_aligned(log.select("item_id", "uid", "track_length_seconds"), meta)


@query
def embeddings_in_catalogue(spark, folder):
    found = tables.embeddings_in_catalogue(
        fixtures.embeddings(spark, folder), fixtures.purchases(spark, folder)
    )
    return found.select("item_id", "label")


@query
def embedding_table(spark, folder):
    table = tables.embedding_table(fixtures.embeddings(spark, folder))
    vector = F.col("normalized_embed")
    return table.select(
        "item_id",
        F.size(vector).alias("size"),
        vec.l2_norm(vector).alias("length"),
        vec.as_doubles(vector)[0].alias("first_value"),
    )


# --- cleaning --------------------------------------------------------------


@query
def listen_events(spark, folder):
    return cleaning.listen_events(fixtures.interactions(spark, folder))


@query
def reaction_events(spark, folder):
    return cleaning.reaction_events(fixtures.interactions(spark, folder))


@query
def dedup_keep_none(spark, folder):
    return cleaning.dedup_keep_none(cleaning.listen_events(fixtures.purchases(spark, folder)))


@query
def dedup_keep_none_hourly(spark, folder):
    log = fixtures.interactions(spark, folder)
    hourly = log.withColumn("timestamp", F.col("timestamp") - F.col("timestamp") % 3600)
    return cleaning.dedup_keep_none(cleaning.listen_events(hourly))


@query
def filter_rare_items(spark, folder):
    return cleaning.filter_rare_items(fixtures.purchases(spark, folder), 30)


@query
def filter_rare_users(spark, folder):
    return cleaning.filter_rare_users(fixtures.purchases(spark, folder), 40)


@query
def cut_track_length(spark, folder):
    return cleaning.cut_track_length(fixtures.interactions(spark, folder))


@query
def last_reaction(spark, folder):
    return cleaning.last_reaction(fixtures.interactions(spark, folder))


@query
def rename_events(spark, folder):
    return cleaning.rename_events(fixtures.interactions(spark, folder))


@query
def relevant_events(spark, folder):
    return cleaning.relevant_events(fixtures.interactions(spark, folder))


@query("time_split_with_gap")
def time_split(spark, folder):
    return with_split(fixtures.interactions(spark, folder))


@query
def time_split_with_wide_gap(spark, folder):
    return with_split(fixtures.purchases(spark, folder), test_days=30, gap_seconds=1800)


@query
def preprocess_train(spark, folder):
    return preprocessing.preprocess_train(fixtures.interactions(spark, folder))


@query
def preprocess_train_sparse(spark, folder):
    return preprocessing.preprocess_train(fixtures.purchases(spark, folder), test_days=30)


@query
def preprocess_test(spark, folder):
    return test_truth(spark, folder)


@query
def null_id_rows(spark, folder):
    counts = cleaning.null_id_rows(fixtures.interactions(spark, folder))
    return counts.agg(F.count(F.lit(1)).alias("null_rows"))


@query
def organic_split_counts(spark, folder):
    log = fixtures.interactions(spark, folder)
    return log.groupBy("is_organic").agg(F.count(F.lit(1)).alias("events"))


@query
def known_items_only(spark, folder):
    meta = cleaning.clean_items_meta(fixtures.items_meta(spark, folder))
    return cleaning.known_items_only(
        fixtures.purchases(spark, folder), meta, fixtures.embeddings(spark, folder)
    )


@query
def hash_sample(spark, folder):
    return cleaning.hash_sample(fixtures.interactions(spark, folder))


@query
def hash_sample_users(spark, folder):
    return cleaning.hash_sample(fixtures.interactions(spark, folder), keys=("uid",))


@query
def clean_items_meta(spark, folder):
    meta = fixtures.items_meta(spark, folder)
    # A second, different row per item, as in metadata that lists a track on two albums.
    again = meta.withColumn("album_id", F.col("album_id") + F.col("item_id") % 3 - 1)
    return cleaning.clean_items_meta(meta.unionByName(again))


# --- aggregates and features ----------------------------------------------


@query
def interaction_counts(spark, folder):
    return interactions.interaction_counts(fixtures.interactions(spark, folder))


@query
def pair_profile(spark, folder):
    meta = cleaning.clean_items_meta(fixtures.items_meta(spark, folder))
    return features.pair_profile(fixtures.interactions(spark, folder), meta)


@query
def pair_profile_null_owners(spark, folder):
    return features.pair_profile(
        fixtures.purchases(spark, folder), fixtures.items_meta(spark, folder)
    )


@query
def pair_profile_repeated_meta(spark, folder):
    meta = fixtures.items_meta(spark, folder)
    again = meta.withColumns(
        {"artist_id": F.col("artist_id") + 1000, "album_id": F.col("album_id") + 1000}
    )
    return features.pair_profile(fixtures.purchases(spark, folder), meta.unionByName(again))


@query
def item_time_profile(spark, folder):
    return features.item_time_profile(fixtures.interactions(spark, folder))


@query
def item_time_profile_documented(spark, folder):
    return features.item_time_profile(fixtures.purchases(spark, folder), mode="documented")


@query
def user_time_profile(spark, folder):
    return features.user_time_profile(fixtures.interactions(spark, folder))


@query
def user_music_stats(spark, folder):
    return features.user_music_stats(fixtures.interactions(spark, folder))


@query
def median_daily_plays(spark, folder):
    return features.median_daily_plays(fixtures.interactions(spark, folder))


@query
def item_stats(spark, folder):
    return features.item_stats(fixtures.interactions(spark, folder))


@query
def decayed_play_weight(spark, folder):
    return interactions.decayed_play_weight(
        fixtures.interactions(spark, folder), decay_per_second(0.9, 2)
    )


@query
def decayed_play_weight_last_only(spark, folder):
    return interactions.decayed_play_weight(
        fixtures.interactions(spark, folder), decay_per_second(0.9, 0)
    )


@query
def ranking_target(spark, folder):
    return interactions.ranking_target(fixtures.interactions(spark, folder))


@query
def confidence_weights(spark, folder):
    return interactions.confidence_weights(
        interactions.interaction_counts(fixtures.interactions(spark, folder))
    )


@query
def user_taste_history(spark, folder):
    return interactions.user_taste_history(fixtures.interactions(spark, folder))


# --- profiling -------------------------------------------------------------


@query
def event_type_counts(spark, folder):
    return profiling.event_type_counts(fixtures.interactions(spark, folder))


@query
def item_freq_of_freq(spark, folder):
    return profiling.freq_of_freq(fixtures.purchases(spark, folder), "item_id")


@query
def user_freq_of_freq(spark, folder):
    return profiling.freq_of_freq(fixtures.purchases(spark, folder), "uid", at_most=50)


@query
def track_length_histogram(spark, folder):
    return profiling.value_histogram(fixtures.purchases(spark, folder), "track_length_seconds")


@query
def played_ratio_histogram(spark, folder):
    return profiling.value_histogram(fixtures.purchases(spark, folder), "played_ratio_pct")


@query
def replay_gap_hours(spark, folder):
    train, test = time_split_with_gap(fixtures.interactions(spark, folder))
    return profiling.replay_gap_hours(train, test)


@query
def duplicate_embeddings(spark, folder):
    return profiling.duplicate_embeddings(fixtures.embeddings_with_copies(spark, folder))


@query
def duplicate_share(spark, folder):
    return profiling.duplicate_share(fixtures.embeddings_with_copies(spark, folder))


@query
def canonical_item_map(spark, folder):
    return profiling.canonical_item_map(fixtures.embeddings_with_copies(spark, folder))


@query
def remap_items(spark, folder):
    log = fixtures.interactions(spark, folder)
    # Recommended plays carry the id of the second upload where there is one.
    shifted = F.col("item_id") + F.when(F.col("is_organic") == 0, 1000000).otherwise(0)
    item_map = profiling.canonical_item_map(fixtures.embeddings_with_copies(spark, folder))
    return profiling.remap_items(log.withColumn("item_id", shifted), item_map)


@query
def artist_catalogue(spark, folder):
    return profiling.artist_catalogue(fixtures.items_meta(spark, folder))


@query
def artist_cluster_purity(spark, folder):
    return profiling.artist_cluster_purity(
        fixtures.embeddings(spark, folder), fixtures.items_meta(spark, folder)
    )


@query
def dataset_span(spark, folder):
    return profiling.dataset_span(fixtures.interactions(spark, folder))


@query
def embedding_usage(spark, folder):
    return profiling.embedding_usage(
        fixtures.embeddings(spark, folder), fixtures.interactions(spark, folder)
    )


@query
def event_timeline(spark, folder):
    return profiling.event_timeline(fixtures.interactions(spark, folder))


@query
def last_items_of_top_user(spark, folder):
    return profiling.last_items_of_top_user(fixtures.interactions(spark, folder))


# --- vectors ---------------------------------------------------------------


@query
def l2_normalize(spark, folder):
    emb = fixtures.embeddings(spark, folder)
    stretched = F.transform(
        vec.as_doubles(F.col("normalized_embed")), lambda x: x * (F.col("label") + 2)
    )
    unit = emb.select("item_id", vec.l2_normalize(stretched).alias("v"))
    return unit.select("item_id", F.posexplode("v").alias("pos", "value"))


@query
def mean_direction(spark, folder):
    return vec.mean_direction(fixtures.embeddings(spark, folder))


@query
def embedding_topk(spark, folder):
    emb = fixtures.embeddings(spark, folder)
    wanted = emb.select(F.col("item_id").alias("query_id"), "normalized_embed")
    return vector_topk(wanted, emb, 10, ["query_id"], query_vector="normalized_embed")


@query
def embedding_topk_cells(spark, folder):
    emb = fixtures.embeddings(spark, folder)
    wanted = emb.select(F.col("item_id").alias("query_id"), "normalized_embed")
    return cell_topk(wanted, emb, 10, ["query_id"], query_vector="normalized_embed")


@query
def embedding_topk_lsh(spark, folder):
    emb = fixtures.embeddings(spark, folder)
    wanted = emb.select(F.col("item_id").alias("query_id"), "normalized_embed")
    return lsh_topk(wanted, emb, 10, ["query_id"], query_vector="normalized_embed")


# --- models ----------------------------------------------------------------


@query
def most_popular(spark, folder):
    log = fixtures.interactions(spark, folder)
    return MostPopular().fit(log).recommend(users_of(log), CANDIDATE_LIMITS["MostPopular"])


@query
def new_items(spark, folder):
    log = fixtures.purchases(spark, folder)
    model = NewItemsLastNDays(last_days=NEW_DAYS).fit(log)
    return model.recommend(users_of(log), CANDIDATE_LIMITS["NewItemsLastNDays"])


@query
def last_listen(spark, folder):
    log = fixtures.interactions(spark, folder)
    return LastListenRecommender().fit(log).recommend(users_of(log))


@query
def user_item_weights(spark, folder):
    return matrix_weights(fixtures.interactions(spark, folder))


@query
def user_item_weights_float(spark, folder):
    return matrix_weights(fixtures.purchases(spark, folder), "float", FULL_SPAN)


@query
def user_id_map(spark, folder):
    return id_maps(fixtures.purchases(spark, folder))[0]


@query("id_maps")
def id_map_items(spark, folder):
    return id_maps(fixtures.purchases(spark, folder))[1]


@query
def mapped_interactions(spark, folder):
    log = fixtures.interactions(spark, folder).select("seq", "uid", "item_id", "event_type")
    known = log.where("item_id % 7 <> 0")  # items that the maps don't know become null
    return map_with_id_maps(log, *id_maps(known))


@query
def als_recommend(spark, folder):
    log = fixtures.purchases(spark, folder)
    model = ALS(weight_mode="float", last_days=FULL_SPAN).fit(log)
    return model.recommend(users_of(log), CANDIDATE_LIMITS["ALS"])


@query
def bm25_similar_items(spark, folder):
    weights = cut_lineage(matrix_weights(fixtures.purchases(spark, folder), "float", FULL_SPAN))
    return similar_items(bm25_weights(weights))


@query
def bm25_recommend(spark, folder):
    log = fixtures.purchases(spark, folder)
    model = BM25(weight_mode="float", last_days=FULL_SPAN).fit(log)
    return model.recommend(users_of(log), CANDIDATE_LIMITS["BM25"])


@query
def bm25_recommend_truncated(spark, folder):
    log = fixtures.interactions(spark, folder)
    return BM25().fit(log).recommend(users_of(log), CANDIDATE_LIMITS["BM25"])


@query
def bpr_stratified_recommend(spark, folder):
    log = fixtures.purchases(spark, folder)
    model = StratifiedBPR(weight_mode="float", last_days=FULL_SPAN, iterations=5).fit(log)
    return model.recommend(users_of(log), 200)


@query
def bpr_recommend(spark, folder):
    log = fixtures.purchases(spark, folder)
    model = BPR(weight_mode="float", last_days=FULL_SPAN).fit(log)
    return model.recommend(users_of(log), CANDIDATE_LIMITS["ALS"])


@query
def user_overlap(spark, folder):
    return overlap_matrix(*play_matrices(fixtures.purchases(spark, folder)))


@query
def item_knn(spark, folder):
    log = fixtures.purchases(spark, folder)
    return ItemKNN().fit(log).recommend(users_of(log), CANDIDATE_LIMITS["ItemKNN"])


@query
def item_knn_float(spark, folder):
    log = fixtures.interactions(spark, folder)
    model = ItemKNN(weight_mode="float").fit(log)
    return model.recommend(users_of(log), CANDIDATE_LIMITS["ItemKNN"])


def _edges(spark, folder):
    return walk_edges(
        fixtures.interactions(spark, folder),
        fixtures.items_meta(spark, folder),
        listen_count_limit=WALK_LISTENS,
    )


@query
def rwr_edges(spark, folder):
    return readable(_edges(spark, folder), "w")


@query
def rwr_transition(spark, folder):
    return readable(transition(_edges(spark, folder)), "p")


def _walk(spark, folder, log, **options):
    meta = fixtures.items_meta(spark, folder)
    return RandomWalkWithRestart(meta, listen_count_limit=WALK_LISTENS, **options).fit(log)


@query
def rwr_recommend(spark, folder):
    log = fixtures.interactions(spark, folder)
    model = _walk(spark, folder, log)
    return model.recommend(users_of(log), CANDIDATE_LIMITS["RandomWalkWithRestart"])


@query
def rwr_recommend_four_steps(spark, folder):
    log = fixtures.interactions(spark, folder)
    model = _walk(spark, folder, log, max_iter=4)
    return model.recommend(users_of(log), CANDIDATE_LIMITS["RandomWalkWithRestart"])


@query
def user_taste_clusters(spark, folder):
    model = KMeansEmbedding(fixtures.embeddings(spark, folder))
    centers = model.fit(fixtures.interactions(spark, folder)).state["centers"]
    return centers.select("uid", "cluster", "tracks", F.posexplode("vector").alias("pos", "value"))


@query
def taste_cluster_recommend(spark, folder):
    log = fixtures.interactions(spark, folder)
    model = KMeansEmbedding(fixtures.embeddings(spark, folder)).fit(log)
    return model.recommend(users_of(log), CANDIDATE_LIMITS["KMeansEmbedding"])


@query("track_kmeans")
def track_clusters(spark, folder):
    return track_kmeans(fixtures.embeddings(spark, folder))


# --- candidates, ranking, final list ---------------------------------------

CANDIDATE_NAMES = ["MostPopular", "LastListenRecommender", "ItemKNN", "RandomWalkWithRestart"]


@query("candidates_long")
def _candidates(spark, folder):
    train = train_log(spark, folder)
    models = {
        MostPopular().fit(train): 50,
        LastListenRecommender().fit(train): 200,
        ItemKNN().fit(train): 200,
        _walk(spark, folder, train): 100,
    }
    return candidates_long(models, train)


@query("candidates_wide")
def _wide(spark, folder):
    return candidates_wide(_candidates(spark, folder), CANDIDATE_NAMES)


def _meta(spark, folder):
    return cleaning.clean_items_meta(fixtures.items_meta(spark, folder))


@query("feature_table")
def features_of_pairs(spark, folder):
    return feature_table(train_log(spark, folder), _meta(spark, folder))


@query
def candidate_features_separate(spark, folder):
    described = describe_candidates(
        last_listen_recs(spark, folder).select("uid", "item_id", "score"),
        train_log(spark, folder),
        _meta(spark, folder),
        "separate",
    )
    return described.select(
        "uid", "item_id", "score", "ui_days_since_last_play", "item_plays_last_30d",
        "user_total_plays",
    )


def _dataset(spark, folder, unit="row"):
    recs = last_listen_recs(spark, folder).select("uid", "item_id", "score")
    return ranking_dataset(recs, train_log(spark, folder), _meta(spark, folder), unit=unit)


@query("ranking_dataset")
def dataset_of_ranker(spark, folder):
    return _dataset(spark, folder)


@query
def ranking_dataset_users(spark, folder):
    return _dataset(spark, folder, "user").select("uid", "item_id", "score", "weights")


@query("rankable_users")
def users_to_rank(spark, folder):
    return rankable_users(_dataset(spark, folder)).select("uid", "item_id", "weights")


@query("ranker_split")
def folds_of_ranker(spark, folder):
    split = ranker_split(rankable_users(_dataset(spark, folder)))
    return split.select("uid", "item_id", "weights", "fold")


PAIR_COLUMNS = ["score", *PAIR_FEATURES, "item_plays_last_30d"]


@query("ranker_train_pairs")
def pairs_of_ranker(spark, folder):
    rows = rounded(rankable_users(_dataset(spark, folder)))
    return ranker_train_pairs(rows, PAIR_COLUMNS)


@query
def ranker_listwise_gradients(spark, folder):
    rows = rounded(rankable_users(_dataset(spark, folder)))
    return listwise_gradients(rows).select("uid", "item_id", "gradient")


@query
def ranker_pairwise_scores(spark, folder):
    rows = cut_lineage(_dataset(spark, folder))
    ranker = PairwiseRanker(["score", *ITEM_FEATURES, *PAIR_FEATURES]).fit(rows)
    return ranker.predict(rows)


@query
def ranker_listwise_scores(spark, folder):
    rows = cut_lineage(_dataset(spark, folder).withColumnRenamed("score", "score_LastListen"))
    named = ["score_LastListen", *USER_FEATURES, *ITEM_FEATURES, *PAIR_FEATURES]
    return ListwiseRanker(named, rounds=5).fit(rows).predict(rows)


def _hybrid(spark, folder, train, **options):
    vectors = {"embeddings": fixtures.embeddings(spark, folder)}
    walk = {"meta": fixtures.items_meta(spark, folder), "listen_count_limit": WALK_LISTENS}
    models = enabled_models(KMeansEmbedding=vectors, RandomWalkWithRestart=walk)
    return HybridModel(models, **options).fit(train, _meta(spark, folder))


@query
def hybrid_recommend(spark, folder):
    train = cut_lineage(train_log(spark, folder))
    return _hybrid(spark, folder, train).recommend(users_of(train))


@query
def hybrid_list_facts(spark, folder):
    train, meta = cut_lineage(train_log(spark, folder)), _meta(spark, folder)
    lists = cut_lineage(_hybrid(spark, folder, train).recommend(users_of(train)))
    owned = lists.join(meta, "item_id", "left")

    def repeated(owner: str) -> DataFrame:
        known = owned.where(F.col(owner).isNotNull())
        return known.groupBy("uid", owner).count().where("count > 1").agg(F.count(F.lit(1)))

    recent = lists.join(postprocess.recently_played(train), ["uid", "item_id"])
    facts = lists.agg(
        F.countDistinct("uid").alias("users"),
        (F.max("rank") <= 10).alias("short"),
        (F.count(F.lit(1)) == F.countDistinct("uid", "item_id")).alias("distinct"),
    )
    return facts.select(
        "*",
        repeated("artist_id").scalar().alias("repeated_artists"),
        repeated("album_id").scalar().alias("repeated_albums"),
        recent.agg(F.count(F.lit(1))).scalar().alias("recently_played"),
    )


@query
def ranker_scores(spark, folder):
    wide = cut_lineage(_wide(spark, folder))
    train, meta = cut_lineage(train_log(spark, folder)), _meta(spark, folder)
    # Made once for what is learnt from and what is ranked.
    features = cut_lineage(feature_table(train, meta))
    dataset = ranking_dataset(wide, train, meta, features=features)
    ranker = Ranker(all_features(CANDIDATE_NAMES)).fit(dataset)
    return ranker.predict(describe_candidates(wide, train, meta, features=features))


@query
def drop_recently_played(spark, folder):
    recs = last_listen_recs(spark, folder).select("uid", "item_id", "score")
    return postprocess.drop_recently_played(recs, train_log(spark, folder))


@query
def diversify_artist_album(spark, folder):
    recs = last_listen_recs(spark, folder)
    return postprocess.diversify(recs, fixtures.items_meta(spark, folder), 1, 1)


@query
def diversify_three_each(spark, folder):
    log = fixtures.purchases(spark, folder)
    recs = LastListenRecommender(hour=24 * 365).fit(log).recommend(users_of(log))
    return postprocess.diversify(recs, fixtures.items_meta(spark, folder))


@query
def epsilon_greedy_topk(spark, folder):
    return postprocess.epsilon_greedy_topk(last_listen_recs(spark, folder))


@query
def recommend_final(spark, folder):
    recs = last_listen_recs(spark, folder)
    return final_list(recs, train_log(spark, folder), fixtures.items_meta(spark, folder))


# --- evaluation ------------------------------------------------------------


def popular_recs(spark, folder, n=50):
    train = train_log(spark, folder)
    return MostPopular(last_days=30).fit(train).recommend(users_of(train), n)


@query
def precision_at_k(spark, folder):
    return metrics.precision_at_k(popular_recs(spark, folder), test_truth(spark, folder))


@query
def recall_at_k(spark, folder):
    return metrics.recall_at_k(popular_recs(spark, folder), test_truth(spark, folder))


@query
def ndcg_at_k(spark, folder):
    return metrics.ndcg_at_k(popular_recs(spark, folder), test_truth(spark, folder))


@query
def coverage_at_k(spark, folder):
    return metrics.coverage_at_k(
        popular_recs(spark, folder), test_truth(spark, folder), train_log(spark, folder)
    )


@query
def cosine_similarity_at_k(spark, folder):
    return metrics.cosine_similarity_at_k(
        popular_recs(spark, folder), test_truth(spark, folder), fixtures.embeddings(spark, folder)
    )


def _evaluate(spark, folder, truth):
    return metrics.evaluate_model(
        last_listen_recs(spark, folder),
        truth,
        train_log(spark, folder),
        fixtures.embeddings(spark, folder),
    )


@query
def evaluate_model(spark, folder):
    return _evaluate(spark, folder, test_truth(spark, folder))


@query
def evaluate_models(spark, folder):
    lists = {
        "MostPopular": popular_recs(spark, folder),
        "LastListenRecommender": last_listen_recs(spark, folder),
    }
    tagged = [recs.select(F.lit(name).alias("model"), "uid", "item_id", "rank") for name, recs in lists.items()]
    return metrics.evaluate_many(
        tagged[0].unionByName(tagged[1]),
        test_truth(spark, folder),
        train_log(spark, folder),
        fixtures.embeddings(spark, folder),
    )


@query
def evaluate_models_enabled(spark, folder):
    train = cut_lineage(train_log(spark, folder))
    vectors = fixtures.embeddings(spark, folder)
    walk = {"meta": fixtures.items_meta(spark, folder), "listen_count_limit": WALK_LISTENS}
    models = enabled_models(KMeansEmbedding={"embeddings": vectors}, RandomWalkWithRestart=walk)
    for model in models:
        model.fit(train)
    truth = test_truth(spark, folder)
    lists = candidates_long({model: 100 for model in models}, truth.select("uid"))
    return metrics.evaluate_many(cut_lineage(lists), truth, train, vectors)


@query
def evaluate_recommended_only(spark, folder):
    return _evaluate(spark, folder, cleaning.organic_only(test_truth(spark, folder), False))


@query
def compare_to_baseline(spark, folder):
    measured = metrics.evaluate_model(
        popular_recs(spark, folder),
        test_truth(spark, folder),
        train_log(spark, folder),
        fixtures.embeddings(spark, folder),
    )
    return metrics.compare_to_baseline(measured, "MostPopular")


# --- flagship --------------------------------------------------------------


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Clean, fit all models that contribute candidates and a ranker, and build every user's
    final list."""
    apply_settings(spark)
    log = fixtures.interactions(spark, folder)
    # The cleaned log is stored once; every model and step reads that table.
    train = cut_lineage(preprocessing.preprocess_train(log))
    return rounded(_hybrid(spark, folder, train).recommend(users_of(train)))
