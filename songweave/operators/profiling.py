"""Reports that describe a log, its catalogue and its embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from songweave.functions.columns import DAY, HOUR, LISTEN
from songweave.operators.cleaning import listen_events, organic_only
from songweave.operators.skew import hot_keys, salted_join


def event_type_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


def freq_of_freq(df: DataFrame, key: str, at_most: int | None = None) -> DataFrame:
    """How many keys occur exactly ``times`` times among listens."""
    counts = listen_events(df).where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("times")
    )
    result = counts.groupBy("times").agg(F.count(F.lit(1)).alias("keys"))
    return result if at_most is None else result.where(F.col("times") <= at_most)


def value_histogram(df: DataFrame, column: str) -> DataFrame:
    """Listens per distinct value of ``column``; unknown values are left out."""
    known = listen_events(df).where(F.col(column).isNotNull())
    return known.groupBy(column).agg(F.count(F.lit(1)).alias("listens"))


def replay_gap_hours(train: DataFrame, test: DataFrame) -> DataFrame:
    """Hours from the last organic train event to the first recommended test event of a pair."""
    pair = ["uid", "item_id"]
    last_train = organic_only(train).groupBy(*pair).agg(F.max("timestamp").alias("last_train_ts"))
    first_test = (
        organic_only(test, False).groupBy(*pair).agg(F.min("timestamp").alias("first_test_ts"))
    )
    gap = (F.col("first_test_ts") - F.col("last_train_ts")) / HOUR
    return first_test.join(last_train, pair, "left").withColumn("gap_hours", gap)


def duplicate_groups(embeddings: DataFrame, vector: str = "normalized_embed") -> DataFrame:
    """One row per vector stored under several ids: the vector, its smallest id, the copies."""
    groups = embeddings.where(F.col(vector).isNotNull()).groupBy(vector).agg(
        F.min("item_id").alias("canonical_id"), F.count(F.lit(1)).alias("copies")
    )
    return groups.where(F.col("copies") > 1)


def duplicate_embeddings(embeddings: DataFrame, vector: str = "normalized_embed") -> DataFrame:
    """Every item whose vector is stored more than once, with the group it belongs to.

    Groups come back as rows rather than lists, so one vector copied across a large part of
    the catalogue neither fills one task nor one row. Vectors are compared in full.
    """
    groups = duplicate_groups(embeddings, vector)
    hot = hot_keys(groups, [vector], "copies")
    members = embeddings.where(F.col(vector).isNotNull()).select("item_id", vector)
    return salted_join(members, groups, [vector], "inner", hot).select(
        "canonical_id", "item_id", "copies"
    )


def duplicate_share(embeddings: DataFrame, vector: str = "normalized_embed") -> DataFrame:
    """Items with a copied vector as a percentage of the catalogue."""
    copied = F.coalesce(duplicate_groups(embeddings, vector).agg(F.sum("copies")).scalar(), F.lit(0))
    return embeddings.agg(F.countDistinct("item_id").alias("items")).select(
        copied.alias("copied_items"),
        F.try_divide(100.0 * copied, F.col("items")).alias("copied_pct"),
    )


def canonical_item_map(embeddings: DataFrame, vector: str = "normalized_embed") -> DataFrame:
    """Item to the smallest id with the same vector, for items that are not it themselves."""
    copies = duplicate_embeddings(embeddings, vector)
    return copies.where(F.col("item_id") != F.col("canonical_id")).select(
        "item_id", "canonical_id"
    )


def remap_items(df: DataFrame, item_map: DataFrame) -> DataFrame:
    """Replace copied items by their canonical id."""
    joined = df.join(item_map, "item_id", "left")
    item = F.coalesce("canonical_id", "item_id").alias("item_id")
    return joined.select(*[item if c == "item_id" else F.col(c) for c in df.columns])


def artist_catalogue(meta: DataFrame) -> DataFrame:
    """Distinct items of each artist, one row per item (an artist's list has no bound)."""
    return meta.select("artist_id", "item_id").distinct()


def artist_cluster_purity(labelled: DataFrame, meta: DataFrame) -> DataFrame:
    """Artists whose tracks fall into more than one cluster."""
    tracks = labelled.join(meta.select("item_id", "artist_id"), "item_id").where(
        F.col("artist_id").isNotNull()
    )
    stats = tracks.groupBy("artist_id").agg(
        F.count("label").alias("total_tracks"), F.countDistinct("label").alias("n_clusters")
    )
    return stats.where(F.col("n_clusters") > 1)


def dataset_span(df: DataFrame) -> DataFrame:
    """Whole days between the first and the last event."""
    days = F.floor((F.max("timestamp") - F.min("timestamp")) / DAY)
    return df.agg(days.cast("long").alias("days"))


def embedding_usage(embeddings: DataFrame, df: DataFrame) -> DataFrame:
    """Items in the log as a percentage of stored vectors."""
    used = df.agg(F.countDistinct("item_id")).scalar()
    return embeddings.agg(F.count(F.lit(1)).alias("vectors")).select(
        "vectors",
        used.alias("items_in_log"),
        F.try_divide(100.0 * used, F.col("vectors")).alias("used_pct"),
    )


def event_timeline(
    df: DataFrame, uid: int | None = None, start: int = 900, stop: int = 1000
) -> DataFrame:
    """Listens ``start``..``stop`` in time order with seconds played and stack level.

    The slice is a top-``stop`` report; stacking then sees at most ``stop - start`` rows.
    """
    listens = df.where(F.col("event_type") == LISTEN)
    if uid is not None:
        listens = listens.where(F.col("uid") == uid)
    piece = listens.orderBy("timestamp", "seq").offset(start).limit(stop - start)
    stacked = Window.partitionBy("timestamp").orderBy("seq")
    return piece.select(
        "uid",
        "item_id",
        "timestamp",
        "seq",
        (F.col("track_length_seconds") * F.col("played_ratio_pct") * 0.01).alias("count_sec"),
        (F.row_number().over(stacked) - 1).alias("stack_level"),
    )


def last_items_of_top_user(df: DataFrame, n: int = 200) -> DataFrame:
    """The newest ``n`` events of the user with most events (smallest id on a tie)."""
    events = df.groupBy("uid").agg(F.count(F.lit(1)).alias("events"))
    top = events.orderBy(F.desc("events"), "uid").limit(1).select("uid").scalar()
    newest = df.where(F.col("uid") == top).orderBy(F.desc("timestamp"), F.desc("seq")).limit(n)
    return newest.select("uid", "item_id", "timestamp", "seq")
