"""Row filters and normalisation of the interaction log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from songweave.functions.columns import LIKE, LISTEN, unit_hash
from songweave.operators.skew import hot_keys, salted_join
from songweave.session import cut_lineage

# Reaction names and what each counts as after normalisation.
REACTIONS = ["like", "unlike", "dislike", "undislike"]
EVENT_NAMES = {"unlike": "dislike", "undislike": "like"}


def listen_events(df: DataFrame) -> DataFrame:
    return df.where(F.col("event_type") == LISTEN)


def reaction_events(df: DataFrame) -> DataFrame:
    """Everything but listens; rows without a type are dropped too."""
    return df.where(F.col("event_type") != LISTEN)


def dedup_keep_none(
    df: DataFrame, keys: tuple[str, ...] = ("timestamp", "uid", "event_type")
) -> DataFrame:
    """Drop every row whose key occurs more than once (keep none of them).

    Copies collapse in the map-side aggregate. Only groups of one row survive, so any value
    of the other columns is the row itself.
    """
    others = [c for c in df.columns if c not in keys]
    once = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.any_value(c).alias(c) for c in others]
    )
    return once.where(F.col("_rows") == 1).select(*df.columns)


def filter_rare(df: DataFrame, key: str, min_rows: int) -> DataFrame:
    """Keep rows whose ``key`` occurs at least ``min_rows`` times.

    The counts also tell which keys are hot, so whole rows never pile up in one task. They are
    stored: each of their readers would go through ``df`` again.
    """
    counts = cut_lineage(df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")))
    kept = counts.where(F.col("_rows") >= min_rows).select(key)
    return salted_join(df, kept, [key], "left_semi", hot_keys(counts, [key], "_rows"))


def filter_rare_items(df: DataFrame, min_listens: int = 5) -> DataFrame:
    return filter_rare(df, "item_id", min_listens)


def filter_rare_users(df: DataFrame, min_listens: int = 20) -> DataFrame:
    return filter_rare(df, "uid", min_listens)


def cut_track_length(df: DataFrame, shortest: int = 60, longest: int = 350) -> DataFrame:
    """Keep tracks within the length bounds, both ends included; unknown length is dropped."""
    return df.where(F.col("track_length_seconds").between(shortest, longest))


def last_reaction(df: DataFrame, order: tuple[str, ...] = ("timestamp", "seq")) -> DataFrame:
    """The latest reaction per (uid, item_id), all columns kept.

    ``order`` names the columns that define row order; remaining columns break ties, so the
    pick is the same on every run.
    """
    rest = [c for c in df.columns if c not in order and c not in ("uid", "item_id")]
    newest = (
        df.where(F.col("event_type").isin(REACTIONS))
        .groupBy("uid", "item_id")
        .agg(F.max(F.struct(*order, *rest)).alias("_row"))
    )
    return newest.select("uid", "item_id", "_row.*").select(*df.columns)


def rename_events(df: DataFrame) -> DataFrame:
    """unlike counts as dislike, undislike as like; other names stay."""
    return df.replace(EVENT_NAMES, subset=["event_type"])


def relevant_events(df: DataFrame, min_ratio: float = 50) -> DataFrame:
    """Test truth: likes, and plays of at least half the track."""
    return df.where((F.col("event_type") == LIKE) | (F.col("played_ratio_pct") >= min_ratio))


def null_id_rows(df: DataFrame) -> DataFrame:
    """Rows without user or item id."""
    return df.where(F.col("uid").isNull() | F.col("item_id").isNull())


def organic_only(df: DataFrame, organic: bool = True) -> DataFrame:
    """Rows the user found alone (organic) or that were recommended to them."""
    return df.where(F.col("is_organic") == (1 if organic else 0))


def known_items_only(df: DataFrame, *catalogues: DataFrame) -> DataFrame:
    """Rows whose item is in every catalogue (metadata, embeddings, ...)."""
    for catalogue in catalogues:
        df = df.join(catalogue.select("item_id"), "item_id", "left_semi")
    return df


def hash_sample(
    df: DataFrame, fraction: float = 0.3, seed: int = 42, keys: tuple[str, ...] = ("seq",)
) -> DataFrame:
    """Repeatable sample by hash of a row key, or of the user for whole-user samples."""
    return df.where(unit_hash(seed, *keys) < fraction)


def clean_items_meta(meta: DataFrame) -> DataFrame:
    """One complete row per item: rows with a null are dropped and the smallest one is kept."""
    others = [c for c in meta.columns if c != "item_id"]
    picked = meta.dropna().groupBy("item_id").agg(F.min(F.struct(*others)).alias("_row"))
    return picked.select("item_id", "_row.*").select(*meta.columns)
