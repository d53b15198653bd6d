"""From the raw log to cleaned train and test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from songweave.operators.cleaning import (
    cut_track_length,
    dedup_keep_none,
    filter_rare_items,
    filter_rare_users,
    last_reaction,
    listen_events,
    reaction_events,
    relevant_events,
    rename_events,
)
from songweave.operators.splits import time_split_with_gap
from songweave.session import cut_lineage
from songweave.sources.tables import concat_aligned, scan, sink


def clean_listens(
    listens: DataFrame,
    min_item_rows: int = 5,
    min_user_rows: int = 20,
    shortest: int = 60,
    longest: int = 350,
) -> DataFrame:
    """Duplicates, then rare items, then rare users, then track length; each step once.

    The next two steps count what the step before left over, so each result is written once
    instead of being recomputed for its counts.
    """
    unique = cut_lineage(dedup_keep_none(listens))
    common = cut_lineage(filter_rare_items(unique, min_item_rows))
    return cut_track_length(filter_rare_users(common, min_user_rows), shortest, longest)


def clean_reactions(reactions: DataFrame) -> DataFrame:
    """Last reaction per pair, with undone likes and dislikes turned into their opposite."""
    return rename_events(last_reaction(reactions))


def preprocess_train(log: DataFrame, test_days: float = 1, gap_seconds: int = 30, **limits):
    train, _ = time_split_with_gap(log, test_days, gap_seconds)
    return concat_aligned(
        clean_listens(listen_events(train), **limits), clean_reactions(reaction_events(train))
    )


def preprocess_test(log: DataFrame, test_days: float = 1, gap_seconds: int = 30) -> DataFrame:
    _, test = time_split_with_gap(log, test_days, gap_seconds)
    return concat_aligned(
        relevant_events(listen_events(test)),
        relevant_events(clean_reactions(reaction_events(test))),
    )


def run(spark, source: str, train_path: str, test_path: str, **options) -> None:
    """Read the raw log and store both cleaned tables."""
    log = scan(spark, source)
    sink(preprocess_train(log, **options), train_path)
    split = {k: v for k, v in options.items() if k in ("test_days", "gap_seconds")}
    sink(preprocess_test(log, **split), test_path)
