import math

import pytest
from conftest import rows

from songweave.operators import features, metrics
from songweave.operators.reductions import reduce_log
from songweave.plans.candidates import (
    ITEM_FEATURES,
    PAIR_FEATURES,
    USER_FEATURES,
    describe_candidates,
    feature_table,
)

DAY = 86400


@pytest.fixture
def log(make_log):
    events = ["listen", "like", "dislike", "unlike", "listen", "listen"]
    data = [
        (i * 7 % 11, i * 5 % 13, 1_000_000 + i * i * 977 % (90 * DAY), events[i % 6], float(i % 120))
        for i in range(500)
    ]
    return make_log([*data, (3, None, 2_000_000, "listen", 80.0), (None, 4, 2_000_001, "like")])


@pytest.fixture
def meta(spark):
    return spark.createDataFrame(
        [(i, i % 3 if i % 4 else None, i % 5) for i in range(12)] + [(2, 0, 0)],
        "item_id long, artist_id long, album_id long",
    )


def counted(spark, df):
    """``df``, and an accumulator of its rows read over all jobs."""
    total = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            total.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema), total


def close(got, want):
    assert len(got) == len(want)
    for a, b in zip(got, want):
        for x, y in zip(a, b):
            assert x == y or math.isclose(x, y, rel_tol=1e-12), (a, b)


@pytest.mark.parametrize("mode", ["iso", "documented"])
def test_reductions_give_the_features_of_the_log(log, meta, mode):
    reduced = reduce_log(log, mode)
    for got, want in [
        (reduced.user_music_stats(), features.user_music_stats(log, mode)),
        (reduced.item_stats(), features.item_stats(log, mode)),
        (reduced.pair_profile(meta), features.pair_profile(log, meta)),
    ]:
        assert got.columns == want.columns
        close(rows(got), rows(want))


def test_features_read_the_log_twice(spark, log, meta):
    seen, total = counted(spark, log)
    pairs = features.pair_profile(log, meta).select("uid", "item_id", *PAIR_FEATURES)
    items = features.item_stats(log).select("item_id", *ITEM_FEATURES)
    users = features.user_music_stats(log).select("uid", *USER_FEATURES)
    want = rows(pairs.join(items, "item_id", "left").join(users, "uid", "left"))
    close(rows(feature_table(seen, meta).select("uid", "item_id", *PAIR_FEATURES, *ITEM_FEATURES, *USER_FEATURES)),
          [r for r in want])
    assert total.value <= 2 * log.count()


@pytest.mark.parametrize("mode", ["pairs", "separate"])
def test_described_candidates_read_the_log_twice(spark, log, meta, mode):
    seen, total = counted(spark, log)
    wanted = spark.createDataFrame([(1, 1, 0.5), (1, 99, 0.4), (98, 2, 0.3)], "uid long, item_id long, score double")
    found = {(r["uid"], r["item_id"]): r for r in describe_candidates(wanted, seen, meta, mode).collect()}
    assert len(found) == 3 and total.value <= 2 * log.count()
    assert found[1, 99]["item_plays_last_30d"] == 0 and found[98, 2]["user_total_plays"] == 0
    assert (found[1, 99]["user_total_plays"] > 0) == (mode == "separate")


def test_empty_log(log, meta):
    assert feature_table(log.limit(0), meta).collect() == []


def test_evaluation_reads_each_table_once(spark):
    recs, seen_recs = counted(spark, spark.createDataFrame(
        [(u, i, i) for u in range(1, 6) for i in range(1, 5)], "uid long, item_id long, rank int"))
    truth, seen_truth = counted(spark, spark.createDataFrame(
        [(u, u) for u in range(1, 5)] + [(9, 1), (1, 1)], "uid long, item_id long"))
    train, seen_train = counted(spark, spark.createDataFrame([(1, i) for i in range(1, 9)], "uid long, item_id long"))
    emb = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "item_id long, normalized_embed array<double>")
    row = metrics.evaluate_model(recs, truth, train, emb, 2).first()
    assert (row["users_scored"], row["users_skipped"]) == (4, 1)
    assert row["recall"] == pytest.approx(0.5) and row["coverage"] == pytest.approx(2 / 8)
    # Users 1 and 2 have one item with a vector each; of the two listed items one is it.
    assert row["cos_sim"] == pytest.approx((0.5 + 0.5) / 4)
    assert (seen_recs.value, seen_truth.value, seen_train.value) == (20, 6, 8)
