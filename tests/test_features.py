import numpy as np
import pytest
from conftest import rows

from songweave.functions.columns import decay_per_second
from songweave.operators import features, interactions, profiling

DAY = 86400
MONDAY = 4 * DAY  # 1970-01-05


@pytest.mark.parametrize("mode,weekday,weekend", [("iso", 4 / 7, 3 / 7), ("documented", 5 / 7, 2 / 7)])
def test_weekday_modes(make_log, mode, weekday, weekend):
    log = make_log([(1, 1, MONDAY + d * DAY + 7 * 3600, "listen") for d in range(7)])
    row = features.user_time_profile(log, mode).first()
    assert row["weekday_share"] == pytest.approx(weekday)
    assert row["weekend_share"] == pytest.approx(weekend)
    assert row["avg_listen_weekday"] == pytest.approx(4.0 if mode == "iso" else 3.0)
    assert row["morning_share"] == 1.0


def test_user_stats_of_a_single_event_user(make_log):
    log = make_log([(1, 1, 1000, "listen"), (2, 1, 1000 + 3 * DAY, "like")])
    stats = {r["uid"]: r for r in features.user_music_stats(log).collect()}
    assert stats[2]["user_lifetime_days"] == 0 and stats[2]["user_lifetime_days_safe"] == 1
    assert stats[1]["user_lifetime_days"] == pytest.approx(3)
    assert stats[1]["days_since_last_play"] == pytest.approx(3)


@pytest.mark.parametrize("hours", [2, 0.5, 24, 0])
def test_decayed_weight_against_brute_force(make_log, hours):
    rng = np.random.default_rng(1)
    events = [
        (int(u), int(i), int(t), "listen", float(r))
        for u, i, t, r in zip(
            rng.integers(0, 4, 300), rng.integers(0, 6, 300),
            rng.integers(0, 250 * DAY // 5, 300) * 5, rng.integers(30, 120, 300),
        )
    ]
    tau = decay_per_second(0.9, hours)
    kept = [e for e in events if e[4] > 50]
    last = {u: max(e[2] for e in kept if e[0] == u) for u in {e[0] for e in kept}}
    want: dict = {}
    for u, i, t, *_ in kept:
        want[u, i] = want.get((u, i), 0.0) + tau ** (last[u] - t)
    got = {
        (r["uid"], r["item_id"]): (r["conf"], r["weights"])
        for r in interactions.decayed_play_weight(make_log(events), tau).collect()
    }
    assert got.keys() == want.keys()
    for pair, value in want.items():
        assert got[pair][0] == pytest.approx(value, rel=1e-9, abs=1e-300)
        assert got[pair][1] == pytest.approx(0.0 if value < 1e-9 else value, rel=1e-9)


def test_pair_profile_guards(spark, make_log):
    meta = spark.createDataFrame(
        [(1, 10, None), (2, 10, 5), (3, None, 5)], "item_id long, artist_id long, album_id long"
    )
    log = make_log([
        (1, 1, 100, "listen"), (1, 1, 200, "listen"), (1, 2, 300, "like"), (1, 3, 86700, "listen"),
    ])
    got = {r["item_id"]: r for r in features.pair_profile(log, meta).collect()}
    assert got[1]["listen_count"] == 2 and got[2]["listen_count"] is None
    assert got[2]["ui_days_since_last_play"] == 9999
    assert got[1]["ui_days_since_last_play"] == pytest.approx((86700 - 200) / DAY)
    assert got[1]["artist_listen_count"] == 2 and got[2]["artist_listen_count"] == 2
    assert got[3]["artist_listen_count"] is None and got[1]["album_listen_count"] is None
    assert got[2]["album_listen_count"] == 1


def test_counts_leave_out_pairs_with_only_undone_reactions(make_log):
    log = make_log([(1, 1, 5, "unlike"), (1, 2, 5, "like"), (1, 3, 5, "listen", None)])
    assert rows(interactions.interaction_counts(log)) == [
        (1, 2, 0, 0.0, 0, 1), (1, 3, 1, 0.0, 0, 0)
    ]


def test_duplicates_with_one_huge_group(spark):
    data = [(i, [1.0, 0.0] if i < 40 else [float(i), 1.0]) for i in range(60)] + [(99, [45.0, 1.0])]
    emb = spark.createDataFrame(data, "item_id long, normalized_embed array<float>")
    got = rows(profiling.duplicate_embeddings(emb))
    assert got == sorted([(0, i, 40) for i in range(40)] + [(45, 45, 2), (45, 99, 2)])
    assert dict(rows(profiling.canonical_item_map(emb)))[99] == 45


def test_results_do_not_depend_on_partitions(spark, make_log):
    log = make_log([(i % 5, i % 7, i * 4000, "listen", 60.0 + i % 50) for i in range(200)])
    results = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(rows(features.item_stats(log.repartition(int(n)))))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]
