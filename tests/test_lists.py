import math

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from songweave.operators import metrics, postprocess
from songweave.plans.ranking import Ranker, final_list, rankable_users, ranker_split


@pytest.fixture(scope="module")
def meta(spark):
    data = [(i, i // 3 if i != 7 else None, i % 4 if i != 8 else None) for i in range(30)]
    return spark.createDataFrame(data, "item_id long, artist_id long, album_id long")


def walk(items, owners, max_artist, max_album):
    artists, albums, taken = {}, {}, []
    for item in items:
        artist, album = owners.get(item, (None, None))
        if artist is not None and artists.get(artist, 0) >= max_artist:
            continue
        if album is not None and albums.get(album, 0) >= max_album:
            continue
        taken.append(item)
        artists[artist] = artists.get(artist, 0) + 1
        albums[album] = albums.get(album, 0) + 1
    return taken


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(0, 3), st.integers(0, 33), st.integers(0, 9)), min_size=1,
             max_size=40, unique_by=lambda t: t[:2]),
    st.integers(1, 3), st.integers(1, 3),
)
def test_diversify_is_the_greedy_walk(spark, meta, scored, max_artist, max_album):
    owners = {r[0]: (r[1], r[2]) for r in meta.collect()}
    df = spark.createDataFrame([(u, i, float(s)) for u, i, s in scored],
                               "uid long, item_id long, score double")
    got: dict = {}
    for uid, rank, item in rows(postprocess.diversify(df, meta, max_artist, max_album),
                                "uid", "rank", "item_id"):
        got.setdefault(uid, []).append(item)
    for uid in {u for u, *_ in scored}:
        order = sorted((-s, i) for u, i, s in scored if u == uid)
        assert got[uid] == walk([i for _, i in order], owners, max_artist, max_album)


@pytest.mark.parametrize("n,k,rate,explore", [(20, 10, 0.2, 2), (3, 10, 0.2, 1), (5, 5, 0.5, 2),
                                              (20, 10, 0.0, 0), (1, 10, 1.0, 1)])
def test_epsilon_greedy(spark, n, k, rate, explore):
    df = spark.createDataFrame([(1, i, float(-i)) for i in range(n)],
                               "uid long, item_id long, score double")
    out = postprocess.epsilon_greedy_topk(df, k, rate)
    got = sorted(tuple(r) for r in out.select("rank", "item_id", "explored").collect())
    size = min(k, n)
    assert [g[0] for g in got] == list(range(1, size + 1))
    assert [g[1] for g in got[:size - explore]] == list(range(size - explore))
    assert sum(g[2] for g in got) == explore
    assert len({g[1] for g in got}) == size
    assert rows(out) == rows(postprocess.epsilon_greedy_topk(df.repartition(3), k, rate))
    with pytest.raises(ValueError):
        postprocess.epsilon_greedy_topk(df, k, 1.5)


def test_recently_played_is_dropped(spark, make_log):
    end = 10 * 86400
    log = make_log([(1, 1, end - 2 * 86400, "listen"), (1, 2, end - 2 * 86400 + 5, "listen"),
                    (1, 3, end, "like"), (2, 9, end, "listen")])
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (2, 2)], "uid long, item_id long")
    assert rows(postprocess.drop_recently_played(df, log)) == [(1, 1), (1, 3), (2, 2)]


@pytest.fixture(scope="module")
def judged(spark):
    recs = spark.createDataFrame(
        [(1, 10, 1), (1, 11, 2), (1, 12, 3), (2, 10, 1), (4, 10, 1)], "uid long, item_id long, rank int"
    )
    truth = spark.createDataFrame([(1, 11), (1, 99), (1, 11), (2, 50), (3, 10)],
                                  "uid long, item_id long")
    return recs, truth


def test_metrics_by_hand(spark, judged):
    recs, truth = judged
    got = {r["uid"]: r for r in metrics.user_metrics(recs, truth, 2).collect()}
    assert set(got) == {1, 2}
    assert got[1]["precision"] == 0.5 and got[1]["recall"] == 0.5
    assert got[1]["ndcg"] == pytest.approx((1 / math.log2(3)) / (1 + 1 / math.log2(3)))
    assert got[2]["recall"] == 0 and got[2]["ndcg"] == 0
    train = spark.createDataFrame([(10,), (11,), (12,), (13,)], "item_id long")
    assert metrics.coverage_at_k(recs, truth, train, 2).first()[0] == 0.5
    emb = spark.createDataFrame(
        [(10, [1.0, 0.0]), (11, [0.0, 1.0]), (99, [0.6, 0.8])],
        "item_id long, normalized_embed array<double>",
    )
    cos = dict(rows(metrics.cosine_similarity_at_k(recs, truth, emb, 3)))
    assert cos[1] == pytest.approx((0.6 + 1.0 + 0.0) / 3) and cos[2] == 0
    total = metrics.evaluate_model(recs, truth, train, emb, 2).first()
    assert (total["users_scored"], total["users_skipped"]) == (2, 1)
    assert 0 <= total["recall"] <= 1 and total["coverage"] == 0.5
    table = metrics.compare_to_baseline(metrics.evaluate_model(recs, truth, train, emb, 2), "BM25")
    assert {r["metric"]: r["published"] for r in table.collect()}["recall"] == 3.36


def test_rankable_users_and_folds(spark):
    data = [(1, 1, 0.0), (1, 2, None), (2, 1, 0.7), (2, 2, None), (3, 1, 0.7)]
    df = spark.createDataFrame(data, "uid long, item_id long, weights double")
    assert rows(rankable_users(df)) == [(2, 1, 0.7), (2, 2, 0.0)]
    many = spark.range(400).selectExpr("id % 20 as uid", "id as item_id", "0.0 as weights")
    by_user = ranker_split(many, unit="user").select("uid", "fold").distinct()
    assert by_user.count() == 20
    share = ranker_split(many).where("fold = 'valid'").count() / 400
    assert 0.1 < share < 0.3


def test_ranker_orders_by_a_learnt_feature(spark, tmp_path):
    df = spark.range(300).selectExpr(
        "id % 30 as uid", "id as item_id", "cast(id % 7 as double) as a", "1.0 as b",
        "case when id % 7 >= 4 then 0.7 else 0.0 end as weights",
    )
    ranker = Ranker(["a", "b"], max_iter=5, depth=2).fit(df)
    ranked = ranker.predict(df)
    assert ranked.where("rank = 1").join(df, ["uid", "item_id"]).where("a < 4").count() == 0
    ranker.save(f"{tmp_path}/ranker")
    again = Ranker.load(f"{tmp_path}/ranker")
    assert rows(again.predict(df), "uid", "item_id", "rank") == rows(ranked, "uid", "item_id", "rank")


def test_final_list_switches(spark, make_log, meta):
    log = make_log([(1, 0, 10 * 86400, "listen")])
    scored = spark.createDataFrame([(1, i, float(30 - i)) for i in range(12)],
                                   "uid long, item_id long, score double")
    off = final_list(scored, log, meta, False, False, False)
    assert [r[1] for r in sorted((r["rank"], r["item_id"]) for r in off.collect())] == list(range(12))
    kept = final_list(scored, log, meta, True, True, False)
    assert 0 not in {r["item_id"] for r in kept.collect()}
    assert final_list(scored, log, meta).count() <= 10


def test_lists_are_ordered_by_small_scores_too(spark):
    import numpy as np

    from songweave.functions.columns import top_per_key

    rng = np.random.default_rng(1)
    scores = [*(rng.random(300) * 1e-10), *(rng.random(300) * 1e5), 0.0, -1e-12]
    frame = spark.createDataFrame([(1, i, float(s)) for i, s in enumerate(scores)], "uid long, item_id long, score double")
    got = [r["item_id"] for r in top_per_key(frame, "uid", "score", None).orderBy("rank").collect()]
    assert got == sorted(range(len(scores)), key=lambda i: -scores[i])
    noisy = spark.createDataFrame([(1, 2, 1e-10 / 3), (1, 1, 1e-10 / 3 * (1 + 1e-14))], "uid long, item_id long, score double")
    assert [r["item_id"] for r in top_per_key(noisy, "uid", "score", None).orderBy("rank").collect()] == [1, 2]


def test_repeated_metadata_repeats_no_item(spark):
    from songweave.operators.postprocess import diversify

    lists = spark.createDataFrame([(1, 10, 3.0), (1, 11, 2.0)], "uid long, item_id long, score double")
    meta = spark.createDataFrame(
        [(10, 1, 5), (10, 1, 6), (11, 2, None), (11, 2, None)],
        "item_id long, artist_id long, album_id long",
    )
    got = diversify(lists, meta).orderBy("rank").collect()
    assert [(r["item_id"], r["rank"]) for r in got] == [(10, 1), (11, 2)]
