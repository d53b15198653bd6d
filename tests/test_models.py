import numpy as np
import pytest
from conftest import rows

from songweave.functions.columns import decay_per_second
from songweave.models.matrix import ALS, BM25, BPR, id_map, id_maps, map_with_id_maps
from songweave.models.overlap import ItemKNN
from songweave.models.registry import MODELS, initialize_model
from songweave.models.taste import (
    KMeansEmbedding,
    SphericalMeanShift,
    cluster_histories,
    jitter,
    unit,
)
from songweave.models.walk import RandomWalkWithRestart
from songweave.operators.similarity import vector_topk

DAY = 86400


@pytest.fixture(scope="module")
def listens():
    rng = np.random.default_rng(3)
    return [
        (int(u), int(i), int(t) * 5, "listen", 90.0)
        for u, i, t in zip(
            rng.integers(0, 8, 160), rng.integers(0, 12, 160), rng.integers(0, 4000, 160)
        )
    ]


@pytest.fixture(scope="module")
def log(make_log, listens):
    return make_log(listens)


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame([(u,) for u in [*range(8), 500]], "uid long")


def lists(recs):
    found: dict = {}
    for uid, item, score, rank in rows(recs, "uid", "item_id", "score", "rank"):
        found.setdefault(uid, {})[item] = score
    return found


def dense(listens, weight):
    m = np.zeros((8, 12))
    for u, i, t, *_ in listens:
        m[u, i] += weight(u, t)
    return m


@pytest.mark.parametrize("mode", ["truncated", "float"])
def test_bm25_against_dense_matrices(log, users, listens, mode):
    counts = dense(listens, lambda u, t: 1)
    weights = np.log1p(counts)
    if mode == "truncated":
        weights = np.trunc(weights)
    x = unit(weights)
    heard = counts > 0
    length = x.sum(axis=0)
    norm = 0.25 + 0.75 * length / length.mean()
    w = x * 1.1 / (0.1 * norm + x) * (np.log(12) - np.log1p(heard.sum(axis=1)))[:, None]
    sim = np.round(w.T @ w, 9)
    k = 4
    kept = np.zeros_like(sim)
    for i in range(12):
        best = sorted(range(12), key=lambda j: (-sim[i, j], j))[:k]
        kept[i, best] = sim[i, best]
    want = x @ kept
    got = lists(BM25(K=k, weight_mode=mode).fit(log).recommend(users))
    assert 500 not in got
    for u in range(8):
        for i in range(12):
            if want[u, i] > 1e-8:
                assert got[u][i] == pytest.approx(want[u, i], abs=1e-7)


@pytest.mark.parametrize("mode", ["truncated", "float"])
def test_item_knn_against_dense_matrices(log, users, listens, mode):
    last = {u: max(t for v, _, t, *_ in listens if v == u) for u in range(8)}
    tau = decay_per_second(0.9, 2)
    m = dense(listens, lambda u, t: 1)
    recent = dense(listens, lambda u, t: tau ** (last[u] - t))
    if mode == "truncated":
        recent = np.trunc(recent + 1e-12)
    want = unit(recent @ m.T) @ unit(m)
    got = lists(ItemKNN(weight_mode=mode).fit(log).recommend(users))
    for u in range(8):
        for i in range(12):
            assert got[u].get(i, 0.0) == pytest.approx(want[u, i], abs=1e-8)


def pagerank(listens, meta, user, alpha, steps, tol):
    """Dense walk on the whole graph for one user."""
    counts = dense(listens, lambda u, t: 1)
    n_users, n_items = counts.shape
    artists = sorted({a for a, _ in meta.values()}, key=str)
    albums = sorted({b for _, b in meta.values()}, key=str)
    n = n_users + n_items + len(artists) + len(albums)
    adj = np.zeros((n, n))
    for u, i in zip(*np.nonzero(counts)):
        adj[u, n_users + i] = min(max(np.log1p(counts[u, i]), 1e-6), 10)
    for i in range(n_items):
        adj[n_users + i, n_users + n_items + artists.index(meta[i][0])] = 10
        adj[n_users + i, n_users + n_items + len(artists) + albums.index(meta[i][1])] = 10
    adj = adj + adj.T
    p = adj / adj.sum(axis=1, keepdims=True)
    v = np.eye(n)[user]
    x = np.full(n, 1 / n)
    for _ in range(steps):
        new = alpha * p.T @ x + (1 - alpha) * v
        done = np.abs(new - x).sum() < tol
        x = new
        if done:
            break
    return x[n_users:n_users + n_items]


@pytest.mark.parametrize("steps,tol,n", [(1, 0.01, 12), (2, 0.01, 12), (4, 0.01, 12), (4, 0.01, 5),
                                         (6, 0.35, 12)])
def test_walk_against_dense_pagerank(spark, log, users, listens, steps, tol, n):
    # Item 11 has no album, so both of its owners are the shared unknown ones.
    owners = [(i, i % 3, i % 4 if i != 11 else None) for i in range(12)]
    meta = spark.createDataFrame(owners, "item_id long, artist_id long, album_id long")
    known = {i: (a, b) if b is not None else (None, None) for i, a, b in owners}
    model = RandomWalkWithRestart(meta, listen_count_limit=0, max_iter=steps, tol=tol).fit(log)
    got = lists(model.recommend(users, n))
    assert 500 not in got
    for u in range(8):
        want = pagerank(listens, known, u, 0.5, steps, tol)
        best = sorted(range(12), key=lambda i: (-round(want[i], 9), i))[:n]
        assert set(got[u]) == set(best)
        for i in best:
            assert got[u][i] == pytest.approx(want[i], abs=1e-8)


def test_walk_without_unknown_links(spark, log):
    meta = spark.createDataFrame([(1, 1, 1)], "item_id long, artist_id long, album_id long")
    linked = RandomWalkWithRestart(meta, listen_count_limit=0).fit(log)
    apart = RandomWalkWithRestart(meta, listen_count_limit=0, link_unknown=False).fit(log)
    assert linked.state["mass"].where("node < 0").count() == 2
    assert apart.state["mass"].where("node < 0").count() == 0


@pytest.mark.parametrize("block", [7, 65536])
def test_vector_topk_against_brute_force(spark, block):
    rng = np.random.default_rng(5)
    items = unit(rng.normal(size=(60, 6)))
    items[40:] = items[3]  # a third of the catalogue are copies
    queries = unit(rng.normal(size=(20, 6)))
    cat = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(items)], "item_id long, normalized_embed array<double>"
    )
    ask = spark.createDataFrame(
        [(q, v.tolist(), 3 + q % 4) for q, v in enumerate(queries)],
        "q long, vector array<double>, k int",
    )
    from pyspark.sql import functions as F

    for k in (5, F.col("k")):
        got: dict = {}
        for q, rank, item in rows(vector_topk(ask, cat, k, ["q"], block=block), "q", "rank", "item_id"):
            got.setdefault(q, []).append(item)
        scores = np.round(queries @ items.T, 12)
        for q in range(20):
            size = 5 if k is not None and isinstance(k, int) else 3 + q % 4
            assert got[q] == sorted(range(60), key=lambda i: (-scores[q, i], i))[:size]


@pytest.fixture(scope="module")
def tastes():
    rng = np.random.default_rng(7)
    centers = unit(rng.normal(size=(3, 8)))
    return {u: unit(centers[np.arange(9 + u) % 3] + 0.05 * rng.normal(size=(9 + u, 8)))
            for u in range(4)}


def clustered(df):
    return {(r["uid"], r["cluster"]): (r["tracks"], r["vector"]) for r in df.collect()}


def test_long_histories_in_blocks_equal_whole_histories(spark, tastes):
    data = [(u, i, v.tolist()) for u, x in tastes.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(data, "uid long, item_id long, vector array<double>")
    solver = SphericalMeanShift(kappa=20.0, max_iter=30)
    for level in (0.0, 0.01):
        whole = clustered(cluster_histories(df, solver, level))
        parts = clustered(cluster_histories(df, solver, level, modes_per_task=4))
        assert whole.keys() == parts.keys()
        for key in whole:
            assert whole[key][0] == parts[key][0]
            assert np.allclose(whole[key][1], parts[key][1], atol=1e-6)


def test_mean_shift_finds_the_groups(tastes):
    labels, centers = SphericalMeanShift(kappa=20.0, max_iter=50).fit_predict(tastes[3])
    assert len(centers) == 3 and len(set(labels)) == 3
    assert np.allclose(np.linalg.norm(centers, axis=1), 1)


def test_jitter_stays_on_the_sphere_and_repeats(tastes):
    moved = jitter(tastes[2], 0.01, 42, 2)
    assert np.allclose(np.linalg.norm(moved, axis=1), 1)
    assert np.allclose(moved, jitter(tastes[2], 0.01, 42, 2))
    assert np.allclose(np.sum(moved * tastes[2], axis=1), 1 / np.sqrt(1 + 0.01**2))


def test_taste_recommender_lists_near_tracks_once(spark, make_log):
    rng = np.random.default_rng(9)
    vectors = unit(rng.normal(size=(30, 8)))
    emb = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(vectors)],
        "item_id long, normalized_embed array<double>",
    )
    log = make_log([(1, i, i * 5, "like") for i in range(4)] + [(2, 50, 5, "like")])
    model = KMeansEmbedding(emb, kappa=50.0, use_jitter=False).fit(log)
    asked = spark.createDataFrame([(1,), (2,), (3,)], "uid long")
    got = rows(model.recommend(asked, 12), "uid", "item_id", "score", "rank")
    assert {g[0] for g in got} == {1}
    assert len({g[1] for g in got}) == len(got) <= 12


def test_id_maps_are_dense_and_unique(spark):
    df = spark.createDataFrame(
        [("a", 10, 1), ("b", 20, 2), ("c", 30, 3), ("a", 20, 4)], "uid string, item_id long, rating long"
    )
    users, items = id_maps(df)
    assert sorted(r["uid_index"] for r in users.collect()) == [0, 1, 2]
    assert sorted(r["item_index"] for r in items.collect()) == [0, 1, 2]
    mapped = map_with_id_maps(df, users, items)
    assert mapped.columns == df.columns and mapped.where("uid is null").count() == 0


def test_factor_models_rank_heard_items_higher(make_log, users):
    # Two groups of users with disjoint tastes.
    taste = [(u, i, 100 * u + i, "listen", 90.0)
             for u in range(8) for i in range(12) if (u < 4) == (i < 6) and (u + i) % 5]
    log = make_log(taste)
    heard = {(u, i) for u, i, *_ in taste}
    for model in (ALS(factors=4, iterations=5, weight_mode="float"),
                  BPR(factors=4, learning_rate=0.2, iterations=14, weight_mode="float")):
        got = lists(model.fit(log).recommend(users, 12))
        assert 500 not in got
        right = [
            got[u][i] > got[u][j]
            for u in range(8) for i in range(12) for j in range(12)
            if (u, i) in heard and (u < 4) != (j < 6)
        ]
        assert np.mean(right) > 0.8, model.name


def test_bpr_applies_every_draw(spark, make_log):
    model = BPR(factors=2, learning_rate=0.1, regularization=0.01)
    factors = spark.createDataFrame([(1, [0.5, -1.0, 0.0])], "item_id long, vector array<double>")
    parts = spark.range(100).selectExpr("1L item_id", "array(1.0D, id / 100D, -0.5D) _g")
    got = model._step(factors, parts, "item_id", False).first()["vector"]
    gradient, start = np.array([100.0, 49.5, -50.0]), np.array([0.5, -1.0, 0.0])
    assert got == pytest.approx(start + 0.1 * (gradient - 100 * 0.01 * start))
    # No vector is in many more draws of a batch than asked for, and no draw is lost.
    heard = spark.range(60).selectExpr("id uid", "0L item_id").unionAll(
        spark.range(60).selectExpr("id uid", "id + 1 item_id")
    )
    model = BPR(factors=2, batch_draws=10)
    batches = model._batches(heard)
    assert batches == 7
    numbered = id_map(heard, "item_id", "item_index")
    draws = model._draws(heard, numbered, 0, batches).collect()
    whole = model._draws(heard, numbered, 0, 1).collect()
    assert sorted(d[:3] for d in draws) == sorted(d[:3] for d in whole)
    hot = np.bincount([d["batch"] for d in draws if d["item_id"] == 0], minlength=batches)
    assert (hot > 0).all() and hot.max() <= 20
    log = make_log([(u, i, 5 * u, "listen", 90.0) for u in range(6) for i in (0, u + 1)])
    fitted = BPR(factors=2, iterations=2, batch_draws=3, weight_mode="float").fit(log)
    assert fitted.state["items"].count() == 7 and fitted.state["users"].count() == 6


def test_save_and_load(spark, tmp_path, log, users):
    for model in (BM25(K=3), ItemKNN()):
        model.fit(log).save(f"{tmp_path}/{model.name}")
        again = type(model).load(spark, f"{tmp_path}/{model.name}")
        assert again.params == model.params
        order = ("uid", "rank", "item_id")
        assert rows(again.recommend(users, 5), *order) == rows(model.recommend(users, 5), *order)


def test_registry():
    assert len(MODELS) == 9
    assert initialize_model("MostPopular", last_days=3).last_days == 3
    with pytest.raises(ValueError):
        initialize_model("Nothing")


def test_vector_lists_leave_a_task_once(spark):
    """Lists of parts of the catalogue were shuffled and merged: queries x blocks x k rows."""
    rng = np.random.default_rng(8)
    cat = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(unit(rng.normal(size=(90, 5))))],
        "item_id long, normalized_embed array<float>",
    )
    ask = cat.select(cat.item_id.alias("q"), "normalized_embed")
    found = vector_topk(ask, cat, 4, ["q"], query_vector="normalized_embed", block=8)
    plan = found._jdf.queryExecution().toString()
    assert "Window" not in plan and "CoGroups" not in plan
    assert found.count() == 90 * 4
    twice = vector_topk(ask.unionAll(ask), cat, 4, ["q"], query_vector="normalized_embed", block=8)
    assert twice.count() == 90 * 4 and twice.where("rank <= 2 and q <> item_id").count() == 0


def test_best_of_a_key_leaves_in_one_row(spark):
    """Products of pairs were shuffled twice, by pair and by key, and ranked by a window."""
    from pyspark.sql import functions as F
    from songweave.operators import products

    rng = np.random.default_rng(9)
    cells = [(int(u), int(i), float(rng.random())) for u in range(40) for i in rng.choice(30, 6, replace=False)]
    frame = spark.createDataFrame(cells + [(None, 3, 1.0), (5, None, 1.0)], "uid long, item_id long, weight double")
    lists = products.packed_lists(frame, "uid", "item_id", "weight")
    sums = products.list_products(frame, lists, "item_id", "uid", 5)
    assert sums.count() == sums.select("key").distinct().count() == 30
    best = products.best_of_lists(sums, 5, "other", "score")
    assert "Window" not in best._jdf.queryExecution().toString()
    assert best.where("other is null").count() > 0
    want = {}
    for u, i, x in cells:
        for v, j, y in cells + [(5, None, 1.0)]:
            if u == v:
                want.setdefault(i, {})[j] = want.get(i, {}).get(j, 0.0) + x * y
    for r in best.collect():
        own = sorted(want[r["key"]].items(), key=lambda e: -e[1])
        assert r["score"] == pytest.approx(own[r["rank"] - 1][1]) and r["other"] == own[r["rank"] - 1][0]


def test_walk_goes_from_tracks_to_tracks(spark, log):
    """The third step spread every user's mass over all users, though nobody stops there."""
    from pyspark.sql import functions as F

    users = log.select("uid").distinct()
    meta = spark.createDataFrame([(i, i % 3, i % 5) for i in range(40)], "item_id long, artist_id long, album_id long")
    model = RandomWalkWithRestart(meta, listen_count_limit=0, max_iter=4, tol=0.0).fit(log)
    starts = users.withColumn("node", F.col("uid") * 4)
    starts = starts.join(model.state["mass"].select("node"), "node", "left_semi").select("uid", "node")
    parts = model._personal(starts)
    assert sorted(parts) == [1, 2, 4]
    assert parts[4].where(F.pmod("node", F.lit(4)) != 1).count() == 0 < parts[4].count()
    model.params["tol"] = 9.0
    assert model._undecided(3)
