"""Bucketed vector search against all inner products."""

import numpy as np
import pytest

from songweave.models.matrix import bm25_weights, similar_items, summed_lists
from songweave.models.popular import MostPopular
from songweave.operators import buckets
from songweave.operators.buckets import cell_topk, lsh_topk

SCHEMA = "item_id long, normalized_embed array<double>"


def frames(spark, items, queries):
    catalogue = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(items)] + [(10**6, None)], SCHEMA
    )
    asked = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(queries)] + [(10**6, None)], "q long, vector array<double>"
    )
    return asked, catalogue


def by_query(found):
    out = {}
    for r in found.collect():
        out.setdefault(r["q"], []).append((r["rank"], r["item_id"], r["score"]))
    return {q: [(i, s) for _, i, s in sorted(rows)] for q, rows in out.items()}


def exact(items, queries, k):
    out = {}
    for q, v in enumerate(queries):
        score = np.round(items @ v, 12)
        order = np.lexsort([np.arange(len(items)), -score])[:k]
        out[q] = [(int(i), float(score[i])) for i in order]
    return out


@pytest.mark.parametrize("kind", ["clustered", "random", "copies", "few"])
def test_cells_are_exact(spark, monkeypatch, kind):
    monkeypatch.setattr(buckets, "SLICE", 70)
    rng = np.random.default_rng(3)
    items = rng.normal(size=(900, 12))
    if kind == "clustered":
        items = rng.normal(size=(9, 12))[np.arange(900) % 9] * 4 + items * 0.05
    elif kind == "copies":
        items[100:500] = items[0]  # one cell holds nearly half
    elif kind == "few":
        items = items[:3]
    queries = np.concatenate([items[::40], rng.normal(size=(5, 12)) * 3, np.zeros((1, 12))])
    asked, catalogue = frames(spark, items, queries)
    got = by_query(cell_topk(asked, catalogue, 6, ["q"], cells=10))
    want = exact(items, queries, 6)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]])


def test_bounds_leave_out_most_cells_of_clustered_items():
    rng = np.random.default_rng(4)
    items = rng.normal(size=(40, 24))[np.arange(4000) % 40] * 3 + rng.normal(size=(4000, 24)) * 0.1
    cells = buckets.Cells(buckets.spread_centroids(items[:1000], 40, 15), np.zeros(0))
    owner, far = cells.nearest(items)
    radius = np.full(len(cells.middle), -1.0)
    np.maximum.at(radius, owner, far)
    bounds = buckets.Cells(cells.middle, radius).bounds(items[:50])
    products = items[:50] @ items.T
    for c in np.unique(owner):
        assert (bounds[:, c] >= products[:, owner == c].max(1)).all()
    beat = np.sort(products, 1)[:, -10]
    assert (bounds >= beat[:, None]).mean() < 0.15


def test_sign_buckets_find_most_neighbours(spark, monkeypatch):
    monkeypatch.setattr(buckets, "SLICE", 100)
    rng = np.random.default_rng(5)
    items = rng.normal(size=(60, 16))[np.arange(1200) % 60] + 0.3 * rng.normal(size=(1200, 16))
    items /= np.linalg.norm(items, axis=1, keepdims=True)
    asked, catalogue = frames(spark, items, items[::30])
    got = by_query(lsh_topk(asked, catalogue, 10, ["q"]))
    want = exact(items, items[::30], 10)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    for q, found in got.items():
        assert [s for _, s in found] == sorted((s for _, s in found), reverse=True)
        assert all(s == pytest.approx(items[i] @ items[q * 30]) for i, s in found)


def test_probes_are_the_cheapest_changes():
    planes = np.eye(3)[None]
    tables, found = buckets.sign_buckets(np.array([[0.9, -0.1, 0.5]]), planes, 4)
    assert tables.tolist() == [[0, 0, 0, 0]]
    assert found.tolist() == [[0b101, 0b111, 0b001, 0b011]]


def test_search_of_nothing(spark):
    asked, catalogue = frames(spark, np.empty((0, 3)), np.ones((2, 3)))
    for search in (lsh_topk, cell_topk):
        assert search(asked, catalogue, 3, ["q"]).count() == 0
        assert search(asked.limit(0), catalogue, 3, ["q"]).count() == 0


def test_similar_items_equal_all_products(spark):
    rng = np.random.default_rng(6)
    data = [(int(u), int(i), float(rng.random())) for u in range(30) for i in rng.choice(25, 8, replace=False)]
    frame = spark.createDataFrame(data, "uid long, item_id long, weight double")
    weighted = {(r["uid"], r["item_id"]): r["weight"] for r in bm25_weights(frame).collect()}
    got = {(r["item_id"], r["neighbor"]): r["similarity"] for r in similar_items(bm25_weights(frame), 100).collect()}
    want = {}
    for (u, i), x in weighted.items():
        for (v, j), y in weighted.items():
            if u == v and x and y:
                want[i, j] = want.get((i, j), 0) + x * y
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


@pytest.mark.parametrize("n", [None, 4])
def test_summed_lists_equal_plain_sums(spark, n):
    rng = np.random.default_rng(7)
    data, want = [], {}
    for user in range(9):
        for _ in range(200 if user == 3 else rng.integers(1, 6)):  # one user holds most rows
            items = rng.choice(50, 7, replace=False)
            near, weight = rng.integers(-3, 9, 7).astype(float), float(rng.integers(1, 4))
            data.append((user, weight, items.tolist(), near.tolist()))
            for i, s in zip(items.tolist(), near):
                want[user, i] = want.get((user, i), 0) + weight * s
    frame = spark.createDataFrame(data, "uid long, weight double, items array<long>, similarities array<double>")
    got = {(r["uid"], r["item_id"]): r["score"] for r in summed_lists(frame.repartition(5), n).collect()}
    for user in range(9):
        own = {i: s for (u, i), s in want.items() if u == user and s > 0}
        mine = {i: s for (u, i), s in got.items() if u == user}
        assert all(mine[i] == own[i] for i in mine)
        least = sorted(own.values(), reverse=True)[: n or len(own)]
        assert {i for i, s in own.items() if least and s >= least[-1]} == set(mine)


def test_lists_longer_than_the_old_cut(spark, make_log):
    log = make_log([(1, i, 5 * i, "like") for i in range(5000)] + [(2, 3, 10, "like")])
    users = spark.createDataFrame([(1,), (9,)], "uid long")
    model = MostPopular(last_days=30).fit(log)
    found = model.recommend(users).collect()
    for user in (1, 9):
        own = sorted((r["rank"], r["item_id"], r["score"]) for r in found if r["uid"] == user)
        assert [r for r, *_ in own] == list(range(1, 5001))
        assert own[0][1:] == (3, 2.0) and [i for _, i, _ in own[1:4]] == [0, 1, 2]
    short = model.recommend(users, 7).where("uid = 9").collect()
    assert sorted((r["rank"], r["item_id"]) for r in short) == [(1, 3), (2, 0), (3, 1), (4, 2), (5, 4), (6, 5), (7, 6)]
    assert model.recommend(users.limit(0)).count() == 0
