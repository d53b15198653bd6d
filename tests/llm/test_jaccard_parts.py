"""Parts of the n-gram join against brute force, and pairs in their first common leaf."""

import random

import numpy as np
import pandas as pd
import pytest

pytest.importorskip("public_tokenizers")

from songweave.llm import jaccard  # noqa: E402
from songweave.llm.components import components  # noqa: E402


def some_sets(rng, kind, m):
    if kind == "near":
        base = rng.integers(0, 2**63, 80).astype(np.uint64)
        found = []
        for _ in range(m):
            own = base.copy()
            swap = rng.random(80) < rng.choice([0.02, 0.2, 0.5])
            own[swap] = rng.integers(0, 2**63, swap.sum())
            found.append(np.unique(own))
        return found
    pool = rng.integers(0, 2**63, 40 if kind == "dense" else 3000).astype(np.uint64)
    return [np.unique(rng.choice(pool, rng.integers(1, 60))) for _ in range(m)]


@pytest.mark.parametrize("kind", ["near", "dense", "sparse"])
@pytest.mark.parametrize("m", [1, 2, 7, 150])
def test_overlaps_are_exact(kind, m):
    sets = some_sets(np.random.default_rng(m), kind, m)
    got = jaccard.overlaps(sets)
    for i in range(m):
        for j in range(m):
            assert i == j or got[i, j] == len(np.intersect1d(sets[i], sets[j]))


@pytest.mark.parametrize("kind", ["near", "dense", "sparse"])
def test_links_join_all_that_links_join(kind):
    rng = np.random.default_rng(5)
    sets = some_sets(rng, kind, 90)
    comps = rng.integers(0, 70, 90)
    pairs = jaccard.joining_links(sets, comps, 6, 10)

    def groups(links):
        parent = list(range(90))

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        first = {}
        for i, c in enumerate(comps.tolist()):
            parent[root(i)] = root(first.setdefault(c, i))
        for i, j in links:
            parent[root(i)] = root(j)
        return [root(i) for i in range(90)]

    every = []
    for i in range(90):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if both * 10 >= (len(sets[i]) + len(sets[j]) - both) * 6:
                every.append((i, j))
    assert set(map(frozenset, pairs)) <= set(map(frozenset, every))
    mine, want = groups(pairs), groups(every)
    assert all((mine[i] == mine[j]) == (want[i] == want[j]) for i in range(90) for j in range(i))
    assert len(pairs) < len(set(comps.tolist()))


def test_pairs_meet_in_their_first_common_leaf():
    rng = random.Random(4)
    earlier = [np.array(sorted(rng.sample(range(-50, 50), rng.randrange(6)))) for _ in range(40)]
    i, j = map(np.ravel, np.meshgrid(np.arange(40), np.arange(40)))
    got = jaccard.first_meetings(earlier, i, j)
    for a, b, keep in zip(i.tolist(), j.tolist(), got.tolist()):
        assert keep == (not set(earlier[a].tolist()) & set(earlier[b].tolist()))
    none = [np.empty(0, np.int64)] * 3
    assert jaccard.first_meetings(none, np.array([0, 1]), np.array([1, 2])).all()


def test_batches_are_cut_between_groups():
    rows = pd.DataFrame({"leaf": [1, 1, 1, 2, 2, 3, 3], "x": [0, 0, 1, 0, 0, 0, 0], "y": [0, 0, 1, 0, 0, 0, 1]})
    batches = [rows.iloc[:2], rows.iloc[2:4], rows.iloc[4:4], rows.iloc[4:]]
    found = list(jaccard.whole_groups(iter(batches)))
    assert sum(map(len, found)) == 7
    seen = set()
    for part in found:
        keys = set(map(tuple, part.to_numpy().tolist()))
        assert not keys & seen
        seen |= keys


def test_sizes_that_fit_nothing_leave_a_leaf(spark):
    rows = [(1, 10, [7, 8]), (2, 11, [7]), (3, 30, [7, 8]), (4, 100, [7]), (5, 31, [8]), (6, 200, [8])]
    classes = spark.createDataFrame(rows, "class long, n long, first array<long>")
    got = {(r["leaf"], r["class"]) for r in jaccard._leaves(classes, 9, 10).collect()}
    assert got == {(7, 1), (7, 2), (8, 3), (8, 5)}


def test_blocks_of_a_large_leaf_meet_but_for_the_main_component(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 10)
    rows = [(1, i, 0 if i < 60 else i, 5, 90, 450) for i in range(90)] + [(2, 5, 5, 5, 3, 15), (2, 70, 70, 5, 3, 15)]
    placed = spark.createDataFrame(rows, "leaf long, class long, component long, n long, rows long, weight long")
    found = jaccard._blocks(placed).collect()
    met = {}
    for r in found:
        met.setdefault((r["leaf"], r["class"]), set()).add((r["x"], r["y"]))
        assert r["block"] in (r["x"], r["y"])
    for a in range(90):
        for b in range(a):
            both = met[1, a] & met[1, b]
            assert bool(both) == (a >= 60 or b >= 60) or (a < 60 and b < 60)
    inside = sum(len(met[1, a]) for a in range(60)) / 60
    assert inside <= 4  # the blocks of what is outside, not all nine
    assert met[2, 5] == met[2, 70] == {(0, 0)}


def test_components_with_repeats_and_both_directions(spark):
    edges = [(3, 1), (1, 3), (1, 3), (2, 5), (5, 9), (9, 2), (7, 7)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["id"]: r["component"] for r in found} == {1: 1, 3: 1, 2: 2, 5: 2, 9: 2}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
