"""Exact top-k search against all products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from songweave.llm import common, pivots, queries  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, id long, cell int, x int, score string"


def ran(spark, rows, monkeypatch):
    frame = spark.createDataFrame([(*r, 1, 2, 3, "n") for r in rows], SCHEMA).repartition(5)
    monkeypatch.setattr(queries.common, "read_table", lambda *_: frame)
    return sorted(map(tuple, queries.op13_exact_topk(spark, "").collect()))


def brute(rows):
    kept = {}
    for i, v in rows:
        if i is None or not v or None in v or not np.isfinite(np.array(v, "f4")).all():
            continue
        x = [int(np.floor(256 * float(np.float32(c)))) for c in v]
        kept[i] = min(kept.get(i, x), x)
    out = []
    for i, x in kept.items():
        if i % 50 == 0:
            found = [
                (-max(min(sum(a * b for a, b in zip(x, y)), 2**63 - 1), -(2**63)), j)
                for j, y in kept.items()
                if j != i and len(y) == len(x)
            ]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(sorted(found)[:5])]
    return sorted(out)


@pytest.fixture()
def small(monkeypatch):
    for name, value in {
        "PIVOTS": 6, "BLOCK_ROWS": 60, "CHUNK_ROWS": 7, "SUMMARY_ROWS": 3, "FIRST_STEP": 4,
    }.items():
        monkeypatch.setattr(pivots, name, value)


def test_search_equals_all_products(spark, monkeypatch, small):
    rng = np.random.default_rng(1)
    middle = rng.normal(size=(8, 10)) * 3
    rows = [
        (i, (middle[i % 8] + rng.normal(size=10) * rng.choice([0.01, 0.5])).astype("f4").tolist())
        for i in range(900)
    ]
    rows += [(1000 + i, rows[50][1]) for i in range(450)]  # a third are copies: ties by id
    rows += [(i, (100 * rng.normal(size=10)).astype("f4").tolist()) for i in (2000, 2001)]
    odd = [None, [], [float("nan")] * 10, [None] * 10, [float("inf")] + [0.0] * 9]
    rows += [(3000 + 50 * j, v) for j, v in enumerate(odd)]
    rows += [(None, rows[0][1]), (50, rows[51][1]), (100, rows[100][1]), (4000, [0.0] * 10)]
    rows += [(5000, [1.0, 2.0]), (5001, [3.0, -1.0])]  # another length
    assert ran(spark, rows, monkeypatch) == brute(rows)


def test_scores_beyond_doubles_are_exact(spark, monkeypatch):
    rows = [(i, [2.0**20 + i, float(i)]) for i in range(0, 60)] + [(60, [2.0**45, 0.0])]
    assert ran(spark, rows, monkeypatch) == brute(rows)


def test_few_candidates_and_nothing(spark, monkeypatch):
    rows = [(0, [1.0]), (50, [2.0]), (3, [-1.0])]
    assert ran(spark, rows, monkeypatch) == brute(rows)
    assert ran(spark, [(0, [1.0])], monkeypatch) == []
    assert ran(spark, [], monkeypatch) == []


def test_walks_stop_early_where_vectors_cluster():
    rng = np.random.default_rng(2)
    middle = rng.normal(size=(30, 64)) * 256
    x = np.floor(middle[np.arange(3000) % 30] + rng.normal(size=(3000, 64)) * 8).astype(np.int64)
    near = pivots.far_apart(x[:500], 30)
    points = x.astype(float)
    squares = (points * points).sum(1)
    top = squares.max()
    table = pivots.pivot_distances(
        pivots.flat_squares(points, near), np.sqrt(np.maximum(top - squares, 0)), near, top
    )
    block = pivots.Block(np.arange(3000), x, table, top)
    asked = np.arange(0, 3000, 50)
    number, found, score, looked = pivots.walk(
        block, near, asked, x[asked], np.full(len(asked), pivots.NONE), 5
    )
    products = x[asked] @ x.T
    products[np.arange(len(asked)), asked] = pivots.NONE
    want = np.sort(products, 1)[:, ::-1][:, :5]
    assert (np.sort(score.reshape(-1, 5), 1)[:, ::-1] == want).all()
    assert looked < 0.1 * len(asked) * 3000


def test_bounds_hold():
    rng = np.random.default_rng(3)
    x = rng.integers(-900, 900, size=(400, 16))
    x[::7] *= 50
    near = pivots.far_apart(x[:100], 9)
    points = x.astype(float)
    squares = (points * points).sum(1)
    flat, top = pivots.flat_squares(points, near), squares.max()
    table = pivots.pivot_distances(flat, np.sqrt(np.maximum(top - squares, 0)), near, top)
    asked = pivots.pivot_distances(flat, np.zeros(len(x)), near, top)
    products = points @ points.T
    assert (pivots.upper_bounds(asked, squares, table, top) >= products).all()
    ranged = pivots.range_bounds(asked, squares, table.min(0), table.max(0), top)
    assert (ranged >= products.max(1)).all()


def test_small_batches_restores_the_setting(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with pytest.raises(ValueError), common.small_batches(spark, 3):
        assert spark.conf.get(name) == "3"
        raise ValueError
    assert spark.conf.get(name) == before


def test_index_keeps_every_vector(spark):
    frame = spark.range(500).select(
        F.col("id").alias("vec_id"), F.array(F.col("id").cast("float"), F.lit(1.0)).alias("embedding")
    )
    index = pivots.build_index(frame)
    ids = [np.frombuffer(r["ids"], "<i8") for r in index.blocks.select("ids").collect()]
    assert sorted(np.concatenate(ids).tolist()) == list(range(500))
