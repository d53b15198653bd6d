"""What a run leaves on disk on its way: shuffled rows and tables that nothing reads any more."""

import os

import numpy as np
from pyspark.sql import functions as F

from songweave import session
from songweave.models import matrix
from songweave.models.matrix import ALS, BM25, BPR, batch_gradients
from songweave.models.stratified import StratifiedBPR, turns
from songweave.operators import products, similarity
from songweave.session import ensure_checkpoint_dir, filesystem, passing, stored


def kept(spark) -> set[str]:
    return set(os.listdir(filesystem(ensure_checkpoint_dir(spark))[1]))


def shuffled(spark) -> int:
    """Shuffle files in this session's local folder."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return sum(1 for f in manager.getAllFiles().mkString("\n").split("\n") if "shuffle" in f)


def test_shuffled_rows_go_with_their_step(spark):
    before = shuffled(spark)
    stored(spark.range(10000).groupBy((F.col("id") % 100).alias("k")).count())
    assert shuffled(spark) <= before


def test_passing_tables_go(spark):
    before = kept(spark)
    with passing():
        stored(spark.range(5))
        result, path = stored(spark.range(7), outer=True)
    assert kept(spark) - before == {os.path.basename(path)}
    assert result.count() == 7


def sums_of(spark, n):
    rows = spark.range(3000).selectExpr("id % 97 uid", "xxhash64(id) % 50 + 50 item_id", "1.0D + id % 7 weight")
    entries = spark.range(2000).selectExpr("xxhash64(id) % 50 + 50 a", "id % 333 b", "id % 13 - 2.0D v").distinct()
    lists = products.packed_lists(entries, "a", "b", "v")
    found = products.list_products(rows, lists, "uid", "item_id", n)
    return {r["key"]: dict(zip(r["items"], r["scores"])) for r in found.collect()}


def test_waves_make_the_same_sums(spark, monkeypatch):
    monkeypatch.setattr(products, "LEAST_ROWS", 300)
    whole = sums_of(spark, 20)
    monkeypatch.setattr(products, "WAVE_ROWS", 1000)
    monkeypatch.setattr(products, "WAVE_ENTRIES", 40000)
    before = kept(spark)
    parts = sums_of(spark, 20)
    # The rows, the lists and the sums of each wave.
    assert len(kept(spark) - before) > 3
    assert whole.keys() == parts.keys() and len(whole) == 97
    for key, found in whole.items():
        assert found.keys() == parts[key].keys()
        assert np.allclose(list(found.values()), [parts[key][i] for i in found])


def test_neighbours_leave_one_table(spark, make_log):
    log = make_log([(u, u * i % 17, 100 * u + i, "listen", 90.0) for u in range(9) for i in range(7)])
    before = kept(spark)
    model = BM25(K=3, weight_mode="float").fit(log)
    assert len(kept(spark) - before) == 2
    assert model.state["similar"].count() > 0


def test_strata_leave_their_last_vectors_only(spark, make_log):
    log = make_log([(u, u * i % 17, 100 * u + i, "listen", 90.0) for u in range(9) for i in range(7)])
    before = kept(spark)
    model = StratifiedBPR(factors=3, iterations=3, blocks=2, weight_mode="float").fit(log)
    # Heard pairs and the vectors of the last of six strata.
    assert len(kept(spark) - before) == 2
    assert model.state["users"].count() == 9


def test_turns_have_no_vector_in_common_and_keep_the_order():
    rng = np.random.default_rng(4)
    draws = np.array([(u, *rng.choice(30, 2, replace=False)) for u in rng.integers(0, 20, 400)])
    found = turns(draws, 20, 30)
    for turn in range(found.max() + 1):
        own = draws[found == turn]
        assert len(set(own[:, 0])) == len(own) and len(set(own[:, 1:].ravel())) == 2 * len(own)
    for a in range(400):
        for b in range(a):
            if draws[a, 0] == draws[b, 0] or set(draws[a, 1:]) & set(draws[b, 1:]):
                assert found[b] < found[a]
    # As few as one vector's draws, not as many as there are draws.
    assert found.max() + 1 < 200


def test_what_iterations_shuffle_goes(spark, make_log, monkeypatch):
    """Of 40 half-steps' shuffles, 20 files each, all were left."""
    log = make_log([(u, u * i % 17, 100 * u + i, "listen", 90.0) for u in range(40) for i in range(9)])
    monkeypatch.setattr(session, "SWEEP_SECONDS", 0.3)
    before = shuffled(spark)
    ALS(factors=2, iterations=20, weight_mode="float").fit(log)
    assert shuffled(spark) - before < 400


def test_lists_compare_rounded_scores(monkeypatch):
    """Scores that are equal when rounded tie, also where the list is already full."""
    rounded = []
    plain = np.round
    monkeypatch.setattr(similarity.np, "round", lambda a, d: rounded.append(np.size(a)) or plain(a, d))
    rng = np.random.default_rng(6)
    queries, items = rng.normal(size=(40, 3)), rng.normal(size=(900, 3))
    items[600:] = items[300:600] * (1 + 1e-14 * rng.normal(size=(300, 1)))
    lists = similarity._Lists(queries, np.full(40, 7))
    for start in range(0, 900, 300):
        lists.meet(items[start : start + 300], np.arange(start, start + 300))
    scores = plain(queries @ items.T, similarity.DIGITS)
    for q in range(40):
        want = np.lexsort([np.arange(900), -scores[q]])[:7]
        assert lists.items[lists.rows == q].tolist() == want.tolist()
    # The first 300 are rounded, of the others hardly any.
    assert sum(rounded) < 1.3 * 40 * 300


def test_batches_sum_every_draw(spark, monkeypatch):
    """Blocks of users make the step that a plain loop over the draws makes."""
    monkeypatch.setattr(matrix, "LEAST_DRAWS", 20)
    monkeypatch.setattr(matrix, "DRAWS_AT_ONCE", 7)
    rng = np.random.default_rng(8)
    users, items = rng.normal(size=(10, 4)), rng.normal(size=(9, 4))
    users[:, -1] = 1
    draws = [(int(u), *map(int, rng.choice(8, 2, replace=False))) for u in rng.integers(0, 9, 80)]
    model = BPR(factors=3, learning_rate=0.1, regularization=0.02)
    before = kept(spark)
    moved = model._moved(
        spark.createDataFrame(draws, "uid long, item_id long, other long"),
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(users)], "uid long, vector array<double>"),
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(items)], "item_id long, vector array<double>"),
        80,
    )
    assert len(kept(spark) - before) == 2
    up, down = np.zeros((10, 4)), np.zeros((9, 4))
    for u, i, j in draws:
        z = 1 / (1 + np.exp(users[u] @ (items[i] - items[j])))
        up[u] += z * (items[i] - items[j]) - 0.02 * users[u]
        down[i] += z * users[u] - 0.02 * items[i]
        down[j] += -z * users[u] - 0.02 * items[j]
    want = users + 0.1 * up, items + 0.1 * down
    want[0][:, -1] = 1
    for table, key, rows in zip(moved, ("uid", "item_id"), want):
        got = {r[key]: r["vector"] for r in table.collect()}
        assert len(got) == len(rows) and all(np.allclose(got[k], rows[k]) for k in got)
    assert batch_gradients(users, items, *np.empty((3, 0), np.int64))[0].sum() == 0


def test_unknown_users_and_items_have_no_draws(spark, make_log):
    log = make_log([(u or None, i or None, 100 * u + i, "listen", 90.0) for u in range(9) for i in range(7)])
    model = BPR(factors=2, iterations=2, weight_mode="float").fit(log)
    users = {r["uid"]: r["vector"] for r in model.state["users"].collect()}
    assert set(users) <= {None, *range(1, 9)} and all(np.isfinite(v).all() for v in users.values())
    assert None not in {r["item_id"] for r in model.state["items"].collect()}


def test_epochs_leave_their_last_vectors_only(spark, make_log):
    log = make_log([(u, u * i % 17, 100 * u + i, "listen", 90.0) for u in range(9) for i in range(7)])
    before = kept(spark)
    BPR(factors=2, iterations=2, batch_draws=20, weight_mode="float").fit(log)
    # Heard pairs, numbers of items, and the last users and items.
    assert len(kept(spark) - before) == 4
