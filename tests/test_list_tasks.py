"""Lists are made by tasks of a bounded number of rows, and travel once."""

from pyspark.sql import functions as F

from songweave.models import base
from songweave.models.overlap import ItemKNN
from songweave.models.popular import MostPopular
from songweave.models.walk import RandomWalkWithRestart
from songweave.plans.candidates import candidates_wide

USERS, ITEMS = 400, 12


def log_of(spark):
    rows = spark.range(USERS * 6).select(
        (F.col("id") % USERS).alias("uid"),
        (F.xxhash64("id") % ITEMS + ITEMS).alias("item_id"),
        (F.col("id") * 7).alias("timestamp"),
        F.when(F.col("id") % 5 == 0, "like").otherwise("listen").alias("event_type"),
        F.lit(90.0).alias("played_ratio_pct"),
        F.lit(1).alias("is_organic"),
    )
    return rows.localCheckpoint()


def largest_task(df) -> int:
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_a_shared_list_is_dealt_by_its_rows(spark, monkeypatch):
    monkeypatch.setattr(base, "ROWS_OUT", 200)
    log = log_of(spark)
    users = log.select("uid").distinct()
    lists = MostPopular().fit(log).recommend(users, 10)
    assert lists.count() == USERS * 10
    assert largest_task(lists) <= 2 * 200


def test_lists_of_a_walk_are_dealt_by_their_rows(spark, monkeypatch):
    monkeypatch.setattr(base, "ROWS_OUT", 200)
    log = log_of(spark)
    meta = log.select("item_id", F.lit(1).alias("artist_id"), F.col("item_id").alias("album_id"))
    model = RandomWalkWithRestart(meta, listen_count_limit=0).fit(log)
    lists = model.recommend(log.select("uid"), 10)
    assert lists.groupBy("uid").count().where("count <> 10").isEmpty()
    assert largest_task(lists) <= 3 * 200


def test_lists_of_neighbours_are_dealt_by_their_rows(spark, monkeypatch):
    monkeypatch.setattr(base, "ROWS_OUT", 200)
    model = ItemKNN(weight_mode="float").fit(log_of(spark))
    lists = model.recommend(spark.range(USERS).toDF("uid"), 10)
    assert lists.groupBy("uid").count().where("count <> 10").isEmpty()
    assert largest_task(lists) <= 3 * 200


def test_wide_candidates_travel_once(spark):
    rows = [(1, 5, "a", 0.5), (1, 5, "b", None), (1, 6, "b", 2.0), (None, 5, "a", 1.0), (2, 7, "c", 9.0)]
    long = spark.createDataFrame(rows, "uid long, item_id long, model string, score double")
    wide = candidates_wide(long, ["a", "b"])
    got = {(r["uid"], r["item_id"]): (r["score_a"], r["score_b"]) for r in wide.collect()}
    assert got == {(1, 5): (0.5, 0.0), (1, 6): (0.0, 2.0), (None, 5): (1.0, 0.0), (2, 7): (0.0, 0.0)}
    plan = wide._jdf.queryExecution().sparkPlan().toString()
    prepared = wide._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert "pivotfirst" not in plan
    assert prepared.count("Exchange hashpartitioning") == 1
