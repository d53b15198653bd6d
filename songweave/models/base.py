"""Common shape of retrieval models.

``fit`` turns an interaction log into a few state tables; ``recommend`` joins a frame of
users with them and returns (uid, item_id, score, rank) for all users at once. The state is
plain DataFrames, so saving a model means writing parquet.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from songweave.functions.columns import top_per_key
from songweave.session import cut_lineage

# Longest list a model returns unless asked otherwise.
MAX_PREDICTIONS = 2000


class RetrievalModel:
    name = "model"

    def __init__(self, **params):
        self.params = params
        self.state: dict[str, DataFrame] = {}

    def __getattr__(self, key):
        params = self.__dict__.get("params", {})
        if key in params:
            return params[key]
        raise AttributeError(key)

    def fit(self, df: DataFrame) -> RetrievalModel:
        raise NotImplementedError

    def recommend(self, users: DataFrame, n: int | None = MAX_PREDICTIONS) -> DataFrame:
        raise NotImplementedError

    def save(self, path: str) -> None:
        """Write the state tables and the parameters under ``path``."""
        spark = next(iter(self.state.values())).sparkSession
        for table, df in self.state.items():
            df.write.mode("overwrite").parquet(f"{path}/state/{table}")
        meta = {"params": self.params, "tables": sorted(self.state)}
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode(
            "overwrite"
        ).text(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str, **inputs: DataFrame) -> RetrievalModel:
        """Read a saved model; ``inputs`` are frames its constructor takes (such as metadata)."""
        meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
        model = cls(**inputs, **meta["params"])
        model.state = {t: spark.read.parquet(f"{path}/state/{t}") for t in meta["tables"]}
        return model


# Entries of a shared list that travel together.
LIST_SLICE = 4096
# Rows that a task makes of its users when each gets a list.
ROWS_OUT = 1 << 17


def list_tasks(users: DataFrame, n: int) -> int:
    """Tasks that make ``n`` rows of each row of ``users``."""
    return max(1, math.ceil(users.count() * n / ROWS_OUT))


def dealt(users: DataFrame, n: int) -> DataFrame:
    """``users`` stored and dealt to tasks by how many rows they make with ``n`` for each: rows of
    users are so short that tasks of a size in bytes would get them all at once."""
    stored = cut_lineage(users)
    tasks = list_tasks(stored, n)
    return stored.repartition(tasks) if tasks > 1 else stored


def same_list_for_all(users: DataFrame, top: DataFrame, n: int | None) -> DataFrame:
    """Give every user the ``n`` best rows of ``top`` (item_id, score), or all of them.

    A list of at most ``n`` entries reaches the users as a scalar array, not as a join. Without
    a limit the list has the length of the catalogue: its entries are numbered by a range sort
    and meet the users slice by slice.
    """
    if n is None:
        return _whole_list_for_all(users, top)
    entry = F.struct((-F.col("score")).alias("key"), "item_id", "score")
    best = top.orderBy(F.desc("score"), F.asc("item_id")).limit(n)
    listed = best.agg(F.sort_array(F.collect_list(entry))).scalar()
    return dealt(users.select("uid"), n).select("uid", F.posexplode(listed).alias("pos", "e")).select(
        "uid",
        F.col("e.item_id").alias("item_id"),
        F.col("e.score").cast("double").alias("score"),
        (F.col("pos") + 1).alias("rank"),
    )


def _whole_list_for_all(users: DataFrame, top: DataFrame) -> DataFrame:
    scored = top.select("item_id", F.col("score").cast("double").alias("score"))
    key = F.col("score").desc(), F.col("item_id").asc()
    bits = F.lit((1 << 33) - 1)
    dealt = cut_lineage(
        scored.repartitionByRange(*key)
        .sortWithinPartitions(*key)
        .withColumns(
            {
                "_task": F.spark_partition_id(),
                "_at": F.monotonically_increasing_id().bitwiseAND(bits),
            }
        )
    )
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    # A row for every task.
    tasks = dealt.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
    tasks = tasks.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = dealt.join(tasks, "_task").withColumn("rank", F.col("_before") + F.col("_at") + 1)
    slices = cut_lineage(
        placed.groupBy(F.floor((F.col("rank") - 1) / LIST_SLICE).alias("_slice")).agg(
            F.collect_list(F.struct("item_id", "score", F.col("rank").cast("int").alias("rank"))).alias("_e")
        )
    )
    many = slices.agg(F.coalesce(F.max("_slice"), F.lit(-1))).scalar()
    return (
        users.select("uid", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(many, F.lit(0)))).alias("_slice"))
        .join(slices, "_slice")
        .select("uid", F.explode("_e").alias("_e"))
        .select("uid", "_e.*")
    )


def ranked(df: DataFrame, n: int | None) -> DataFrame:
    """(uid, item_id, score) to the best ``n`` (or all) per user with their rank."""
    scored = df.select("uid", "item_id", F.col("score").cast("double").alias("score"))
    return top_per_key(scored, "uid", "score", n)
