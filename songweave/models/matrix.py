"""Models on the user-item weight matrix: BM25 neighbours, implicit ALS and BPR.

The matrix is a long table (uid, item_id, weight); no matrix object exists anywhere.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS as ImplicitALS
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from songweave.functions.columns import top_per_key
from songweave.models.base import MAX_PREDICTIONS, RetrievalModel
from songweave.operators.interactions import confidence_weights, interaction_counts
from songweave.operators.products import (
    NULL_ID,
    best_of_lists,
    best_places,
    compact,
    hot_split,
    list_products,
    packed_lists,
)
from songweave.operators.similarity import vector_topk
from songweave.operators.skew import product_sum, unit_rows
from songweave.session import cut_lineage, drop, passing, stored, swept

WEIGHT_MODES = ("truncated", "float")


def whole_weights(weight: Column, mode: str) -> Column:
    """Weights as the matrix stores them: cut to whole numbers, or as they are."""
    if mode not in WEIGHT_MODES:
        raise ValueError(f"unknown weight mode {mode!r}")
    if mode == "float":
        return weight.cast("double")
    # A weight that is whole up to rounding noise counts as whole.
    return F.round(weight, 9).cast("int").cast("double")


def user_item_weights(
    df: DataFrame, weight_mode: str = "truncated", last_days: int = 300, min_ratio: float = 50
) -> DataFrame:
    """Unit-length user rows of log listen counts; zero weights stay as entries."""
    counts = confidence_weights(interaction_counts(df, last_days), min_ratio)
    weights = counts.select(
        "uid", "item_id", whole_weights(F.col("weights"), weight_mode).alias("weight")
    )
    return unit_rows(weights, "uid")


def id_map(df: DataFrame, column: str, index: str) -> DataFrame:
    """Dense numbers 0..n-1 for the distinct values of ``column``.

    Values are ordered by (first three hex digits of their md5, value). Each of the 4096
    prefixes is numbered by its own task and shifted by the sizes of the prefixes before it,
    so the only single-task step sees 4096 rows, and any id distribution spreads evenly.
    """
    ids = df.select(column).where(F.col(column).isNotNull()).distinct()
    bucketed = ids.withColumn("_b", F.substring(F.md5(F.col(column).cast("string")), 1, 3))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bucketed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n")).select(
        "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    place = F.row_number().over(Window.partitionBy("_b").orderBy(column))
    numbered = bucketed.withColumn("_place", place).join(F.broadcast(offsets), "_b")
    return numbered.select(column, (F.col("_offset") + F.col("_place") - 1).alias(index))


def id_maps(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(users, items) as (uid, uid_index) and (item_id, item_index)."""
    return id_map(df, "uid", "uid_index"), id_map(df, "item_id", "item_index")


def map_with_id_maps(df: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Replace ids by their dense numbers; ids without one become null."""
    mapped = df.join(users, "uid", "left").join(items, "item_id", "left")
    names = {"uid": F.col("uid_index").alias("uid"), "item_id": F.col("item_index").alias("item_id")}
    return mapped.select(*[names.get(c, F.col(c)) for c in df.columns])


def bm25_weights(weights: DataFrame, k1: float = 0.1, b: float = 0.75) -> DataFrame:
    """BM25 weighting with items as documents and users as terms."""
    per_item = weights.groupBy("item_id").agg(F.sum("weight").alias("_len"))
    per_user = weights.groupBy("uid").agg(F.count(F.lit(1)).alias("_df"))
    n_items = per_item.agg(F.count(F.lit(1))).scalar()
    mean_len = per_item.agg(F.avg("_len")).scalar()
    x = F.col("weight")
    norm = (1.0 - b) + b * F.try_divide(F.col("_len"), mean_len)
    tf = F.coalesce(F.try_divide(x * (k1 + 1.0), k1 * norm + x), F.lit(0.0))
    idf = F.log(n_items.cast("double")) - F.log1p(F.col("_df").cast("double"))
    lengths = weights.join(per_item, "item_id")
    return lengths.join(per_user, "uid").select("uid", "item_id", (tf * idf).alias("weight"))


def similar_items(weighted: DataFrame, k: int = 200) -> DataFrame:
    """The ``k`` items with the largest inner product per item, itself included."""
    entries = weighted.where((F.col("weight") != 0) & F.col("item_id").isNotNull())
    entries = cut_lineage(entries.select("uid", "item_id", "weight"))
    cold, hot = hot_split(entries, "item_id")
    lists = packed_lists(entries, "uid", "item_id", "weight")
    sums = list_products(cold, lists, "item_id", "uid", k, positive=False)
    few = best_of_lists(sums, k, "neighbor", "similarity").withColumnRenamed("key", "item_id")
    products = product_sum(
        hot, entries.withColumnRenamed("item_id", "neighbor"), "uid", "item_id", "neighbor", "similarity"
    )
    many = top_per_key(products, "item_id", "similarity", k, tie="neighbor")
    columns = ["item_id", "neighbor", "similarity", "rank"]
    kind = weighted.schema["item_id"].dataType
    both = few.select(*columns).unionByName(many.select(*columns))
    return both.select(F.col("item_id").cast(kind), F.col("neighbor").cast(kind), "similarity", "rank")


def summed_lists(rows: DataFrame, n: int | None) -> DataFrame:
    """(uid, item_id, score): each user's sums of weight * similarity over the lists of its rows
    (uid, weight, items, similarities), and of those at least the ``n`` largest above 0.

    For rows that carry their lists; ``list_products`` fetches them, once for many rows. A user's
    rows follow each other in one task, which keeps a sum for every item met so far.
    """
    ordered = rows.repartition("uid").sortWithinPartitions("uid")

    def best(users, items, scores) -> pa.RecordBatch:
        keep = scores > 0
        users, items, scores = users[keep], items[keep], scores[keep]
        kept = best_places(users, scores, n)
        return pa.RecordBatch.from_arrays(
            [pa.array(users[kept]), pa.array(items[kept]), pa.array(scores[kept])],
            ["uid", "item_id", "score"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        for batch in batches:
            lists = batch.column("items")
            sizes = lists.value_lengths().to_numpy()
            users = np.repeat(batch.column("uid").to_numpy(), sizes)
            scores = np.repeat(batch.column("weight").to_numpy(), sizes)
            scores = scores * batch.column("similarities").flatten().to_numpy()
            found = users, lists.flatten().to_numpy(), scores
            held = compact(*[np.concatenate(c) for c in zip(held, found)])
            if len(held[0]):
                done = np.searchsorted(held[0], held[0][-1])
                yield best(*[c[:done] for c in held])
                held = tuple(c[done:] for c in held)
        yield best(*held)

    return ordered.mapInArrow(run, "uid long, item_id long, score double")


class BM25(RetrievalModel):
    """Item neighbours by BM25-weighted co-listening; a list is the user's row times them."""

    name = "BM25"

    def __init__(
        self,
        K: int = 200,
        K1: float = 0.1,
        B: float = 0.75,
        weight_mode: str = "truncated",
        last_days: int = 300,
        min_ratio: float = 50,
    ):
        super().__init__(
            K=K, K1=K1, B=B, weight_mode=weight_mode, last_days=last_days, min_ratio=min_ratio
        )

    def fit(self, df: DataFrame) -> BM25:
        weights = cut_lineage(user_item_weights(df, self.weight_mode, self.last_days, self.min_ratio))
        with passing():
            similar = similar_items(bm25_weights(weights, self.K1, self.B), self.K)
            similar = stored(similar, outer=True)[0]
        self.state = {"weights": weights, "similar": similar}
        return self

    def recommend(self, users: DataFrame, n: int | None = MAX_PREDICTIONS) -> DataFrame:
        rows = self.state["weights"].where(F.col("weight") > 0)
        rows = rows.join(users.select("uid").distinct(), "uid", "left_semi")
        # At most K neighbours per item travel as one array.
        lists = packed_lists(self.state["similar"], "item_id", "neighbor", "similarity")
        found = best_of_lists(list_products(rows, lists, "uid", "item_id", n), n, "item_id", "score")
        return found.select(F.col("key").alias("uid"), "item_id", "score", "rank")


class FactorModel(RetrievalModel):
    """Models whose score is an inner product of a user and an item vector."""

    def recommend(self, users: DataFrame, n: int = MAX_PREDICTIONS) -> DataFrame:
        wanted = users.select("uid").distinct()
        queries = self.state["users"].join(wanted, "uid", "left_semi")
        return vector_topk(queries, self.state["items"], n, ["uid"], item_vector="vector")


class ALS(FactorModel):
    """Implicit matrix factorisation with MLlib.

    MLlib takes int ids, so ids are numbered densely first. Confidence is 1 + alpha * weight
    and the penalty is scaled by the number of ratings, so factors are not those of other
    solvers with the same parameters. Entries whose weight was cut to zero say nothing and are
    left out: users and items that have no others get no vector.
    """

    name = "ALS"

    def __init__(
        self,
        factors: int = 128,
        regularization: float = 0.001,
        iterations: int = 15,
        random_state: int = 42,
        alpha: float = 1.0,
        weight_mode: str = "truncated",
        last_days: int = 300,
        min_ratio: float = 50,
    ):
        super().__init__(
            factors=factors,
            regularization=regularization,
            iterations=iterations,
            random_state=random_state,
            alpha=alpha,
            weight_mode=weight_mode,
            last_days=last_days,
            min_ratio=min_ratio,
        )

    def fit(self, df: DataFrame) -> ALS:
        weights = user_item_weights(df, self.weight_mode, self.last_days, self.min_ratio)
        weights = cut_lineage(weights.where(F.col("weight") > 0))
        if weights.isEmpty():
            none = F.array().cast("array<float>").alias("vector")
            self.state = {"users": weights.select("uid", none), "items": weights.select("item_id", none)}
            return self
        users, items = (cut_lineage(m) for m in id_maps(weights))
        ratings = map_with_id_maps(weights, users, items).select(
            F.col("uid").cast("int").alias("user"),
            F.col("item_id").cast("int").alias("item"),
            F.col("weight").cast("float").alias("rating"),
        )
        solver = ImplicitALS(
            rank=self.factors,
            regParam=self.regularization,
            maxIter=self.iterations,
            seed=self.random_state,
            alpha=self.alpha,
            implicitPrefs=True,
            userCol="user",
            itemCol="item",
            ratingCol="rating",
            coldStartStrategy="drop",
            # What an iteration shuffled is kept as long as a later one stems from it.
            checkpointInterval=1,
        )
        with swept(ratings.sparkSession):
            fitted = solver.fit(ratings)
        vector = F.col("features").alias("vector")
        self.state = {
            "users": cut_lineage(
                fitted.userFactors.join(users, F.col("id") == F.col("uid_index")).select(
                    "uid", vector
                )
            ),
            "items": cut_lineage(
                fitted.itemFactors.join(items, F.col("id") == F.col("item_index")).select(
                    "item_id", vector
                )
            ),
        }
        return self


def _start_factors(ids: DataFrame, key: str, factors: int, seed: int, last: float | None):
    """Small repeatable vectors in (-0.5, 0.5) / factors; ``last`` is appended when given."""
    def cell(i: Column) -> Column:
        bits = F.pmod(F.xxhash64(F.lit(seed), F.lit(key), F.col(key), i), F.lit(1 << 20))
        return (bits / float(1 << 20) - 0.5) / factors

    vector = F.transform(F.sequence(F.lit(1), F.lit(factors)), cell)
    if last is not None:
        vector = F.concat(vector, F.array(F.lit(last)))
    return ids.select(key, vector.alias("vector"))


# Draws of a block of users, whose vectors and those of the items drawn a task holds; and the least
# where there are more task slots than blocks.
BLOCK_DRAWS = 1 << 17
LEAST_DRAWS = 1 << 12
# Draws whose gradients are made at once.
DRAWS_AT_ONCE = 1 << 13


def batch_gradients(
    users: np.ndarray, items: np.ndarray, user: np.ndarray, item: np.ndarray, other: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Summed gradients of draws (row numbers) and the draws of each vector: of users, of items."""
    up, down = np.zeros_like(users), np.zeros_like(items)

    def add(sums: np.ndarray, at: np.ndarray, parts: np.ndarray) -> None:
        order = np.argsort(at, kind="stable")
        at = at[order]
        firsts = np.flatnonzero(np.append(True, np.diff(at) != 0))
        sums[at[firsts]] += np.add.reduceat(parts[order], firsts)

    for start in range(0, len(user), DRAWS_AT_ONCE):
        u, i, j = (c[start : start + DRAWS_AT_ONCE] for c in (user, item, other))
        own, off = users[u], items[i] - items[j]
        # An overflow to infinity makes the slope 0, as it should be.
        with np.errstate(over="ignore"):
            slope = (1.0 / (1.0 + np.exp(np.einsum("df,df->d", own, off))))[:, None]
        add(up, u, slope * off)
        own *= slope
        add(down, np.append(i, j), np.append(own, -own, axis=0))
    counts = np.bincount(user, minlength=len(users))
    return up, counts, down, np.bincount(np.append(item, other), minlength=len(items))


class BPR(FactorModel):
    """Bayesian personalised ranking: heard items should score above unheard ones.

    An epoch pairs every heard (uid, item) with one item drawn by hash, drops draws the user
    has heard, and deals the draws by hash to mini-batches. A batch applies its whole summed
    gradients: users meet the items they draw in blocks, sums of an item's gradients leave them.
    There are as many batches as it takes for no vector to be in more than about
    ``batch_draws`` draws of one, so the number grows with the most popular item or the
    longest history; a batch of too many draws of one vector overshoots. Items carry a bias as
    a last vector entry, which meets a constant 1 in the user vector.
    """

    name = "BPR"

    def __init__(
        self,
        factors: int = 64,
        learning_rate: float = 0.1,
        regularization: float = 0.01,
        iterations: int = 20,
        random_state: int = 42,
        batch_draws: int = 128,
        weight_mode: str = "truncated",
        last_days: int = 300,
        min_ratio: float = 50,
    ):
        super().__init__(
            factors=factors,
            learning_rate=learning_rate,
            regularization=regularization,
            iterations=iterations,
            random_state=random_state,
            batch_draws=batch_draws,
            weight_mode=weight_mode,
            last_days=last_days,
            min_ratio=min_ratio,
        )

    def _batches(self, heard: DataFrame) -> int:
        """Mini-batches of an epoch; an item is drawn as ``other`` as often as the mean item."""
        per_item = heard.groupBy("item_id").agg(F.count(F.lit(1)).alias("_n"))
        per_user = heard.groupBy("uid").agg(F.count(F.lit(1)).alias("_n"))
        most = per_item.agg((F.max("_n") + F.avg("_n")).alias("_n")).unionByName(
            per_user.agg(F.max("_n").cast("double").alias("_n"))
        )
        return max(1, math.ceil((most.agg(F.max("_n")).first()[0] or 0) / self.batch_draws))

    def _draws(self, heard: DataFrame, items: DataFrame, epoch: int, batches: int) -> DataFrame:
        """(uid, item_id, other, batch): one unheard item per heard pair."""
        n_items = items.agg(F.count(F.lit(1))).scalar()
        drawn = F.pmod(F.xxhash64(F.lit(self.random_state), F.lit(epoch), "uid", "item_id"), n_items)
        other = items.select(F.col("item_id").alias("other"), "item_index")
        pairs = heard.withColumn("item_index", drawn).join(other, "item_index").drop("item_index")
        known = heard.select("uid", F.col("item_id").alias("other"))
        batch = F.pmod(
            F.xxhash64(F.lit(self.random_state), F.lit(epoch), F.lit("batch"), "uid", "item_id"),
            F.lit(batches),
        )
        return pairs.join(known, ["uid", "other"], "left_anti").select(
            "uid", "item_id", "other", batch.alias("batch")
        )

    def _step(self, factors: DataFrame, parts: DataFrame, key: str, fixed: bool) -> DataFrame:
        """Move each vector along its summed gradient, one step for each of its draws: each row of
        ``parts`` is one, or ``_n``."""
        total = vector_to_array(Summarizer.sum(array_to_vector(F.col("_g"))))
        n = F.sum("_n") if "_n" in parts.columns else F.count(F.lit(1))
        sums = parts.groupBy(key).agg(total.alias("_g"), n.alias("_n"))
        rate, reg = self.learning_rate, self.regularization

        def moved(x: Column, g: Column) -> Column:
            return x + rate * (g - F.col("_n") * reg * x)

        stepped = F.zip_with("vector", "_g", moved)
        if fixed:
            # The last entry of a user vector is the constant that meets the item bias.
            stepped = F.concat(F.slice(stepped, 1, self.factors), F.array(F.lit(1.0)))
        vector = F.when(F.col("_g").isNull(), F.col("vector")).otherwise(stepped)
        return factors.join(sums, key, "left").select(key, vector.alias("vector"))

    def _moved(
        self, draws: DataFrame, users: DataFrame, items: DataFrame, count: int
    ) -> tuple[DataFrame, DataFrame, list[str]]:
        """(users, items) after one batch of about ``count`` draws, and the folders they are in.

        Users are dealt to blocks; an item's vector travels once to each block that draws it, and a
        block's gradients of an item leave it as one sum.
        """
        slots = users.sparkSession.sparkContext.defaultParallelism
        blocks = max(1, -(-count // BLOCK_DRAWS), min(slots, -(-count // LEAST_DRAWS)))
        block = F.pmod(F.xxhash64(F.lit("block"), "uid"), F.lit(blocks)).alias("block")
        none = F.lit(None).cast("long")
        draws = draws.where(F.col("uid").isNotNull() & F.col("item_id").isNotNull())
        met = draws.select(block, F.explode(F.array("item_id", "other")).alias("item_id")).distinct()
        rows = (
            users.select(
                block, F.lit(0).alias("kind"), F.col("uid").alias("id"), none.alias("item"),
                none.alias("other"), "vector",
            )
            .unionByName(
                met.join(items, "item_id").select(
                    "block", F.lit(1).alias("kind"), F.col("item_id").alias("id"), none.alias("item"),
                    none.alias("other"), "vector",
                )
            )
            .unionByName(
                draws.select(
                    block, F.lit(2).alias("kind"), F.col("uid").alias("id"), F.col("item_id").alias("item"),
                    "other", F.lit(None).cast("array<double>").alias("vector"),
                )
            )
        )
        size, rate, reg = self.factors + 1, self.learning_rate, self.regularization

        def train(table: pa.Table) -> pa.Table:
            kinds = table.column("kind").to_numpy()
            parts = [table.filter(pa.array(kinds == kind)).combine_chunks() for kind in range(3)]
            # An unknown user has no draws, but keeps a vector.
            names = [p.column("id").combine_chunks().fill_null(NULL_ID).to_numpy() for p in parts[:2]]
            own, theirs = (
                p.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, size)
                if len(n) else np.empty((0, size))
                for p, n in zip(parts, names)
            )
            order = [np.argsort(n, kind="stable") for n in names]
            drawn = [
                o[np.searchsorted(n, parts[2].column(c).to_numpy(), sorter=o)]
                for c, n, o in zip(("id", "item", "other"), [names[0], *[names[1]] * 2], [order[0], *[order[1]] * 2])
            ] if parts[2].num_rows else [np.empty(0, np.int64)] * 3
            up, counts, down, met_ = batch_gradients(own, theirs, *drawn)
            moved = own + rate * (up - counts[:, None] * reg * own)
            moved[:, -1] = own[:, -1]
            ids = np.concatenate(names)
            offsets = pa.array(np.arange(len(ids) + 1, dtype=np.int32) * size)
            return pa.table(
                {
                    "kind": pa.array(np.repeat([0, 1], [len(n) for n in names]).astype(np.int32)),
                    "id": pa.array(ids, mask=ids == NULL_ID),
                    "_n": pa.array(np.append(counts, met_)),
                    "vector": pa.ListArray.from_arrays(offsets, pa.array(np.append(moved, down, axis=0).ravel())),
                }
            )

        made, of_users = stored(
            rows.groupBy("block").applyInArrow(train, "kind int, id long, _n long, vector array<double>")
        )
        sums = made.where("kind = 1").select(F.col("id").alias("item_id"), "_n", F.col("vector").alias("_g"))
        items, of_items = stored(self._step(items, sums, "item_id", False))
        return made.where("kind = 0").select(F.col("id").alias("uid"), "vector"), items, [of_users, of_items]

    def fit(self, df: DataFrame) -> BPR:
        weights = user_item_weights(df, self.weight_mode, self.last_days, self.min_ratio)
        heard = cut_lineage(weights.select("uid", "item_id"))
        numbered = cut_lineage(id_map(heard, "item_id", "item_index"))
        seed, size = self.random_state, self.factors
        users = _start_factors(heard.select("uid").distinct(), "uid", size, seed, 1.0)
        items = _start_factors(numbered.select("item_id"), "item_id", size, seed, 0.0)
        (users, of_users), (items, of_items) = stored(users), stored(items)
        batches, last = self._batches(heard), [of_users, of_items]
        count = -(-heard.count() // batches)
        for epoch in range(self.iterations):
            draws, of_draws = stored(self._draws(heard, numbered, epoch, batches))
            for batch in range(batches):
                part = draws.where(F.col("batch") == batch)
                users, items, made = self._moved(part, users, items, count)
                # Of all batches' vectors only the last are read again.
                for folder in last:
                    drop(folder)
                last = made
            drop(of_draws)
        self.state = {"users": users, "items": items}
        return self
