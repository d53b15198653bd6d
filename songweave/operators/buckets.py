"""Nearest vectors by inner product without meeting the whole catalogue.

``lsh_topk`` is approximate: vectors fall into buckets by the signs of random projections, and a
query looks into the buckets that its signs, and near misses of them, name. ``cell_topk`` is
exact: items belong to cells around centroids, and a query leaves out the cells that can't reach
the score it has already.

Both deal buckets to tasks in slices of bounded size on either side, so a bucket may hold any
share of the rows, and both score every candidate exactly. Nothing but each query's best of a
slice leaves a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from songweave.operators.similarity import _cell
from songweave.session import cut_lineage

# Expected rows of a slice of a bucket.
SLICE = 8192
# Items that centroids are chosen from: the most that the driver sees.
SAMPLE = 4096
ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1)


def _usable(df: DataFrame, vector: str, *kept: str) -> DataFrame:
    """Rows with a vector in ``_vector``. Singles travel as they are and become doubles in tasks."""
    single = df.schema[vector].dataType.simpleString() == "array<float>"
    values = F.col(vector) if single else F.col(vector).cast("array<double>")
    return df.where(F.col(vector).isNotNull()).select(*kept, values.alias("_vector"))


def _with_list(df: DataFrame, name: str, kind: str, found) -> DataFrame:
    """``df`` and a list column that ``found`` makes of each batch."""
    schema = ", ".join([*(f"`{c}` {t}" for c, t in df.dtypes), f"`{name}` array<{kind}>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.append_column(name, found(batch))

    return df.mapInArrow(run, schema)


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _searched(queries: DataFrame, catalogue: DataFrame, keys: list[str], item: str) -> DataFrame:
    """(keys, item, score): each query's best ``_k`` of every bucket slice it looks into.

    Both sides have ``_vector`` and ``_bucket``, one row for each bucket they are in.
    """

    def slices(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("_bucket").agg(F.ceil(F.count(F.lit(1)) / SLICE).cast("int").alias(name))

    counts = slices(queries, "_nq").join(slices(catalogue, "_nc"), "_bucket")

    def dealt(df: DataFrame, on: list[str], own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64(*on), F.col(f"_n{own}")).cast("int").alias(f"_s{own}")
        met = F.explode(F.sequence(F.lit(0), F.col(f"_n{other}") - 1)).alias(f"_s{other}")
        return df.join(counts, "_bucket").select(*df.columns, mine, met)

    types = dict(queries.dtypes)
    id_type = dict(catalogue.dtypes)[item]
    ddl = ", ".join([*(f"`{c}` {types[c]}" for c in keys), f"`{item}` {id_type}", "score double"])
    schema = pa.schema(
        [*((c, ARROW[types[c]]) for c in keys), (item, ARROW[id_type]), ("score", pa.float64())]
    )
    cell = ["_bucket", "_sq", "_sc"]
    left = dealt(queries, keys, "q", "c").groupBy(*cell)
    right = dealt(catalogue, [item], "c", "q").groupBy(*cell)
    return left.cogroup(right).applyInArrow(_cell(keys, item, schema), ddl)


def _best(found: DataFrame, k: int, keys: list[str], item: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc(item))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


# --------------------------------------------------------------------------- sign hashing


def sign_buckets(
    vectors: np.ndarray, planes: np.ndarray, probes: int
) -> tuple[np.ndarray, np.ndarray]:
    """(tables, buckets) of each row: in every table, its own bucket and the ``probes`` - 1 whose
    signs cost least to change, by the squares of the projections that would change sign."""
    tables, bits, _ = planes.shape
    powers = 1 << np.arange(bits)
    flips = np.arange(1 << bits)
    change = (flips[:, None] >> np.arange(bits)) & 1
    out = []
    for plane in planes:
        shown = vectors @ plane.T
        own = (shown > 0) @ powers
        cost = (shown * shown) @ change.T
        nearest = np.argsort(cost, axis=1, kind="stable")[:, : min(probes, 1 << bits)]
        out.append(own[:, None] ^ flips[nearest])
    found = np.stack(out, 1)
    names = np.broadcast_to(np.arange(tables)[None, :, None], found.shape)
    return names.reshape(len(vectors), -1), found.reshape(len(vectors), -1)


def lsh_topk(
    queries: DataFrame,
    catalogue: DataFrame,
    k: int,
    keys: list[str],
    query_vector: str = "vector",
    item: str = "item_id",
    item_vector: str = "normalized_embed",
    tables: int = 4,
    bits: int = 6,
    probes: int = 16,
    seed: int = 42,
) -> DataFrame:
    """About the ``k`` items with the largest inner product per query, for vectors of like
    length: (keys..., item_id, score, rank).

    An item is in one bucket of each table; a query looks into ``probes`` of them. More tables
    and probes find more, more bits make buckets smaller.
    """
    left = _usable(queries, query_vector, *keys).withColumn("_k", F.lit(k).cast("int"))
    right = _usable(catalogue, item_vector, item)
    first = right.select(F.size("_vector").alias("n")).first()
    if first is None:
        left = left.limit(0)
    planes = np.random.default_rng(seed).normal(size=(tables, bits, first["n"] if first else 1))

    def bucketed(df: DataFrame, looks: int) -> DataFrame:
        def found(batch: pa.RecordBatch) -> pa.Array:
            table, bucket = sign_buckets(_vectors(batch.column("_vector")), planes, looks)
            named = (table << bits) + bucket
            return _lists(named.ravel(), np.full(len(named), named.shape[1]), pa.int64())

        wide = _with_list(df, "_buckets", "bigint", found)
        return wide.select(*df.columns, F.explode("_buckets").alias("_bucket"))

    found = _searched(bucketed(left, probes), bucketed(right, 1), keys, item)
    return _best(found.dropDuplicates([*keys, item]), k, keys, item)


# --------------------------------------------------------------------------- cells


def spread_centroids(points: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Centroids of about ``count`` groups of a sample, by a few rounds of nearest means."""
    order = np.random.default_rng(0).permutation(len(points))
    middle = points[order[: min(count, len(points))]]
    for _ in range(rounds):
        off = (points * points).sum(1)[:, None] - 2 * points @ middle.T + (middle * middle).sum(1)
        owner = off.argmin(1)
        sums = np.zeros_like(middle)
        np.add.at(sums, owner, points)
        sizes = np.bincount(owner, minlength=len(middle))
        middle = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], middle)
    return middle


class Cells:
    """Centroids, and the radius of the items around each."""

    def __init__(self, middle: np.ndarray, radius: np.ndarray):
        self.middle, self.radius = middle, radius

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's cell and distance from its centroid."""
        off = -2 * vectors @ self.middle.T + (self.middle * self.middle).sum(1)
        owner = off.argmin(1)
        return owner, np.linalg.norm(vectors - self.middle[owner], axis=1)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The most that an inner product with any item of a cell can be, rounding included."""
        length = np.linalg.norm(queries, axis=1, keepdims=True)
        slack = 1e-9 * length * (np.linalg.norm(self.middle, axis=1) + self.radius)
        found = queries @ self.middle.T + length * self.radius + slack
        return np.where(self.radius < 0, -np.inf, found)


def _in_cells(items: DataFrame, cells: Cells) -> DataFrame:
    """Items with their cell as ``_bucket`` and their distance from its centroid as ``_far``."""

    def found(batch: pa.RecordBatch) -> pa.Array:
        owner, far = cells.nearest(_vectors(batch.column("_vector")))
        both = np.stack([owner.astype(float), far], 1)
        return _lists(both.ravel(), np.full(len(owner), 2), pa.float64())

    wide = _with_list(items, "_at", "double", found)
    return wide.select(
        *items.columns, F.col("_at")[0].cast("long").alias("_bucket"), F.col("_at")[1].alias("_far")
    )


def cell_topk(
    queries: DataFrame,
    catalogue: DataFrame,
    k: int,
    keys: list[str],
    query_vector: str = "vector",
    item: str = "item_id",
    item_vector: str = "normalized_embed",
    cells: int = 64,
) -> DataFrame:
    """The ``k`` items with the largest inner product per query, exactly: (keys..., item_id,
    score, rank).

    First every query meets the cell with the largest bound, which gives it a score to beat;
    then all others whose bound reaches that. Centroids come from a bounded sample and decide
    about cost alone; radii cover all items.
    """
    left = cut_lineage(_usable(queries, query_vector, *keys).withColumn("_k", F.lit(k).cast("int")))
    right = _usable(catalogue, item_vector, item)
    sample = right.orderBy(F.xxhash64(item), item).limit(SAMPLE).select("_vector").collect()
    if not sample:
        left = left.limit(0)
    points = np.array([r["_vector"] for r in sample], float) if sample else np.zeros((1, 1))
    found = Cells(spread_centroids(points, cells), np.empty(0))
    placed = cut_lineage(_in_cells(right, found))
    radius = np.full(len(found.middle), -1.0)
    # A row for every cell: at most ``cells``.
    for row in placed.groupBy("_bucket").agg(F.max("_far").alias("far")).collect():
        radius[row["_bucket"]] = row["far"]
    known = Cells(found.middle, radius)
    items = placed.drop("_far")

    def home(batch: pa.RecordBatch) -> pa.Array:
        best = known.bounds(_vectors(batch.column("_vector"))).argmax(1)
        return _lists(best, np.ones(len(best), int), pa.int64())

    def others(batch: pa.RecordBatch) -> pa.Array:
        bounds = known.bounds(_vectors(batch.column("_vector")))
        beat = batch.column("_beat").to_numpy(zero_copy_only=False)
        bounds[np.arange(len(bounds)), bounds.argmax(1)] = -np.inf
        open_ = (bounds >= np.where(np.isnan(beat), -np.inf, beat)[:, None]) & np.isfinite(bounds)
        return _lists(np.nonzero(open_)[1], open_.sum(1), pa.int64())

    def looking(df: DataFrame, where) -> DataFrame:
        wide = _with_list(df, "_buckets", "bigint", where)
        return wide.select(*left.columns, F.explode("_buckets").alias("_bucket"))

    first = cut_lineage(_searched(looking(left, home), items, keys, item))
    least = (
        _best(first, k, keys, item)
        .groupBy(*keys)
        .agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("_beat"))
    )
    # Scores are rounded where they are compared.
    asked = left.join(least, keys, "left").withColumn("_beat", F.col("_beat") - 1e-11)
    second = _searched(looking(asked, others), items, keys, item)
    return _best(first.unionByName(second), k, keys, item)
