"""Joins and products that stay balanced when a few keys hold most of the rows.

A lookup join (many rows per key on the left, few on the right) is written as a plain join:
adaptive execution, which the session turns on with ``forceOptimizeSkewedJoin``, splits the
left partitions that turn out too large and repeats the matching right ones. That costs no
extra pass. Where the key counts are at hand anyway, ``salted_join`` splits hot keys in the
plan itself. ``product_sum`` bounds what one key can cost when both sides are long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A key is hot when it holds more than this share of the rows, so there can be at most
# 1 / HOT_SHARE of them: that is the proven bound on the broadcast key table.
HOT_SHARE = 1.0 / 512
# Below this many rows a key is no burden for one task, whatever its share.
HOT_ROWS = 1_000_000
# Largest slice of one key's entries that meets another slice in a product.
CHUNK = 2048


def hot_keys(
    counts: DataFrame,
    on: list[str],
    rows: str,
    share: float = HOT_SHARE,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Keys holding more than ``share`` of all rows, with the number of salts they need.

    ``counts`` has one row per key with its count in ``rows``. The result has at most
    ``1 / share`` rows and at most ``2 / share`` salts in sum.
    """
    total = counts.agg(F.sum(rows)).scalar()
    limit = F.greatest(F.lit(min_rows).cast("double"), total * F.lit(share))
    return counts.where(F.col(rows) > limit).select(
        *on, F.ceil(F.col(rows) / limit).cast("int").alias("_salts")
    )


def salted_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str, hot: DataFrame
) -> DataFrame:
    """Equi-join of a many-rows-per-key left side with a few-rows-per-key right side.

    Rows of hot keys are spread over salts on the left and repeated once per salt on the
    right. The result equals the plain join; ``how`` is inner, left, left_semi or left_anti.
    """
    hot = F.broadcast(hot)
    spread = [c for c in left.columns if c not in on] or list(on)
    salts = F.coalesce("_salts", F.lit(1))
    salted_left = (
        left.join(hot, on, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*spread), salts).cast("int"))
        .drop("_salts")
    )
    salted_right = (
        right.join(hot, on, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("_salts")
    )
    joined = salted_left.join(salted_right, [*on, "_salt"], how)
    right_only = [c for c in right.columns if c not in on]
    kept = left.columns if how in ("left_semi", "left_anti") else left.columns + right_only
    return joined.select(*kept)


def product_sum(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_id: str,
    right_id: str,
    value: str = "value",
    chunk: int = CHUNK,
    where: Column | None = None,
) -> DataFrame:
    """Sparse matrix product: sum over ``key`` of left(key, left_id) * right(key, right_id).

    Both inputs have one row per cell and a ``weight`` column. Products stream from the join
    straight into the map-side partial sum, so single pairs never reach a shuffle. A long key
    is cut into slices of about ``chunk`` entries on both sides and every pair of slices is
    its own join key, which bounds the work of one key's task by chunk². ``where`` picks cells of
    the product, by their ids ``_i`` and ``_j``.
    """
    # Slices per key and side; keys that one side lacks produce nothing.
    chunks = (
        left.select(key, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
        .unionByName(right.select(key, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
        .groupBy(key)
        .agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
        .where("_l > 0 and _r > 0")
        .select(
            key,
            F.ceil(F.col("_l") / chunk).cast("int").alias("_na"),
            F.ceil(F.col("_r") / chunk).cast("int").alias("_nb"),
        )
    )

    def sliced(df: DataFrame, id_: str, name: str, own: str, other: str) -> DataFrame:
        entries = df.select(key, F.col(id_).alias(name), F.col("weight").alias(f"{name}w"))
        mine = F.pmod(F.xxhash64(name), F.col(f"_n{own}")).cast("int").alias(own)
        met = F.explode(F.sequence(F.lit(0), F.col(f"_n{other}") - 1)).alias(other)
        return entries.join(chunks, key).select(key, name, f"{name}w", mine, met)

    pairs = sliced(left, left_id, "_i", "a", "b").join(
        sliced(right, right_id, "_j", "b", "a"), [key, "a", "b"]
    )
    if where is not None:
        pairs = pairs.where(where)
    return pairs.groupBy(F.col("_i").alias(left_id), F.col("_j").alias(right_id)).agg(
        F.sum(F.col("_iw") * F.col("_jw")).alias(value)
    )


def unit_rows(df: DataFrame, row: str, weight: str = "weight") -> DataFrame:
    """Scale ``weight`` so that each row of the sparse matrix has length one.

    A row holds at most one entry per column id, so the window is bounded by the catalogue.
    All-zero rows stay zero.
    """
    length = F.sqrt(F.sum(F.col(weight) * F.col(weight)).over(Window.partitionBy(row)))
    return df.withColumn(weight, F.when(length > 0, F.col(weight) / length).otherwise(F.lit(0.0)))
