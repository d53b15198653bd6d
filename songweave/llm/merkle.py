"""Merkle manifest of a table: a tree of digests for every key, their roots in one more tree.

Every row is a leaf, the SHA-256 of its fields, each written as its length, a colon and its
value. The leaves of one key, in order, are reduced in runs of ``FANOUT`` until one node is
left; the same is done to those nodes over all keys. Digests are hex text throughout.

Only every ``EVERY``-th level is stored. Between two stored levels lie aligned subtrees of at
most ``SPAN`` stored nodes: one row of a grouped table holds them. A proof is made from the top
down; each subtree's missing nodes are computed again from the stored ones below, give their
part of the proofs of those, and are gone with the row. All of it is Spark expressions.

Leaves get their places by a range sort and a prefix sum over (task, key) counts, so one key may
hold all rows. Rows equal in key, order and digest are told apart by a serial number for the
sort alone: which of them stands first changes nothing.

Edge cases: null fields are written as ``-`` and differ from empty ones; null keys form a tree
of their own, the first; null order values come first, ties go by digest; repeated rows are
leaves of their own; a key of one row has its leaf as its tree's root and an empty proof within
it; an empty table gives no rows and a null root. Texts of any length are digested whole.
Columns that are not named are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from songweave.llm.common import store

FANOUT = 8
EVERY = 3
SPAN = FANOUT**EVERY
# monotonically_increasing_id: the row's place in its task is below this bit.
PLACE_BITS = (1 << 33) - 1


def field(value: Column | str) -> Column:
    """A value as length in bytes, colon and text; ``-`` if null."""
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column | str) -> Column:
    """The digest of a row's fields."""
    return F.sha2(F.concat(*map(field, values)), 256)


def _above(nodes: Column) -> Column:
    """The digests of runs of an array of nodes."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FANOUT).cast("int"))
    return F.transform(
        runs, lambda i: F.sha2(F.array_join(F.slice(nodes, i * FANOUT + 1, FANOUT), ""), 256)
    )


def _height(nodes: Column) -> Column:
    """Levels between a stored one of ``nodes`` nodes in its tree and the next: fewer at the top."""
    height = F.lit(EVERY)
    for levels in range(EVERY - 1, -1, -1):
        height = F.when(nodes <= FANOUT**levels, levels).otherwise(height)
    return height


def _step(nodes: Column, at: Column) -> Column:
    """What stands before and after node ``at`` in its run."""
    place = at % FANOUT
    return F.struct(
        F.array_join(F.slice(nodes, at - place + 1, place), "").alias("before"),
        F.array_join(F.slice(nodes, at + 2, FANOUT - 1 - place), "").alias("after"),
    )


def _subtrees(level: DataFrame, *carried: str) -> DataFrame:
    """(tree, block, nodes, rows, level0 .. level<EVERY>) of every aligned subtree; ``rows``
    are its stored nodes in order, with their carried columns."""
    grouped = level.groupBy("tree", F.floor(F.col("pos") / SPAN).alias("block")).agg(
        F.first("nodes").alias("nodes"),
        F.sort_array(F.collect_list(F.struct("pos", "node", *carried))).alias("rows"),
    )
    found = grouped.withColumn("level0", F.col("rows.node"))
    for j in range(EVERY):
        found = found.withColumn(f"level{j + 1}", _above(F.col(f"level{j}")))
    return found


@dataclass
class Forest:
    """Trees over the leaves of every key: their stored levels, the lowest first."""

    levels: list[DataFrame]  # tree, pos, node, nodes (of the tree's level); leaves carry more
    carried: list[str]
    tops: DataFrame  # tree, node


@dataclass
class Manifest:
    trees: Forest
    over: Forest  # the tree of the trees' roots
    root: str | None


def _numbered(leaves: DataFrame, order: list[str]) -> DataFrame:
    """Leaves with their place ``pos`` in their tree and its number of leaves, ``nodes``."""
    keys = ["tree", *order, "node", "serial"]
    dealt = (
        leaves.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumns(
            {
                "task": F.spark_partition_id(),
                "at": F.monotonically_increasing_id().bitwiseAND(F.lit(PLACE_BITS)),
            }
        )
        .drop("serial")
    )
    dealt = store(dealt)
    # One row for every tree in every task; a tree's rows in a task follow each other.
    tree = Window.partitionBy("tree")
    earlier = F.sum("n").over(tree.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    spans = (
        dealt.groupBy("tree", "task")
        .agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
        .select(
            F.col("tree").alias("t"),
            F.col("task").alias("k"),
            (F.coalesce(earlier, F.lit(0)) - F.col("first")).alias("shift"),
            F.sum("n").over(tree).alias("nodes"),
        )
    )
    same = F.col("tree").eqNullSafe(F.col("t")) & (F.col("task") == F.col("k"))
    return dealt.join(spans, same).select(
        *[c for c in dealt.columns if c not in ("task", "at")],
        (F.col("at") + F.col("shift")).alias("pos"),
        "nodes",
    )


def forest(leaves: DataFrame, order: list[str], carried: list[str]) -> Forest:
    """Trees over ``leaves`` (tree, node, serial, the order columns, carried columns)."""
    levels = [store(_numbered(leaves, order))]
    most = levels[0].agg(F.max("nodes")).first()[0] or 0
    while most > 1:
        height = _height(F.col("nodes"))
        ends = F.array(*[F.col(f"level{j}") for j in range(EVERY + 1)])
        levels.append(
            store(
                _subtrees(levels[-1]).select(
                    "tree",
                    F.col("block").alias("pos"),
                    ends[height][0].alias("node"),
                    F.ceil(F.col("nodes") / SPAN).alias("nodes"),
                )
            )
        )
        most = -(-most // SPAN)
    return Forest(levels, carried, levels[-1].select("tree", "node"))


def build(rows: DataFrame, leaf: Column, tree: str, order: list[str], **carried: Column) -> Manifest:
    """The manifest of ``rows``: a leaf each, trees by column ``tree``, leaves by ``order``.

    ``carried`` are further columns that proofs come with. Rows are read once.
    """
    names = [f"order{j}" for j in range(len(order))]
    leaves = store(
        rows.select(
            F.col(tree).alias("tree"),
            leaf.alias("node"),
            F.monotonically_increasing_id().alias("serial"),
            *[F.col(c).alias(n) for c, n in zip(order, names)],
            *[c.alias(f"with_{n}") for n, c in carried.items()],
        )
    )
    trees = forest(leaves, names, [f"with_{n}" for n in carried])
    roots = trees.tops.select(
        F.lit(0).alias("tree"), "node", F.lit(0).alias("serial"), F.col("tree").alias("key")
    )
    over = forest(roots, ["key"], ["key"])
    top = over.tops.first()
    return Manifest(trees, over, top and top["node"])


def _proven(level: DataFrame, above: DataFrame | None, *carried: str) -> DataFrame:
    """(tree, pos, node, carried, proof) of stored nodes: the steps within their subtree, which
    is computed anew, then those of ``above``, the proofs of the subtrees' tops."""
    found = _subtrees(level, *carried)
    if above is None:
        found = found.withColumn("rest", F.expr("array()").cast("array<struct<before:string,after:string>>"))
    else:
        above = above.select(
            F.col("tree").alias("t"), F.col("pos").alias("p"), F.col("proof").alias("rest")
        )
        found = found.join(above, F.col("tree").eqNullSafe(F.col("t")) & (F.col("block") == F.col("p")))
    found = found.withColumn("height", _height(F.col("nodes")))

    def proof(row: Column) -> Column:
        at = F.pmod(row["pos"], F.lit(SPAN)).cast("int")
        steps = [
            _step(F.col(f"level{j}"), F.floor(at / FANOUT**j).cast("int")) for j in range(EVERY)
        ]
        own = F.slice(F.array(*steps), F.lit(1), F.col("height"))
        return F.struct(row.alias("row"), F.concat(own, F.col("rest")).alias("proof"))

    return found.select("tree", F.explode(F.transform("rows", proof)).alias("found")).select(
        "tree", "found.row.*", "found.proof"
    )


def _all_proven(trees: Forest, above: DataFrame | None, wanted: Column | None = None) -> DataFrame:
    for level in trees.levels[:0:-1]:
        above = store(_proven(level, above))
    leaves = trees.levels[0]
    if wanted is None:
        return _proven(leaves, above, *trees.carried)
    block = F.floor(F.col("pos") / SPAN)
    blocks = leaves.where(wanted).select(F.col("tree").alias("t"), block.alias("b")).distinct()
    leaves = leaves.join(
        blocks, F.col("tree").eqNullSafe(F.col("t")) & (block == F.col("b")), "left_semi"
    )
    return _proven(leaves, above, *trees.carried).where(wanted)


def proofs(manifest: Manifest, wanted: Column | None = None) -> DataFrame:
    """(tree, pos, leaf, subroot, the carried columns, proof) of every leaf, or of those that
    ``wanted``, a condition on ``with_<carried>`` columns, picks: only their subtrees are made
    again. ``proof`` has (before, after), the siblings' digests, for each level up to the root."""
    over = store(_all_proven(manifest.over, None).select(F.col("key").alias("tree"), "node", "proof"))
    above = over.select("tree", F.lit(0).alias("pos"), "proof")
    found = _all_proven(manifest.trees, above, wanted)
    roots = over.select(F.col("tree").alias("t"), F.col("node").alias("subroot"))
    return found.join(roots, F.col("tree").eqNullSafe(F.col("t"))).select(
        "tree",
        "pos",
        F.col("node").alias("leaf"),
        "subroot",
        *[F.col(c).alias(c.removeprefix("with_")) for c in manifest.trees.carried],
        "proof",
    )


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(
        proof, leaf, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256)
    )


def siblings(proof: Column) -> Column:
    """A proof's digests, one after the other."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), "")


#: A to Z to lower case; other characters, of any alphabet, stay.
UPPER, LOWER = ("".join(map(chr, range(ord(c), ord(c) + 26))) for c in "Aa")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)
