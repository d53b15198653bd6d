"""Exact top-k search by inner product over a table of pivot distances.

1. Every component becomes an integer. In a block of vectors whose longest has length M, a
   vector v gets one more coordinate, sqrt(M² - v²), and a query q a zero: then
   |q - v|² = q² + M² - 2 qv, so the largest products are the least distances.
2. Pivots are vectors of a bounded sample, far from each other. Vectors are dealt to cells by
   the pivot they point to most, cells are cut into blocks of bounded size, and each block keeps
   its vectors' distances to all pivots, and the least and largest of each.
3. The triangle inequality bounds a distance from below by every pivot; the largest of these
   bounds counts. A first round asks one block of a query's own cell, which gives every query a
   score to beat. A second one leaves out all blocks whose ranges of pivot distances rule them
   out, and walks the rest: candidates come in the order of their bounds, and the walk stops
   where a bound is below the k-th score found.

The sample decides about cost only. Bounds carry a margin for rounding; scores are integers and
exact. Queries travel in chunks of bounded size, blocks are read once per chunk that needs them.

Edge cases: vectors that are null, empty or hold null or non-finite components take no part,
nor do those with a component of 2 ** 54 or more; vectors of different lengths never meet; rows
with a null id take no part; rows that repeat an id count once, with the first vector in array
order; a query is never its own answer; ties go to smaller ids; fewer candidates give fewer
answers; scores beyond a long are held at its ends. Empty tables give no rows. Other columns are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from songweave.llm.common import small_batches, store

SCALE = 256
LARGEST = float(2**54)
SAMPLE_ROWS = 2048  # vectors that pivots are chosen from: the most that the driver sees
PIVOTS = 32
BLOCK_ROWS = 2048  # expected vectors of a block
CHUNK_ROWS = 256  # expected queries of a chunk
SUMMARY_ROWS = 1024  # expected blocks whose ranges a chunk is compared with at once
BATCH_ROWS = 4  # rows that hold a block or a chunk, in memory at once
FIRST_STEP = 32  # candidates that a walk looks at first; every step doubles
MARGIN = 1e-9
NONE = -(2**63)

BLOCKS = (
    "dim int, cell int, number long, top double, ids binary, vectors binary, distances binary, "
    "low binary, high binary"
)
CHUNKS = "dim int, cell int, part long, ids binary, vectors binary"
FOUND = "query_id long, vec_id long, score long"


def whole_numbers(vector: Column) -> Column:
    """The integer vector, null where it takes no part."""
    good = F.forall(
        vector, lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST, F.lit(False)) & ~F.isnan(c)
    )
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))
    return F.when((F.size(vector) > 0) & good, x)


def far_apart(vectors: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` vectors, each the farthest from those taken before."""
    points = vectors.astype(np.float64)
    taken = [int(np.argmax((points * points).sum(1)))]
    away = np.full(len(points), np.inf)
    while len(taken) < min(count, len(points)):
        off = points - points[taken[-1]]
        away = np.minimum(away, (off * off).sum(1))
        at = int(np.argmax(away))
        if away[at] <= 0:
            break
        taken.append(at)
    return points[taken]


def flat_squares(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Squared distances to the pivots, without the further coordinate."""
    out = np.empty((len(points), len(pivots)))
    for j, pivot in enumerate(pivots):
        off = points - pivot
        out[:, j] = (off * off).sum(1)
    return out


def pivot_distances(flat: np.ndarray, extra: np.ndarray, pivots: np.ndarray, top: float) -> np.ndarray:
    """Distances to the pivots; ``extra`` is the further coordinate of each point."""
    own = np.sqrt(np.maximum(top - (pivots * pivots).sum(1), 0))
    return np.sqrt(flat + (extra[:, None] - own) ** 2)


def upper_bounds(asked: np.ndarray, lengths: np.ndarray, table: np.ndarray, top: float) -> np.ndarray:
    """Upper bounds of scores: queries by rows of a table of pivot distances."""
    apart = np.zeros((len(asked), len(table)))
    off = np.empty_like(apart)
    for j in range(table.shape[1]):
        np.subtract(asked[:, j, None], table[None, :, j], out=off)
        np.abs(off, out=off)
        np.maximum(apart, off, out=apart)
    return (lengths[:, None] + top - apart * apart) / 2 + MARGIN * (lengths[:, None] + top) + 1


def range_bounds(asked, lengths, low: np.ndarray, high: np.ndarray, top: float) -> np.ndarray:
    """Upper bounds of queries' scores over all vectors with pivot distances in a range."""
    apart = np.maximum(np.maximum(low - asked, asked - high), 0).max(1, initial=0)
    return (lengths + top - apart * apart) / 2 + MARGIN * (lengths + top) + 1


def exact_products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Integer inner products, held at a long's ends."""
    size = np.abs(vectors).max(initial=0).astype(float) * np.abs(query).max(initial=0) * len(query)
    if size < 2**53:
        return (vectors.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    found = vectors.astype(object) @ query.astype(object)
    return np.array([min(max(int(s), NONE), -NONE - 1) for s in found], np.int64)


@dataclass
class Block:
    """A block's row in arrays."""

    ids: np.ndarray
    vectors: np.ndarray
    distances: np.ndarray
    top: float

    @staticmethod
    def of(row: dict) -> Block:
        ids = np.frombuffer(row["ids"], "<i8")
        shape = len(ids), -1
        return Block(
            ids,
            np.frombuffer(row["vectors"], "<i8").reshape(shape),
            np.frombuffer(row["distances"], "<f8").reshape(shape),
            row["top"],
        )


def walk(
    block: Block, pivots: np.ndarray, ids: np.ndarray, queries: np.ndarray, beat: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query numbers, ids, scores) of at most ``k`` best candidates of a block for each query,
    of those that reach its score to beat; and how many products it took."""
    points = queries.astype(np.float64)
    lengths = (points * points).sum(1)
    flat = flat_squares(points, pivots)
    asked = pivot_distances(flat, np.zeros(len(points)), pivots, block.top)
    bounds = upper_bounds(asked, lengths, block.distances, block.top)
    out, looked = [], 0
    for i in range(len(queries)):
        least = int(beat[i])
        open_ = np.flatnonzero((bounds[i] >= least) & (block.ids != ids[i]))
        open_ = open_[np.argsort(-bounds[i][open_], kind="stable")]
        best_ids = best = np.empty(0, np.int64)
        at, step = 0, FIRST_STEP
        while at < len(open_) and bounds[i][open_[at]] >= least:
            part = open_[at : at + step]
            score = exact_products(block.vectors[part], queries[i])
            best_ids, best = np.append(best_ids, block.ids[part]), np.append(best, score)
            order = np.lexsort([best_ids, -1 - best])[:k]
            best_ids, best = best_ids[order], best[order]
            if len(best) == k:
                least = max(least, int(best[-1]))
            at, step = at + step, step * 2
            looked += len(part)
        keep = best >= int(beat[i])
        out.append((np.full(keep.sum(), i), best_ids[keep], best[keep]))
    number, found, score = (np.concatenate(c) for c in zip(*out))
    return number, found, score, looked


# --------------------------------------------------------------------------- Spark


@dataclass
class Index:
    rows: DataFrame  # id, dim, cell, x
    blocks: DataFrame
    pivots: dict[int, np.ndarray]  # by length of the vectors


def _in_cells(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """``rows`` (id, x) with their length and cell: the pivot of the least angle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            dims = batch["x"].map(len).to_numpy(np.int64)
            cells = np.zeros(len(batch), np.int64)
            for dim in np.unique(dims).tolist():
                if dim in pivots:
                    at = np.flatnonzero(dims == dim)
                    found = np.array(batch["x"].iloc[at].tolist(), np.float64) @ _units(pivots[dim]).T
                    cells[at] = found.argmax(1)
            yield pd.DataFrame({"id": batch["id"], "dim": dims, "cell": cells, "x": batch["x"]})

    return rows.mapInPandas(run, "id long, dim int, cell int, x array<long>")


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.sqrt((vectors * vectors).sum(1, keepdims=True)), 1e-300)


def _pivots_of(pivots: dict[int, np.ndarray], dim: int) -> np.ndarray:
    return pivots.get(int(dim), np.empty((0, int(dim))))


def build_index(vectors: DataFrame, id_: str = "vec_id", column: str = "embedding") -> Index:
    """Blocks with their pivot tables, stored."""
    usable = (
        vectors.select(F.col(id_).cast("long").alias("id"), whole_numbers(F.col(column)).alias("x"))
        .where("id is not null and x is not null")
        .groupBy("id")
        .agg(F.min("x").alias("x"))
    )
    usable = store(usable)
    sample = usable.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("x").collect()
    by_dim: dict[int, list] = {}
    for row in sample:
        by_dim.setdefault(len(row["x"]), []).append(row["x"])
    pivots = {dim: far_apart(np.array(x, np.int64), PIVOTS) for dim, x in by_dim.items()}
    rows = store(_in_cells(usable, pivots))
    sizes = rows.groupBy("dim", "cell").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("numbers")
    )

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        x = np.array(pdf["x"].tolist(), np.int64)
        points = x.astype(np.float64)
        squares = (points * points).sum(1)
        top = float(squares.max())
        extra = np.sqrt(np.maximum(top - squares, 0))
        near = _pivots_of(pivots, key[0])
        table = pivot_distances(flat_squares(points, near), extra, near, top)
        arrays = pdf["id"].to_numpy("<i8"), x, table, table.min(0), table.max(0)
        return pd.DataFrame([[*key, top, *[a.tobytes() for a in arrays]]], columns=_names(BLOCKS))

    dealt = rows.join(sizes, ["dim", "cell"]).withColumn(
        "number", F.pmod(F.xxhash64("id"), F.col("numbers"))
    )
    blocks = dealt.groupBy("dim", "cell", "number").applyInPandas(pack, BLOCKS)
    return Index(rows, store(blocks), pivots)


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _chunks(index: Index, is_query: Column) -> DataFrame:
    """Packed queries of one cell."""
    rows = index.rows.where(is_query)
    sizes = rows.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / CHUNK_ROWS).alias("parts"))

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        x = np.array(pdf["x"].tolist(), "<i8")
        ids = pdf["id"].to_numpy("<i8")
        return pd.DataFrame([[*key, ids.tobytes(), x.tobytes()]], columns=_names(CHUNKS))

    dealt = rows.join(sizes, ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    return store(dealt.groupBy("dim", "cell", "part").applyInPandas(pack, CHUNKS))


def _queries(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["query_ids"], "<i8")
    return ids, np.frombuffer(row["queries"], "<i8").reshape(len(ids), -1)


def search(index: Index, is_query: Column, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` best of every row that ``is_query``, a
    condition on ``id``, picks."""
    pivots, rename = index.pivots, {"ids": "query_ids", "vectors": "queries"}
    chunks = _chunks(index, is_query).withColumnsRenamed(rename)

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                ids, queries = _queries(row)
                beat = np.full(len(ids), NONE)
                number, _, score, _ = walk(
                    Block.of(row), _pivots_of(pivots, row["dim"]), ids, queries, beat, k
                )
                # The walk gives at most k a query; the k-th has to be reached by others.
                counts = np.bincount(number, minlength=len(ids))
                least = np.full(len(ids), -NONE - 1)
                np.minimum.at(least, number, score)
                beat = np.where(counts == k, least, NONE)
                yield pd.DataFrame(
                    [[row["dim"], row["cell"], row["part"], beat.astype("<i8").tobytes()]],
                    columns=["dim", "cell", "part", "beat"],
                )

    # One block of the cell that a chunk's queries are in themselves.
    own = chunks.join(index.blocks.where("number = 0"), ["dim", "cell"])
    spark = index.blocks.sparkSession
    with small_batches(spark, BATCH_ROWS):
        beaten = store(own.mapInPandas(first, "dim int, cell int, part long, beat binary"))
    asked = store(chunks.join(beaten, ["dim", "cell", "part"]))

    def rule_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                ids, queries = _queries(row)
                beat, near = np.frombuffer(row["beat"], "<i8"), _pivots_of(pivots, row["dim"])
                points = queries.astype(np.float64)
                lengths, none = (points * points).sum(1), np.zeros(len(points))
                flat, out = flat_squares(points, near), []
                for block in row["ranges"]:
                    low, high = (np.frombuffer(block[c], "<f8") for c in ("low", "high"))
                    at = pivot_distances(flat, none, near, block["top"])
                    bound = range_bounds(at, lengths, low, high, block["top"])
                    open_ = np.flatnonzero(bound >= beat)
                    if len(open_):
                        out.append([block["cell"], block["number"], open_.astype("<i4").tobytes()])
                found = pd.DataFrame(out, columns=["cell", "number", "chosen"])
                yield found.assign(dim=row["dim"], home=row["cell"], part=row["part"])[
                    ["dim", "home", "part", "cell", "number", "chosen"]
                ]

    # Ranges of pivot distances of some blocks at a time.
    count = max(1, -(-index.blocks.count() // SUMMARY_ROWS))
    ranges = (
        index.blocks.groupBy("dim", F.pmod(F.xxhash64("cell", "number"), F.lit(count)).alias("some"))
        .agg(F.collect_list(F.struct("cell", "number", "top", "low", "high")).alias("ranges"))
        .drop("some")
    )
    schema = "dim int, home int, part long, cell int, number long, chosen binary"
    with small_batches(spark, BATCH_ROWS):
        open_ = store(asked.join(ranges, "dim").mapInPandas(rule_out, schema))

    def second(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                ids, queries = _queries(row)
                chosen = np.frombuffer(row["chosen"], "<i4")
                beat = np.frombuffer(row["beat"], "<i8")[chosen]
                number, found, score, _ = walk(
                    Block.of(row), _pivots_of(pivots, row["dim"]), ids[chosen], queries[chosen], beat, k
                )
                yield pd.DataFrame({"query_id": ids[chosen][number], "vec_id": found, "score": score})

    jobs = open_.join(asked.withColumnRenamed("cell", "home"), ["dim", "home", "part"]).join(
        index.blocks.drop("low", "high"), ["dim", "cell", "number"]
    )
    with small_batches(spark, BATCH_ROWS):
        found = store(jobs.mapInPandas(second, FOUND))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
