"""Approximate nearest neighbours by robust-pruned directed graphs, one for each shard.

Vectors are dealt to shards by a hash of their id. Within a shard, vectors whose directions agree
to about 0.01 rad are one node, whose first vector leads it: leaders lie far enough apart for
single precision. A shard's graph over the leaders is built by inserting them in batches: a greedy
beam search over the graph so far proposes neighbours, pruning with a relaxed distance keeps
diverse ones, and reverse edges are added and pruned alike. Graphs are stored. Queries go to
every shard in blocks, a beam search answers each, all vectors of all nodes of the beam are
scored, and the answers are merged.

Nearness is the cosine; scores are computed in double precision on the original vectors. Equal
vectors of a shard are kept once, with their smallest ids.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components take no
part, neither as queries nor as candidates; vectors of different lengths never meet; rows that
repeat an id count once, with the first vector in array order; a query is never its own answer;
ties go to smaller ids; fewer candidates give fewer answers; empty tables give no rows. Other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from songweave.llm.common import small_batches, store

SHARD_ROWS = 8192  # expected size of a shard: bounds a task's memory
QUERY_BLOCK = 2048
DEGREE = 32
BUILD_BEAM, SEARCH_BEAM = 64, 192
RELAX = 1.2
EXPAND = 4  # nodes whose edges are followed at once
NEAR = 1 - 5e-5  # cosine from which on vectors share a node
PAIRS = 1 << 16  # vectors that are scored in double precision at once
JOB_ROWS = 2  # rows of a graph and a block of queries, in memory at once

GRAPHS = (
    "shard long, dim int, entry int, ids binary, id_counts binary, vectors binary, "
    "node_counts binary, edges binary"
)
FOUND = "query_id long, vec_id long, score double"


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision and without overflow."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def beam_search(
    points: np.ndarray, edges: np.ndarray, entry: int, queries: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, cosines) of the best ``beam`` nodes met for each query, best first; -1 fills."""
    n, b = len(points), len(queries)
    beam = min(beam, n)
    nodes = np.full((b, beam), -1, np.int64)
    near = np.full((b, beam), -np.inf, np.float32)
    done = np.ones((b, beam), np.bool_)
    seen = np.zeros((b, n), np.bool_)
    nodes[:, 0], near[:, 0], done[:, 0] = entry, queries @ points[entry], False
    seen[:, entry] = True
    live = np.arange(b)
    while len(live):
        open_ = ~done[live]
        rank = np.cumsum(open_, 1)
        row, col = np.nonzero(open_ & (rank <= EXPAND))
        done[live[row], col] = True
        # Targets of the chosen nodes, once per query.
        width = edges.shape[1]
        owner = np.repeat(live[row], width)
        target = edges[nodes[live[row], col]].ravel()
        keep = target >= 0
        owner, target = owner[keep], target[keep]
        fresh = ~seen[owner, target]
        key = np.unique(owner[fresh] * n + target[fresh])
        owner, target = key // n, key % n
        seen[owner, target] = True
        cosine = np.einsum("ij,ij->i", queries[owner], points[target])
        counts = np.bincount(owner, minlength=b)[live]
        room = int(counts.max()) if len(counts) else 0
        if room:
            place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            local = np.repeat(np.arange(len(live)), counts)
            more = np.full((len(live), room), -1, np.int64)
            score = np.full((len(live), room), -np.inf, np.float32)
            more[local, place], score[local, place] = target, cosine
            all_nodes = np.concatenate([nodes[live], more], 1)
            all_near = np.concatenate([near[live], score], 1)
            all_done = np.concatenate([done[live], more < 0], 1)
            order = np.argsort(-all_near, 1, kind="stable")[:, :beam]
            nodes[live] = np.take_along_axis(all_nodes, order, 1)
            near[live] = np.take_along_axis(all_near, order, 1)
            done[live] = np.take_along_axis(all_done, order, 1)
        live = live[~done[live].all(1)]
    return nodes, near


def robust_prune(
    points: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int = DEGREE
) -> np.ndarray:
    """At most ``degree`` diverse neighbours of each node ``own`` out of its candidates.

    The nearest candidate is kept, and all those go that it is nearer to, ``RELAX`` times over,
    than the node itself; then the next. -1 in the candidates stands for none.
    """
    valid = (candidates >= 0) & (candidates != own[:, None])
    vectors = points[np.where(valid, candidates, 0)]
    cosine = np.einsum("bcd,bd->bc", vectors, points[own])
    cosine[~valid] = -np.inf
    order = np.argsort(-cosine, 1, kind="stable")
    candidates = np.take_along_axis(candidates, order, 1)
    alive = np.take_along_axis(valid, order, 1)
    vectors = np.take_along_axis(vectors, order[:, :, None], 1)
    cosine = np.take_along_axis(np.where(valid, cosine, 0), order, 1)
    own_distance = np.sqrt(np.maximum(0, 2 - 2 * cosine))
    between = np.sqrt(np.maximum(0, 2 - 2 * (vectors @ vectors.transpose(0, 2, 1))))
    kept = np.full((len(own), degree), -1, np.int64)
    rows = np.arange(len(own))
    for slot in range(degree):
        first = np.argmax(alive, 1)
        some = alive[rows, first]
        if not some.any():
            break
        kept[some, slot] = candidates[rows, first][some]
        alive &= ~(RELAX * between[rows, first] <= own_distance)
        alive[rows, first] = False
    return kept


def build_graph(points: np.ndarray) -> tuple[np.ndarray, int]:
    """(edges, entry) over unit vectors (float32); the entry is the one nearest their mean."""
    n = len(points)
    edges = np.full((n, DEGREE), -1, np.int64)
    entry = int(np.argmax(points @ points.mean(0)))
    order = np.random.default_rng(11).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    done = 1
    while done < n:
        batch = order[done : done + min(512, max(1, done))]
        nodes, _ = beam_search(points, edges, entry, points[batch], BUILD_BEAM)
        edges[batch] = robust_prune(points, batch, nodes)
        # Reverse edges, gathered by target.
        source = np.repeat(batch, DEGREE)
        target = edges[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        targets, counts = np.unique(target, return_counts=True)
        place = np.arange(len(target)) - np.repeat(np.cumsum(counts) - counts, counts)
        for at in range(0, int(counts.max()) if len(counts) else 0, DEGREE):
            take = (place >= at) & (place < at + DEGREE)
            some = targets[counts > at]
            more = np.full((len(some), DEGREE), -1, np.int64)
            more[np.searchsorted(some, target[take]), place[take] - at] = source[take]
            for part in range(0, len(some), 512):
                own = some[part : part + 512]
                both = np.concatenate([edges[own], more[part : part + 512]], 1)
                edges[own] = robust_prune(points, own, both)
        done += len(batch)
    return edges, entry


def leaders(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(leaders, node of each row) of unit vectors: a row joins the nearest earlier leader that
    is near, or leads a node itself."""
    node, lead = np.full(len(points), -1, np.int64), np.empty(0, np.int64)
    for at in range(0, len(points), 1024):
        block = points[at : at + 1024]
        own = np.full(len(block), -1, np.int64)
        if len(lead):
            cosine = block @ points[lead].T
            best = cosine.argmax(1)
            close = cosine[np.arange(len(block)), best] >= NEAR
            own[close] = best[close]
        open_ = np.flatnonzero(own < 0)
        near = block[open_] @ block[open_].T >= NEAR
        left, new = np.ones(len(open_), np.bool_), []
        for i in range(len(open_)):
            if left[i]:
                near[i, i] = True
                own[open_[near[i] & left]] = len(lead) + len(new)
                left &= ~near[i]
                new.append(at + open_[i])
        lead = np.concatenate([lead, np.array(new, np.int64)])
        node[at : at + 1024] = own
    return lead, node


def usable(vector: str):
    """Whether a vector takes part."""
    column = F.col(vector)
    finite = F.forall(
        column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return column.isNotNull() & (F.size(column) > 0) & finite & F.exists(column, lambda x: x != 0)


def _one_per_id(vectors: DataFrame, id_: str, vector: str) -> DataFrame:
    """(id, vector, dim) of the vectors that take part."""
    rows = vectors.where(usable(vector) & F.col(id_).isNotNull()).select(
        F.col(id_).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")
    )
    once = rows.groupBy("id").agg(F.min("vector").alias("vector"))
    return once.withColumn("dim", F.size("vector"))


def pack_graph(ids: np.ndarray, vectors: np.ndarray, k: int) -> dict:
    """A shard's graph over its vectors, of which equal ones are kept once."""
    distinct, member = np.unique(vectors, axis=0, return_inverse=True)
    member = member.ravel()
    _, node = leaders(unit(distinct).astype(np.float32))
    # Vectors node by node, the leader first: it is the node's first in the order of rows.
    by_node = np.argsort(node, kind="stable")
    place = np.empty(len(distinct), np.int64)
    place[by_node] = np.arange(len(distinct))
    by = np.lexsort([ids, place[member]])
    counts = np.bincount(place[member], minlength=len(distinct))
    at = np.arange(len(by)) - np.repeat(np.cumsum(counts) - counts, counts)
    distinct, sizes = distinct[by_node], np.bincount(node)
    first = np.cumsum(sizes) - sizes
    edges, entry = build_graph(unit(distinct[first]).astype(np.float32))
    return {
        "entry": entry,
        "ids": ids[by][at <= k].astype("<i8").tobytes(),
        "id_counts": np.minimum(counts, k + 1).astype("<i4").tobytes(),
        "vectors": distinct.astype("<f8").tobytes(),
        "node_counts": sizes.astype("<i4").tobytes(),
        "edges": edges.astype("<i4").tobytes(),
    }


def build_index(
    vectors: DataFrame, k: int, id_: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Stored graphs, one row per shard and vector length; of equal vectors the ``k + 1`` smallest
    ids are kept, which is all that a search for ``k`` can return of them."""
    shards = max(1, -(-vectors.count() // SHARD_ROWS))
    rows = _one_per_id(vectors, id_, vector).withColumn(
        "shard", F.pmod(F.xxhash64("id"), F.lit(shards))
    )

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        found = np.array(pdf["vector"].tolist(), np.float64)
        graph = pack_graph(pdf["id"].to_numpy(np.int64), found, k)
        return pd.DataFrame([{"shard": key[0], "dim": key[1], **graph}])

    return store(rows.groupBy("shard", "dim").applyInPandas(build, GRAPHS))


def search_graph(
    graph: dict, query_ids: np.ndarray, queries: np.ndarray, k: int
) -> pd.DataFrame:
    """Each query's ``k`` best ids of one shard with their scores."""
    vectors = np.frombuffer(graph["vectors"], "<f8").reshape(-1, graph["dim"])
    sizes = np.frombuffer(graph["node_counts"], "<i4").astype(np.int64)
    edges = np.frombuffer(graph["edges"], "<i4").reshape(len(sizes), -1).astype(np.int64)
    ids, counts = np.frombuffer(graph["ids"], "<i8"), np.frombuffer(graph["id_counts"], "<i4")
    starts = np.cumsum(counts) - counts
    first = np.cumsum(sizes) - sizes
    exact, asked = unit(vectors), unit(queries)
    points, wanted = exact[first].astype(np.float32), asked.astype(np.float32)
    out = []

    def spread(begin: np.ndarray, many: np.ndarray) -> np.ndarray:
        return np.repeat(begin - (np.cumsum(many) - many), many) + np.arange(many.sum())

    def scored(row: np.ndarray, node: np.ndarray) -> None:
        """Appends the best of the vectors of nodes, each for the query of its row."""
        row = np.repeat(row, sizes[node])
        vector = spread(first[node], sizes[node])
        score = np.einsum("ij,ij->i", asked[row], exact[vector])
        many = counts[vector].astype(np.int64)
        found = ids[spread(starts[vector], many)]
        row, score = np.repeat(row, many), np.repeat(score, many)
        other = query_ids[row] != found
        row, score, found = row[other], score[other], found[other]
        order = np.lexsort([found, -score, row])
        row, score, found = row[order], score[order], found[order]
        new = np.flatnonzero(np.append(True, np.diff(row) != 0)) if len(row) else np.empty(0, int)
        rank = np.arange(len(row)) - np.repeat(new, np.diff(np.append(new, len(row))))
        best = rank < k
        out.append((query_ids[row[best]], found[best], score[best]))

    for at in range(0, len(queries), 256):
        nodes, _ = beam_search(points, edges, graph["entry"], wanted[at : at + 256], SEARCH_BEAM)
        row, col = np.nonzero(nodes >= 0)
        node = nodes[row, col]
        # Whole queries at a time, of about ``PAIRS`` vectors.
        work = np.bincount(row, weights=sizes[node], minlength=len(nodes)).cumsum()
        for part in np.unique(work // PAIRS):
            mine = (work // PAIRS == part)[row]
            scored(at + row[mine], node[mine])
    columns = [np.concatenate(c) for c in zip(*out)]
    return pd.DataFrame(dict(zip(["query_id", "vec_id", "score"], columns)))


def search(
    index: DataFrame,
    queries: DataFrame,
    k: int,
    id_: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for every query.

    Queries are packed into blocks of bounded size, and every block meets every shard's graph
    of the same vector length. Blocks travel to the graphs, which stay where they are.
    """
    rows = _one_per_id(queries, id_, vector)
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        found = np.array(pdf["vector"].tolist(), "<f8")
        ids = pdf["id"].to_numpy("<i8")
        return pd.DataFrame(
            {"dim": [key[1]], "query_ids": [ids.tobytes()], "queries": [found.tobytes()]}
        )

    packed = (
        rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
        .groupBy("block", "dim")
        .applyInPandas(pack, "dim int, query_ids binary, queries binary")
    )
    graphs = index.count()
    wanted = packed.join(index.select("shard", "dim"), "dim")
    jobs = index.repartition(max(1, min(4096, 4 * graphs)), "shard", "dim").join(
        wanted, ["shard", "dim"]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for job in batch.to_dict("records"):
                ids = np.frombuffer(job["query_ids"], "<i8")
                asked = np.frombuffer(job["queries"], "<f8").reshape(len(ids), -1)
                yield search_graph(job, ids, asked, k)

    with small_batches(index.sparkSession, JOB_ROWS):
        found = store(jobs.mapInPandas(run, FOUND))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
