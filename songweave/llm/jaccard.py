"""N-gram Jaccard join by count vectors: every link between documents whose shingle sets
overlap enough, as components.

1. Every text becomes its set of hashed shingles, their number, a digest of the set, and a
   count vector: shingles are hashed to groups, one for every 4 to 8 shingles, and counted.
   Documents with equal sets are one class from then on, so copies cost nothing further.
2. Leaves: two sets that are similar enough share a shingle among the first few of each in any
   one order of all shingles (as many as the sets may differ in, plus one). Shingles come in the
   order of how many documents have them, as a table of ``2 ** SKETCH_BITS`` counters over all
   documents says, whose size doesn't depend on the data; it changes only the cost. A shingle's
   classes are a leaf, and of leaves with the same classes one is kept.
3. Large leaves are first linked to two pivots. In leaves of several blocks, what lies outside the
   main component is then linked to random members of it, until that finds no link; what one
   component holds needs no further check.
4. Within a leaf an R-tree over count vectors of ``GROUPS`` groups finds the pairs whose summed
   coordinate minima, which bound the overlap from above, reach what their sizes demand; at its
   points the vectors' finer groups decide. A pair counts in the first leaf that both are in.
   Nothing but the classes that are in such a pair leaves the task, never the pairs.
5. Those classes meet in their leaf once more, with their texts, compressed: all overlaps of the
   leaf's sets are counted and compared, and a task emits no more links than join its components.

A large leaf is cut into blocks that meet in pairs, each in one task; members of its main
component don't meet each other, only what is outside.

Sets are compared by 64-bit hashes of their shingles. A threshold is a ratio of integers and
is compared exactly. Tables stored on the way are deleted at the end.

Edge cases: texts that are null, empty or without words have an empty set and link with
nothing; fewer words than ``k`` make one shingle of the whole sequence; repeated rows of one
id come back once each and belong to one component if their texts link; a row with a null id
has its size but no component; an empty table gives no rows. Columns beside id and text are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from songweave.llm import common
from songweave.llm.common import store
from songweave.llm.components import components

GROUP_BITS = 6
GROUPS = 1 << GROUP_BITS
# log2 of the most groups of a vector, so its size is bounded.
LEAF_BITS = 9
# log2 of the counters that order shingles by how common they are, and of those of one piece.
SKETCH_BITS = 23
PIECE_BITS = 19
# Leaves above this size are linked to pivots first.
LEAF = 64
# A task's block of a leaf: the classes, and the shingles of all their sets.
BLOCK = 1024
BLOCK_SHINGLES = 1 << 22
FANOUT = 16
# Members of a main component that outsiders meet in a round, and the most rounds. Both change
# only the cost: the trees find every link that the rounds leave.
PIVOTS = 4
ROUNDS = 4
# Rows that Python is handed at once; with compressed texts; pairs whose texts are unpacked at
# once; and leaves of pairs that are compared at once.
BATCH_ROWS = 2000
TEXT_ROWS = 500
VERIFY_ROWS = 32
MEETINGS = 1 << 19


def text_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    return [np.unique(common.shingle_hashes(w, k)) for w in common.hash_words(texts)]


def leaf_count(n: int, num: int, den: int) -> int:
    """In how many leaves a set of ``n`` has to be: one more than the elements that a partner
    may lack, which is n - ceil(n * num / den); none if every partner equals it."""
    spare = n - (n * num + den - 1) // den
    return spare + 1 if spare or n * den // num > n else 0


def fine_bits(n: np.ndarray) -> np.ndarray:
    """log2 of the groups of sets' count vectors: the bits of (n - 1) // 8, within bounds."""
    bits = np.frexp(np.maximum(np.asarray(n) - 1, 0) // 8)[1]
    return np.clip(bits, GROUP_BITS, LEAF_BITS).astype(np.int64)


def packed_counts(found: np.ndarray, bits: int) -> bytes:
    """How many hashes have each value of their first ``bits`` bits, in one, two or four bytes
    each."""
    counts = np.bincount((found >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    most = counts.max()
    return counts.astype("u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4").tobytes()


def unpacked_counts(vectors: list[bytes], bits: np.ndarray, to: int) -> np.ndarray:
    """Rows of ``2 ** to`` counts of vectors of ``2 ** bits``: groups are leading bits of a
    hash, so neighbours add up to a coarser vector."""
    out = np.empty((len(vectors), 1 << to), np.int32)
    width = np.fromiter(map(len, vectors), np.int64, len(vectors)) >> bits
    for b, w in set(zip(bits.tolist(), width.tolist())):
        rows = np.flatnonzero((bits == b) & (width == w))
        flat = np.frombuffer(b"".join([vectors[i] for i in rows.tolist()]), f"<u{w}")
        out[rows] = flat.reshape(len(rows), 1 << to, -1).sum(2, dtype=np.int64)
    return out


def may_link(vectors: list[bytes], bits: np.ndarray, n: np.ndarray, i, j, num: int, den: int):
    """Whether the summed minima of each pair (i, j) of vectors reach what its sizes demand."""
    shared = np.minimum(bits[i], bits[j])
    keep = np.ones(len(i), np.bool_)
    for to in np.unique(shared).tolist():
        at = np.flatnonzero(shared == to)
        step = max(1, (1 << 20) >> to)
        for part in (at[k : k + step] for k in range(0, len(at), step)):
            rows, place = np.unique(np.concatenate([i[part], j[part]]), return_inverse=True)
            counts = unpacked_counts([vectors[r] for r in rows.tolist()], bits[rows], to)
            x, y = place[: len(part)], place[len(part) :]
            bound = np.minimum(counts[x], counts[y]).sum(1, dtype=np.int64)
            keep[part] = bound * (num + den) >= num * (n[i[part]] + n[j[part]])
    return keep


def levels_of(docs: DataFrame, k: int) -> np.ndarray:
    """How common the shingles of each counter are, over all documents: about 4 * log2 of their
    number, in a byte. Tasks count for themselves; their tables travel in pieces, which are added
    up in groups, so no task holds more than its own table."""
    size = 1 << PIECE_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, "<f4")
        for batch in common.slices(batches):
            for found in text_sets(common.bytes_of(batch.column("text")), k):
                np.add.at(counts, (found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
        part = TaskContext.get().partitionId()
        for piece in range(len(counts) // size):
            packed = zstandard.compress(counts[piece * size : (piece + 1) * size], 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([piece]), pa.array([part]), pa.array([packed])], ["piece", "part", "counts"]
            )

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        # Two tables of a piece in memory at a time.
        counts = np.zeros(size, "<f4")
        for packed in pdf["counts"]:
            counts += np.frombuffer(zstandard.decompress(packed), "<f4")
        piece, part = int(pdf["piece"].iloc[0]), int(pdf["part"].iloc[0]) // common.FAN
        packed = zstandard.compress(counts, 1)
        return pd.DataFrame({"piece": [piece], "part": [part], "counts": [packed]})

    schema = "piece long, part long, counts binary"
    tables = docs.select("text").mapInArrow(common.tidy(run), schema)
    levels = np.zeros(1 << SKETCH_BITS, np.uint8)
    # As many rows as there are pieces.
    for row in common.merged_parts(tables, added, schema, "piece").collect():
        counts = np.frombuffer(zstandard.decompress(row["counts"]), "<f4")
        at = row["piece"] * size
        levels[at : at + size] = np.minimum(4 * np.log2(counts + 1), 255)
    return levels


def in_sorted(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), np.bool_)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values


def described(docs: DataFrame, k: int, num: int, den: int, levels: np.ndarray) -> DataFrame:
    """(id, mark, n, digest, vector, first): ``first`` are the shingles of the set's leaves."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            sizes, digests, vectors, firsts = [], [], [], []
            for found in text_sets(common.bytes_of(batch.column("text")), k):
                level = shared.value[(found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                order = found[np.argsort(level, kind="stable")]
                keep = leaf_count(len(found), num, den)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                vectors.append(packed_counts(found, int(fine_bits(len(found)))))
                firsts.append(order[:keep].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("mark"),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(vectors, pa.binary()),
                    pa.array(firsts, pa.list_(pa.int64())),
                ],
                ["id", "mark", "n", "digest", "vector", "first"],
            )

    return docs.mapInArrow(
        common.tidy(run), "id long, mark long, n long, digest binary, vector binary, first array<long>"
    )


# --------------------------------------------------------------------------- R-tree


class Tree:
    """An R-tree over count vectors, packed by sorting: boxes, sizes and component ranges."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, comps: np.ndarray):
        low, high = points, points
        small, large, one, other = sizes, sizes, comps, comps
        self.levels = [(low, high, small, large, one, other)]
        while len(self.levels[-1][2]) > 1:
            edges = np.arange(0, len(self.levels[-1][2]), FANOUT)
            low, high, small, large, one, other = self.levels[-1]
            self.levels.append(
                (
                    np.minimum.reduceat(low, edges),
                    np.maximum.reduceat(high, edges),
                    np.minimum.reduceat(small, edges),
                    np.maximum.reduceat(large, edges),
                    np.minimum.reduceat(one, edges),
                    np.maximum.reduceat(other, edges),
                )
            )


def packed_order(points: np.ndarray, sizes: np.ndarray, comps: np.ndarray) -> np.ndarray:
    """Points in an order that keeps near ones together: by component, size, then counts."""
    keys = [points[:, j] for j in range(7, -1, -1)]
    return np.lexsort([*keys, sizes, comps])


def tree_pairs(left: tuple, right: tuple, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of pairs from two trees that may link and aren't in one component.

    ``left`` and ``right`` are (points, sizes, comps). Node pairs descend level by level; one
    survives if the summed minima of its boxes' upper corners reach the least overlap that its
    sizes demand: overlap * (num + den) >= num * (size + size).
    """
    a, b = Tree(*left), Tree(*right)
    depth = max(len(a.levels), len(b.levels))
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    for level in range(depth - 1, -1, -1):
        x = a.levels[min(level, len(a.levels) - 1)]
        y = b.levels[min(level, len(b.levels) - 1)]
        keep = []
        for at in range(0, len(i), 8192):
            p, q = i[at : at + 8192], j[at : at + 8192]
            # Both nodes hold one and the same component: nothing to learn.
            same = (x[4][p] == x[5][p]) & (y[4][q] == y[5][q]) & (x[4][p] == y[4][q])
            fits = (x[2][p] * num <= y[3][q] * den) & (y[2][q] * num <= x[3][p] * den)
            open_ = np.flatnonzero(~same & fits)
            bound = np.minimum(x[1][p[open_]], y[1][q[open_]]).sum(1, dtype=np.int64)
            need = num * (x[2][p[open_]] + y[2][q[open_]])
            keep.append(at + open_[bound * (num + den) >= need])
        kept = np.concatenate(keep) if keep else np.empty(0, np.int64)
        i, j = i[kept], j[kept]
        if level == 0:
            break

        # Children of both sides; a tree that is at its points already stays there.
        def below(tree: Tree, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if level >= len(tree.levels):
                return nodes, np.ones(len(nodes), np.int64)
            size = len(tree.levels[level - 1][2])
            first = nodes * FANOUT
            return first, np.minimum(FANOUT, size - first)

        fi, ni = below(a, i)
        fj, nj = below(b, j)
        total = ni * nj
        row = np.repeat(np.arange(len(i)), total)
        k = np.arange(len(row)) - np.repeat(np.cumsum(total) - total, total)
        i, j = fi[row] + k // nj[row], fj[row] + k % nj[row]
    return i, j


def first_meetings(earlier: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of rows have none of their earlier leaves in common."""
    keep = np.ones(len(i), np.bool_)
    sizes = np.fromiter(map(len, earlier), np.int64, len(earlier))
    if not len(i) or not sizes.any():
        return keep
    _, code = np.unique(np.concatenate(earlier), return_inverse=True)
    most = int(code.max()) + 1
    owner = np.repeat(np.arange(len(earlier)), sizes)
    have = np.sort(owner * most + code)
    starts = np.cumsum(sizes) - sizes
    work = np.cumsum(sizes[i])
    edges = np.searchsorted(work, np.arange(0, work[-1], MEETINGS), side="right")
    for at, to in zip(edges.tolist(), [*edges[1:].tolist(), len(i)]):
        mine, yours = i[at:to], j[at:to]
        n = sizes[mine]
        pair = np.repeat(np.arange(len(mine)), n)
        place = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n) + starts[mine][pair]
        met = in_sorted(yours[pair] * most + code[place], have)
        keep[at + pair[met]] = False
    return keep


def _candidates(num: int, den: int):
    """From rows of leaves, sorted by leaf and block pair, the ones that are in a pair that may
    link, isn't in one component and meets first in this leaf. A block pair's rows are bounded."""

    def side(pdf: pd.DataFrame) -> tuple:
        """Row numbers and (points, sizes, components), in the tree's order."""
        sizes, comps = pdf["n"].to_numpy(np.int64), pdf["component"].to_numpy(np.int64)
        points = unpacked_counts(pdf["vector"].tolist(), fine_bits(sizes), GROUP_BITS)
        order = packed_order(points, sizes, comps)
        return order, (points[order], sizes[order], comps[order])

    def survivors(pdf: pd.DataFrame, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The rows of the pairs that finer groups and earlier leaves leave."""
        n = pdf["n"].to_numpy(np.int64)
        found = np.zeros(len(pdf), np.bool_)
        keep = first_meetings(pdf["earlier"].tolist(), i, j)
        i, j = i[keep], j[keep]
        keep = may_link(pdf["vector"].tolist(), fine_bits(n), n, i, j, num, den)
        found[i[keep]] = found[j[keep]] = True
        return found

    def nodes(pdf: pd.DataFrame, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Leaves of a single node, all at once: every pair within a node is bounded."""
        area = sizes * sizes
        k = np.arange(area.sum()) - np.repeat(np.cumsum(area) - area, area)
        row, width = np.repeat(starts, area), np.repeat(sizes, area)
        i, j = row + k // width, row + k % width
        n, comps = pdf["n"].to_numpy(np.int64), pdf["component"].to_numpy(np.int64)
        keep = (i < j) & (comps[i] != comps[j])
        keep &= (n[i] * num <= n[j] * den) & (n[j] * num <= n[i] * den)
        return survivors(pdf, i[keep], j[keep])

    def large(rows: pd.DataFrame, x: int, y: int) -> np.ndarray:
        places = rows["block"].to_numpy()
        mine, yours = np.flatnonzero(places == x), np.flatnonzero(places == y)
        if not len(mine) or not len(yours):
            return np.zeros(len(rows), np.bool_)
        order, left = side(rows.iloc[mine])
        other, right = (order, left) if x == y else side(rows.iloc[yours])
        i, j = tree_pairs(left, right, num, den)
        i, j = mine[order[i]], yours[other[j]]
        if x == y:
            i, j = i[i < j], j[i < j]
        return survivors(rows, i, j)

    def found(pdf: pd.DataFrame) -> pd.DataFrame:
        names = ["leaf", "x", "y", "id", "component"]
        if not len(pdf):
            return pdf[names]
        keys = pdf[["leaf", "x", "y"]].to_numpy(np.int64)
        starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1)))
        sizes = np.diff(np.append(starts, len(pdf)))
        small = (sizes <= FANOUT) & (keys[starts, 1] == keys[starts, 2])
        keep = nodes(pdf, starts[small], sizes[small])
        for start, size in zip(starts[~small].tolist(), sizes[~small].tolist()):
            rows = pdf.iloc[start : start + size]
            keep[start : start + size] = large(rows, keys[start, 1], keys[start, 2])
        return pdf.loc[keep, names]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in whole_groups(batches):
            yield found(pdf)

    return run


def whole_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches of rows that are sorted by leaf and block pair, cut between them."""
    held = None
    for batch in batches:
        if not len(batch):
            continue
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        last = held.iloc[-1]
        open_ = held["leaf"] == last["leaf"]
        open_ &= (held["x"] == last["x"]) & (held["y"] == last["y"])
        if not open_.all():
            yield held[~open_].reset_index(drop=True)
            held = held[open_].reset_index(drop=True)
    if held is not None:
        yield held


# --------------------------------------------------------------------------- verification


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of the intersections of each two different sets. Shingles of many sets count by
    a matrix product, those of a few by their pairs."""
    m = len(sets)
    out = np.zeros(m * m, np.float32)
    values = np.concatenate(sets)
    rows = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, rows = values[order], rows[order]
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    counts = np.diff(np.append(starts, len(values)))
    heavy = counts > max(8, m // 14)
    light = np.flatnonzero(~heavy & (counts > 1))
    area = np.cumsum(counts[light] ** 2)
    for part in np.split(light, np.searchsorted(area, np.arange(1 << 19, area[-1] if len(area) else 0, 1 << 19))):
        n = np.repeat(counts[part], counts[part] ** 2)
        k = np.arange(len(n)) - np.repeat(np.cumsum(counts[part] ** 2) - counts[part] ** 2, counts[part] ** 2)
        first = np.repeat(starts[part], counts[part] ** 2)
        np.add.at(out, rows[first + k // n] * m + rows[first + k % n], 1)
    out = out.reshape(m, m)
    columns = np.flatnonzero(heavy)
    step = max(1, (1 << 21) // m)
    for part in (columns[at : at + step] for at in range(0, len(columns), step)):
        n = counts[part]
        place = np.repeat(starts[part] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        held = np.zeros((m, len(part)), np.float32)
        held[rows[place], np.repeat(np.arange(len(part)), n)] = 1
        out += held @ held.T
    return out.astype(np.int32)


def joining_links(sets: list[np.ndarray], comps: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Pairs of sets that link and, together, join all components that links join: fewer than
    there are components."""
    both = overlaps(sets)
    n = np.fromiter(map(len, sets), np.int64, len(sets))
    names, comp = np.unique(comps, return_inverse=True)
    found = []
    for row in range(len(sets)):
        own = both[row].astype(np.int64)
        link = own * den >= (n[row] + n - own) * num
        found.append(np.flatnonzero(link & (comp[row] < comp)))
    i, j = np.repeat(np.arange(len(sets)), list(map(len, found))), np.concatenate(found)
    # One link for every two components, then a tree over them.
    _, one = np.unique(comp[i] * len(names) + comp[j], return_index=True)
    i, j = i[one], j[one]
    joined = np.full((len(names), len(names)), -1, np.int64)
    joined[comp[i], comp[j]] = joined[comp[j], comp[i]] = np.arange(len(i))
    seen, out = np.zeros(len(names), np.bool_), []
    for start in range(len(names)):
        front = np.array([start]) if not seen[start] else np.empty(0, np.int64)
        seen[front] = True
        while len(front):
            at = joined[front]
            new = np.flatnonzero((at >= 0).any(0) & ~seen)
            used = at[:, new].max(0)
            out += zip(i[used].tolist(), j[used].tolist())
            seen[new] = True
            front = new
    return out


def _links(k: int, num: int, den: int):
    """Links (a, b) within leaves' block pairs, from rows with their texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor()
        for pdf in whole_groups(batches):
            keys = pdf[["leaf", "x", "y"]].to_numpy(np.int64)
            starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1)))
            ids, comps = pdf["id"].to_numpy(np.int64), pdf["component"].to_numpy(np.int64)
            packed, out = pdf["packed"].tolist(), [np.empty((0, 2), np.int64)]
            for s, e in zip(starts.tolist(), np.append(starts[1:], len(pdf)).tolist()):
                sets = text_sets([unpack.decompress(t) for t in packed[s:e]], k)
                pairs = joining_links(sets, comps[s:e], num, den)
                out.append(ids[s:e][np.array(pairs, np.int64).reshape(-1, 2)])
            yield pd.DataFrame(np.concatenate(out), columns=["a", "b"])

    return run


# --------------------------------------------------------------------------- the join


def _texts(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(class, packed): the compressed text of the row that names each wanted class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor()
        for batch in common.slices(batches):
            texts = map(pack.compress, common.bytes_of(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("class"), pa.array(texts, pa.binary())], ["class", "packed"]
            )

    # Ids may repeat on rows of other texts: the mark picks the right one.
    rows = store(wanted.distinct().join(classes.select("class", "id", "mark"), "class"), small=True)
    packed = docs.join(rows, ["id", "mark"]).select("class", "text").mapInArrow(
        run, "class long, packed binary"
    )
    return store(packed.groupBy("class").agg(F.first("packed").alias("packed")))


def _verified(pairs: DataFrame, texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of classes that link, decided on their shingle sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in common.slices(batches, VERIFY_ROWS):
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            packed = dict(zip(a, batch.column("x").to_pylist()))
            packed.update(zip(b, batch.column("y").to_pylist()))
            found = text_sets([unpack.decompress(t) for t in packed.values()], k)
            sets = dict(zip(packed, found))
            keep = []
            for i, j in zip(a, b):
                x, y = sets[i], sets[j]
                both = int(in_sorted(x, y).sum())
                keep.append(both * den >= (len(x) + len(y) - both) * num)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(
        texts.select(F.col("class").alias("a"), F.col("packed").alias("x")), "a"
    ).join(texts.select(F.col("class").alias("b"), F.col("packed").alias("y")), "b")
    with common.small_batches(pairs.sparkSession, TEXT_ROWS):
        return store(both.mapInArrow(common.tidy(run), "a long, b long"), small=True)


def _nearer(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """(id, component) after one more step over some links: the least label of a class and its
    neighbours. Classes with one label are connected; that others aren't, it doesn't say."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if labels is None:
        own = both.select(F.col("a").alias("id"), F.least("a", "b").alias("component"))
    else:
        met = both.join(labels.withColumnRenamed("id", "b"), "b", "left")
        own = met.select(F.col("a").alias("id"), F.least("a", F.coalesce("component", "b")).alias("component"))
        own = own.unionAll(labels)
    return store(own.groupBy("id").agg(F.min("component").alias("component")), small=True)


def _outsiders(big: DataFrame, merged: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b) of classes outside the main component of a large leaf and a few of its
    members, which a hash that changes with ``turn`` draws. Main is the component that most of
    a leaf's classes are in, if it is large itself. Nothing but sums and minima are gathered."""
    placed = big.join(merged.withColumnRenamed("id", "class"), "class", "left").select(
        "leaf", "class", F.coalesce("component", "class").alias("component")
    )

    def drawn(j: int):
        key = F.xxhash64("class", F.lit(turn * PIVOTS + j))
        return F.min(F.struct(key.alias("key"), F.col("class").alias("class")))["class"]

    parts = placed.groupBy("leaf", "component").agg(
        F.count(F.lit(1)).alias("rows"), F.array(*map(drawn, range(PIVOTS))).alias("pivots")
    )
    main = (
        parts.groupBy("leaf")
        .agg(
            F.max(F.struct("rows", "component", "pivots")).alias("main"),
            F.count(F.lit(1)).alias("parts"),
        )
        .where((F.col("parts") > 1) & (F.col("main.rows") >= LEAF))
        .select("leaf", F.col("main.component").alias("main"), F.col("main.pivots").alias("pivots"))
    )
    # A class meets the same component in many leaves: one draw of each kind is enough.
    met = (
        placed.join(main, "leaf")
        .where("component <> main")
        .groupBy("class", "main")
        .agg(F.array(*[F.min(F.col("pivots")[j]) for j in range(PIVOTS)]).alias("pivots"))
        .select("class", F.explode("pivots").alias("pivot"))
    )
    return met.select(
        F.least("class", "pivot").alias("a"), F.greatest("class", "pivot").alias("b")
    ).distinct()


def _leaves(classes: DataFrame, num: int, den: int) -> DataFrame:
    """(leaf, class, n, rows, weight): the classes of every leaf that several share, with the
    leaf's classes and shingles.

    A class whose set no other of its leaf comes near in size goes: next to it in the order of
    sizes stands the one that would. Of leaves with the same classes, known by 128 bits of their
    hashes, one stays: the others lead to the same pairs."""
    leaves = classes.select(F.explode("first").alias("leaf"), "class", "n")
    sizes = leaves.groupBy("leaf").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    by_size = Window.partitionBy("leaf").orderBy("n", "class")
    before, after = F.lag("n").over(by_size), F.lead("n").over(by_size)
    fits = (before * den >= F.col("n") * num) | (F.col("n") * den >= after * num)
    with common.scope():
        shared = leaves.join(store(sizes), "leaf")
        small = shared.where(F.col("rows") <= BLOCK).withColumn("fits", fits).where("fits")
        large = shared.where(F.col("rows") > BLOCK)
        names = ["leaf", "class", "n"]
        shared = store(small.select(*names).unionAll(large.select(*names)))
        kept = (
            shared.groupBy("leaf")
            .agg(
                F.count(F.lit(1)).alias("rows"),
                F.sum("n").alias("weight"),
                *[F.bit_xor(F.xxhash64("class", F.lit(seed))).alias(f"h{seed}") for seed in (1, 2)],
            )
            .groupBy("rows", "weight", "h1", "h2")
            .agg(F.min("leaf").alias("leaf"))
        )
        return store(shared.join(kept.select("leaf", "rows", "weight"), "leaf"), outer=True)


def _parts() -> Column:
    """The blocks of a leaf."""
    parts = F.greatest(F.col("rows") / BLOCK, F.col("weight") / BLOCK_SHINGLES)
    return F.ceil(parts).cast("int")


def _blocks(placed: DataFrame) -> DataFrame:
    """``placed`` (leaf, class, component, n, rows, weight) with the block pairs (x, y) that a
    row has to be in, and its own block.

    A leaf of several blocks has those of its main component first: they meet all others but
    not each other."""
    placed = placed.withColumn("parts", _parts())
    main = (
        placed.where("parts > 1")
        .groupBy("leaf", "component", "parts", "rows")
        .agg(F.count(F.lit(1)).alias("own"))
        .groupBy("leaf", "parts", "rows")
        .agg(F.max(F.struct("own", "component")).alias("main"))
        .select(
            "leaf",
            F.col("main.component").alias("main"),
            F.ceil(F.col("main.own") * F.col("parts") / F.col("rows")).cast("int").alias("inner"),
            F.ceil((F.col("rows") - F.col("main.own")) * F.col("parts") / F.col("rows"))
            .cast("int")
            .alias("outer"),
        )
    )
    number = F.xxhash64("class")
    inside = F.col("component") == F.col("main")
    last = F.col("inner") + F.col("outer") - 1

    def drawn(blocks: str) -> Column:
        return F.pmod(number, F.col(blocks)).cast("int")

    block = (
        F.when(F.col("main").isNull(), 0)
        .when(inside, drawn("inner"))
        .otherwise(F.col("inner") + drawn("outer"))
    )
    met = (
        F.when(F.col("main").isNull(), F.array(F.lit(0)))
        .when(inside, F.sequence("inner", last))
        .otherwise(F.sequence(F.lit(0), last))
    )
    return (
        placed.join(main, "leaf", "left")
        .select(*placed.columns, block.alias("block"), F.explode(met).alias("met"))
        .withColumns({"x": F.least("block", "met"), "y": F.greatest("block", "met")})
        .drop("met", "parts")
    )


def _in_leaves(rows: DataFrame) -> DataFrame:
    """Rows dealt to tasks by leaf and block pair, and sorted by them."""
    return rows.repartition("leaf", "x", "y").sortWithinPartitions("leaf", "x", "y")


def _class_components(docs: DataFrame, classes: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(id, component) of every class that links with another."""
    spark = docs.sparkSession
    members = _leaves(classes, num, den)
    vectors = classes.select("class", "n", "vector")
    # Large leaves: everyone against two pivots, verified, so that most are linked already.
    big = members.where(F.col("rows") > LEAF).select("leaf", "class")
    ends = big.groupBy("leaf").agg(F.array(F.min("class"), F.max("class")).alias("ends"))
    pivots = (
        big.join(ends, "leaf")
        .select("class", F.explode("ends").alias("end"))
        .where("class <> end")
        .select(F.least("class", "end").alias("a"), F.greatest("class", "end").alias("b"))
        .distinct()
    )

    def linked(pairs: DataFrame) -> DataFrame:
        ends = pairs.select(F.explode(F.array("a", "b")).alias("class"))
        return _verified(pairs, _texts(docs, classes, ends), k, num, den)

    near = store(_bounded(pivots, vectors, num, den), small=True)
    found = linked(near)
    merged = _nearer(_nearer(None, found), found)
    wide = store(members.where(_parts() > 1).select("leaf", "class"), small=True)
    for turn in range(0 if wide.isEmpty() else ROUNDS):
        proposed = _outsiders(wide, merged, turn).join(near, ["a", "b"], "left_anti")
        proposed = store(_bounded(proposed, vectors, num, den), small=True)
        links = linked(proposed)
        if links.isEmpty():
            break
        near, found = near.unionAll(proposed), found.unionAll(links)
        merged = _nearer(_nearer(merged, links), links)
    placed = members.join(merged.withColumnRenamed("id", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class")
    )
    open_ = (
        placed.groupBy("leaf")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        .where("lo <> hi")
        .select("leaf")
    )
    placed = store(placed.join(open_, "leaf", "left_semi"))
    # A class has at most ``leaf_count`` leaves.
    before = Window.partitionBy("class").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    dealt = (
        _blocks(placed.withColumn("earlier", F.collect_list("leaf").over(before)))
        .drop("n", "rows", "weight")
        .join(vectors, "class")
        .select("leaf", "x", "y", "block", F.col("class").alias("id"), "n", "vector", "component", "earlier")
    )
    schema = "leaf long, x int, y int, id long, component long"
    met = store(_in_leaves(dealt).mapInPandas(common.tidy(_candidates(num, den)), schema))
    texts = _texts(docs, classes, met.select(F.col("id").alias("class")))
    with_texts = met.join(texts.withColumnRenamed("class", "id"), "id")
    with common.small_batches(spark, TEXT_ROWS):
        links = _in_leaves(with_texts).mapInPandas(common.tidy(_links(k, num, den)), "a long, b long")
        links = store(links, small=True)
    return components(found.unionAll(links))


def jaccard_components(
    docs: DataFrame,
    k: int,
    num: int,
    den: int,
    id_: str = "doc_id",
    text: str = "text",
    by_text: bool = False,
) -> DataFrame:
    """(id, n_shingles, component_id) of every row: links are pairs whose intersection * den
    is at least their union * num, and a component is named by its smallest id.

    Texts that share an id are in one component; not so ``by_text``, where a row has the
    component of its own text, and ``mark``, the text's xxhash64, tells rows of an id apart.
    """
    plain = docs.select(
        F.col(id_).cast("long").alias("id"),
        F.col(text).alias("text"),
        F.xxhash64(text).alias("mark"),
    )
    with common.scope(), common.small_batches(docs.sparkSession, BATCH_ROWS):
        levels = levels_of(plain, k)
        every = store(described(plain, k, num, den, levels))
        # A class is a distinct set; ids that repeat with other texts can't name two classes, so
        # classes are numbered. The row with the smallest id stands for its text.
        named = every.where("n > 0 and id is not null")
        classes = store(
            named.groupBy("digest")
            .agg(
                F.min(F.struct("id", "mark")).alias("row"),
                *[F.first(c).alias(c) for c in ("n", "vector", "first")],
            )
            .select("digest", "row.*", "n", "vector", "first", F.monotonically_increasing_id().alias("class"))
        )
        rows = store(every.select("id", "mark", "n", "digest"), outer=True)
        groups = _class_components(plain, classes, k, num, den)
        labelled = classes.select("digest", F.col("class").alias("id")).join(groups, "id", "left")
        labelled = store(
            labelled.select("digest", F.coalesce("component", "id").alias("component")), small=True
        )
        return _named(rows, labelled, id_, by_text)


def _named(rows: DataFrame, labelled: DataFrame, id_: str, by_text: bool) -> DataFrame:
    """Back to documents from (digest, component). Rows of one id with several sets join their
    classes, if not ``by_text``."""
    rows_in = rows.where("n > 0 and id is not null").join(labelled, "digest")
    if by_text:
        names = rows_in.groupBy("component").agg(F.min("id").alias("component_id"))
        by_digest = store(labelled.join(names, "component"), outer=True, small=True)
        return _with_components(rows, by_digest, id_, "mark")
    several = rows_in.groupBy("id").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi")
    )
    bridges = components(several.where("lo <> hi").select(F.col("lo").alias("a"), F.col("hi").alias("b")))
    bridged = labelled.join(
        bridges.select(F.col("id").alias("component"), F.col("component").alias("bridge")),
        "component",
        "left",
    ).select("digest", F.coalesce("bridge", "component").alias("component"))
    names = (
        rows_in.select("id", "digest")
        .join(bridged, "digest")
        .groupBy("component")
        .agg(F.min("id").alias("component_id"))
    )
    by_digest = store(bridged.join(names, "component"), outer=True, small=True)
    return _with_components(rows, by_digest, id_)


def _with_components(rows: DataFrame, by_digest: DataFrame, id_: str, *more: str) -> DataFrame:
    """The operator's columns, and ``more`` of the described rows, for every row."""
    return rows.join(by_digest.select("digest", "component_id"), "digest", "left").select(
        F.col("id").alias(id_),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNull() | (F.col("n") == 0), F.col("id"))
        .otherwise(F.col("component_id"))
        .alias("component_id"),
        *more,
    )


def _bounded(pairs: DataFrame, vectors: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs whose summed minima over count vectors reach what their sizes demand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            found = batch.column("va").to_pylist() + batch.column("vb").to_pylist()
            n = np.concatenate([batch.column(c).to_numpy() for c in ("na", "nb")])
            first = np.arange(batch.num_rows)
            keep = may_link(found, fine_bits(n), n, first, first + batch.num_rows, num, den)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def side(name: str) -> DataFrame:
        return vectors.select(
            F.col("class").alias(name), F.col("n").alias(f"n{name}"), F.col("vector").alias(f"v{name}")
        )

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long")
