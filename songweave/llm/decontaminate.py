"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact check.

A window is as many words of a document as an item has, or all words of a shorter one. Its
fingerprint is a 64-bit SimHash of its shingles, each weighted by how often it occurs. Items are indexed under four 16-bit blocks
of their fingerprints: two fingerprints within ``RADIUS`` bits differ by at most a quarter of
that in one of the blocks, so an index that lists, for every block value, the items within that
many bits finds all of them. What is found is verified by the weighted Jaccard similarity of
the shingle counts, at least ``num / den``.

An item that is longer than the document meets the whole document as its one window, if their
sizes allow the threshold at all. Few shingles of unequal number would give fingerprints too
far apart, so none are used: a list from shingles to items gives each item's exact overlap.

Windows are only fingerprinted where they can reach the threshold at all: two sides of ``s``
shingles each have to share at least 2 * s * num / (num + den), so a window has to hold that
many shingles that some item has. This loses nothing.

Words are runs of letters, their marks and digits in lower case, whatever the signs between
them: quotes, dashes and other signs of any alphabet part words as those of ASCII do.

Edge cases: an item or a document that is null, empty or without words matches nothing; items
of fewer than ``k`` words are one shingle of all their words; equal items are all reported; rows
with repeated ids are each looked through and report alike; null ids are reported as null; an
empty table on either side gives no rows. Columns beside id and text are not looked at.
"""

from __future__ import annotations

import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from songweave.llm import common
from songweave.llm.jaccard import in_sorted

RADIUS = 19
BLOCKS, BLOCK_BITS = 4, 16
# Items of one index: its size, and so what is broadcast, is bounded by it. More items are
# looked for in several passes.
ITEMS = 4096

HITS = "doc_id long, item_id long, word long, n_words long, similarity double"


@cache
def is_sign(character: str) -> bool:
    """Whether a character beyond ASCII is no letter, digit or mark of a letter."""
    return not character.isalnum() and unicodedata.category(character)[0] != "M"


def without_signs(text: str) -> str:
    """The text with a space for each sign beyond ASCII."""
    if not text.isascii():
        for character in set(text):
            if character > "\x7f" and is_sign(character):
                text = text.replace(character, " ")
    return text


def words_of(texts: list[str]) -> list[np.ndarray]:
    return common.hash_words([without_signs(t.lower()).encode() for t in texts], common.WORDISH)


def bit_signs(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of a shingle's 64 bits."""
    bits = np.unpackbits(shingles.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def simhash(sums: np.ndarray) -> np.ndarray:
    """Fingerprints of rows of 64 weighted sums."""
    return np.packbits(sums > 0, axis=1).view("<u8").ravel().astype(np.uint64)


def near_values(bits: int) -> np.ndarray:
    """All 16-bit values with at most ``bits`` bits set."""
    values = np.arange(1 << BLOCK_BITS, dtype=np.uint32)
    return values[np.bitwise_count(values) <= bits]


class Index:
    """The benchmark's items of one pass."""

    def __init__(self, item_ids: list, texts: list[str], k: int, num: int, den: int):
        self.k, self.num, self.den = k, num, den
        found = [(i, w) for i, w in zip(item_ids, words_of(texts)) if len(w)]
        self.ids = [i for i, _ in found]
        self.sizes = np.array([len(w) for _, w in found], np.int64)
        sizes = np.unique(self.sizes).tolist()
        self.short, self.long = [n for n in sizes if n < k], [n for n in sizes if n >= k]
        shingles = [common.shingle_hashes(w, k) for _, w in found]
        self.counts = [Counter(s.tolist()) for s in shingles]
        self.known = np.unique(np.concatenate(shingles)) if shingles else np.empty(0, np.uint64)
        # The items that hold known[i], and how often, are at listed_from[i] : listed_from[i + 1].
        listed = [np.unique(s, return_counts=True) for s in shingles]
        held = np.concatenate([u for u, _ in listed]) if listed else np.empty(0, np.uint64)
        order = np.argsort(held, kind="stable")
        self.listed_from = np.append(np.searchsorted(held[order], self.known), len(held))
        owner = np.repeat(np.arange(len(listed)), [len(u) for u, _ in listed])
        self.listed_item = owner[order].astype(np.int64)
        times = np.concatenate([n for _, n in listed]) if listed else np.empty(0, np.int64)
        self.listed_times = times[order].astype(np.int64)
        # A bitmap over 20 bits of the hash spares most shingles the search.
        self.maybe = np.zeros(1 << 20, np.bool_)
        self.maybe[(self.known >> np.uint64(44)).astype(np.int64)] = True
        self.prints = np.array(
            [simhash(bit_signs(s).sum(0, keepdims=True))[0] for s in shingles], np.uint64
        )
        self.tables = [self._table(block) for block in range(BLOCKS)]

    def block(self, prints: np.ndarray, number: int) -> np.ndarray:
        return ((prints >> np.uint64(BLOCK_BITS * number)) & np.uint64(0xFFFF)).astype(np.uint32)

    def _table(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """(starts, items): items of block value v are items[starts[v] : starts[v + 1]]."""
        near = near_values(RADIUS // BLOCKS)
        own = self.block(self.prints, number)
        values = (own[:, None] ^ near[None, :]).ravel()
        items = np.repeat(np.arange(len(own), dtype=np.int32), len(near))
        order = np.argsort(values, kind="stable")
        starts = np.searchsorted(values[order], np.arange((1 << BLOCK_BITS) + 1))
        return starts, items[order]

    def lookup(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) for all items within the radius of each fingerprint."""
        rows, items = [], []
        for number, (starts, listed) in enumerate(self.tables):
            value = self.block(prints, number)
            first, n = starts[value], starts[value + 1] - starts[value]
            row = np.repeat(np.arange(len(prints)), n)
            place = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(len(row))
            item = listed[place]
            near = np.bitwise_count(prints[row] ^ self.prints[item]) <= RADIUS
            rows.append(row[near])
            items.append(item[near].astype(np.int64))
        pairs = np.unique(np.stack([np.concatenate(rows), np.concatenate(items)]), axis=1)
        return pairs[0], pairs[1]

    def matches(self, words: np.ndarray) -> dict[int, tuple[float, int, int]]:
        """Best (similarity, first word, words) of each item that the words contain."""
        best: dict[int, tuple[float, int, int]] = {}
        # Items shorter than a shingle are one shingle of their own length.
        for length in [*self.short, self.k]:
            if length > len(words):
                continue
            shingles = common.shingle_hashes(words, length)
            hit = self.maybe[(shingles >> np.uint64(44)).astype(np.int64)]
            hit[hit] = in_sorted(shingles[hit], self.known)
            hits = int(hit.sum())
            if not hits:
                continue
            if length == self.k:
                self._whole(shingles, hit, len(words), best)
            sums = np.concatenate([[0], np.cumsum(hit)])
            for size in [length] if length < self.k else self.long:
                width = size - length + 1
                need = -(-2 * width * self.num // (self.num + self.den))
                if need > hits or size > len(words):
                    break
                starts = np.flatnonzero(sums[width:] - sums[:-width] >= need)
                for at in range(0, len(starts), 1024):
                    self._windows(shingles, starts[at : at + 1024], width, size, best)
        return best

    def _whole(self, shingles: np.ndarray, hit: np.ndarray, n_words: int, best) -> None:
        """Items longer than the document, against all of it."""
        width = len(shingles)
        at = bisect_right(self.long, n_words)
        if at == len(self.long):
            return
        # The least that any of them demands: sizes are sorted.
        least = self.num * (width + self.long[at] - self.k + 1)
        if int(hit.sum()) * (self.num + self.den) < least:
            return
        own, times = np.unique(shingles[hit], return_counts=True)
        place = np.searchsorted(self.known, own)
        first, n = self.listed_from[place], self.listed_from[place + 1] - self.listed_from[place]
        rows = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        both = np.zeros(len(self.sizes), np.int64)
        np.add.at(
            both, self.listed_item[rows], np.minimum(np.repeat(times, n), self.listed_times[rows])
        )
        either = width + (self.sizes - self.k + 1) - both
        found = (self.sizes > n_words) & (both > 0) & (both * self.den >= either * self.num)
        for item in np.flatnonzero(found).tolist():
            best[item] = (float(both[item] / either[item]), 0, n_words)

    def _windows(self, shingles, starts, width, size, best) -> None:
        within = np.concatenate([[0], np.cumsum(np.diff(starts) - 1 > width)])
        for run in np.split(starts, np.flatnonzero(np.diff(within)) + 1):
            signs = bit_signs(shingles[run[0] : run[-1] + width])
            sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(signs, 0)])
            prints = simhash(sums[run - run[0] + width] - sums[run - run[0]])
            rows, items = self.lookup(prints)
            fit = self.sizes[items] == size
            for start, item in zip(run[rows[fit]].tolist(), items[fit].tolist()):
                window = Counter(shingles[start : start + width].tolist())
                wanted = self.counts[item]
                both = sum(min(c, wanted[s]) for s, c in window.items() if s in wanted)
                either = 2 * width - both
                if both * self.den >= either * self.num:
                    similarity = both / either
                    if item not in best or similarity > best[item][0]:
                        best[item] = (similarity, start, size)


def benchmark_hits(
    docs: DataFrame,
    items: DataFrame,
    k: int = 5,
    num: int = 8,
    den: int = 10,
    id_: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, word, n_words, similarity): the best window of every item that a
    document contains, by its first word and length in words.

    Items are taken ``ITEMS`` at a time in the order of their ids; each pass reads the
    documents once against an index of bounded size.
    """
    spark = docs.sparkSession
    wanted = items.select(F.col(item_id).cast("long").alias("item"), F.col(text).alias("text"))
    passes = max(1, -(-wanted.count() // ITEMS))
    dealt = wanted.withColumn(
        "pass", F.pmod(F.xxhash64("item", "text"), F.lit(2 * passes if passes > 1 else 1))
    )
    plain = docs.select(F.col(id_).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def hits(number: int) -> DataFrame:
        rows = dealt.where(F.col("pass") == number).select("item", "text").collect()
        index = Index(
            [r["item"] for r in rows], [r["text"] or "" for r in rows], k, num, den
        )
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in common.slices(batches):
                names = batch.column(0).to_pylist()
                out: list[tuple] = []
                for name, words in zip(names, words_of(common.texts_of(batch.column(1)))):
                    for item, (similarity, start, size) in own.matches(words).items():
                        out.append((name, own.ids[item], start, size, similarity))
                columns = list(zip(*out)) if out else [[]] * 5
                kinds = [*[pa.int64()] * 4, pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)],
                    ["doc_id", "item_id", "word", "n_words", "similarity"],
                )

        return plain.mapInArrow(common.tidy(run), HITS)

    found = hits(0)
    for number in range(1, 2 * passes if passes > 1 else 1):
        found = found.unionAll(hits(number))
    return found
