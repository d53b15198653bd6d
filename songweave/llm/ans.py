"""Token-ID files: static range asymmetric numeral system over ids, in shared-table segments.

A file holds the documents of one range of ids, in ascending order. It is a row of segments;
a segment holds whole documents of about ``SEGMENT_IDS`` ids, one frequency table that all its
blocks share, the documents' ids and lengths, and a directory of its blocks. A block holds
``BLOCK_IDS`` ids coded by interleaved lanes that share one stream of 32-bit words; its entry in
the directory (place, number of ids, checksum) with its final lane states is a checkpoint: any
block decodes without the others.

Edge cases: a null or empty text is its end id alone; null document ids come first; rows with a
repeated id are documents of their own, ordered by text; an empty table gives no file. Columns
beside id and text are not looked at. A wrong checksum raises.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from songweave.llm import common

SEGMENT_IDS = 1 << 22
BLOCK_IDS = 1 << 18
LANES, FEW_LANES = 1024, 32
LEAST = np.uint64(1 << 31)  # lane states stay in [2 ** 31, 2 ** 63)
WORD = np.uint64(32)
MAGIC = b"ANSI\x01\x00\x00\x00"
HEAD = struct.Struct("<8sIQIIII")  # magic, documents, ids, scale bits, symbols, blocks, table
ENTRY = struct.Struct("<QIIII")  # block: offset in segment, ids, lanes, words, checksum


# --------------------------------------------------------------------------- coding


def normalised(counts: np.ndarray) -> tuple[np.ndarray, int]:
    """Frequencies of at least 1 that sum to a power of two, and that power."""
    bits = max(14, (len(counts) - 1).bit_length() + 2)
    total = 1 << bits
    scaled = np.maximum(1, counts * (total / counts.sum())).astype(np.int64)
    over = int(scaled.sum()) - total
    order = np.argsort(-scaled, kind="stable")
    while over != 0:
        # Take from (or give to) the largest, never below 1.
        step = np.zeros(len(scaled), np.int64)
        if over > 0:
            room = (scaled[order] - 1 + 3) // 4 * (scaled[order] > 1)
            taken = np.minimum(room, np.maximum(0, over - (np.cumsum(room) - room)))
            step[order] = -taken
        else:
            step[order[0]] = -over
        scaled += step
        over = int(scaled.sum()) - total
    return scaled, bits


def numbered(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, index, counts): distinct ids in order, each id's number among them, and how often
    each occurs. Ids of a vocabulary are counted without being sorted."""
    if not len(ids) or ids.min() < 0 or ids.max() >= SEGMENT_IDS:
        return np.unique(ids, return_inverse=True, return_counts=True)
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    number = np.zeros(len(counts), np.int64)
    number[symbols] = np.arange(len(symbols))
    return symbols, number[ids], counts[symbols]


def encode_block(index: np.ndarray, freq: np.ndarray, cum: np.ndarray, bits: int):
    """(lane states, words) of symbol numbers ``index``; lanes take turns."""
    lanes = LANES if len(index) >= 1 << 16 else FEW_LANES
    steps = -(-len(index) // lanes)
    state = np.full(lanes, LEAST, np.uint64)
    shift = np.uint64(bits)
    ceiling = np.uint64(1 << (63 - bits))
    chunks = []
    for t in range(steps - 1, -1, -1):
        symbols = index[t * lanes : (t + 1) * lanes]
        f, x = freq[symbols], state[: len(symbols)]
        full = x >= ceiling * f
        chunks.append(x[full].astype(np.uint32))
        x = np.where(full, x >> WORD, x)
        whole = x // f
        state[: len(symbols)] = (whole << shift) + (x - whole * f) + cum[symbols]
    words = np.concatenate(chunks[::-1]) if chunks else np.empty(0, np.uint32)
    return state, words


def decode_block(
    state: np.ndarray,
    words: np.ndarray,
    n: int,
    freq: np.ndarray,
    cum: np.ndarray,
    slots: np.ndarray,
    bits: int,
) -> np.ndarray:
    """The ``n`` symbol numbers of a block."""
    lanes, at = len(state), 0
    out = np.empty(n, np.int64)
    state, low = state.copy(), np.uint64((1 << bits) - 1)
    shift = np.uint64(bits)
    for t in range(-(-n // lanes)):
        size = min(lanes, n - t * lanes)
        x = state[:size]
        slot = x & low
        symbols = slots[slot.astype(np.int64)]
        out[t * lanes : t * lanes + size] = symbols
        x = freq[symbols] * (x >> shift) + slot - cum[symbols]
        short = np.flatnonzero(x < LEAST)
        x[short] = (x[short] << WORD) | words[at : at + len(short)]
        at += len(short)
        state[:size] = x
    if at != len(words) or np.any(state != LEAST):
        raise ValueError("a block doesn't decode to its end")
    return out


def pack_segment(doc_ids: list, ids: list[np.ndarray]) -> bytes:
    """One segment of whole documents."""
    flat = np.concatenate(ids).astype(np.int64)
    symbols, index, counts = numbered(flat)
    scaled, bits = normalised(counts)
    freq = scaled.astype(np.uint64)
    cum = np.cumsum(freq) - freq
    known = np.array([d is not None for d in doc_ids], np.uint8)
    about = zlib.compress(
        b"".join(
            [
                known.tobytes(),
                np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
                np.array([len(x) for x in ids], "<u8").tobytes(),
                np.diff(symbols, prepend=0).astype("<u4").tobytes(),
                scaled.astype("<u4").tobytes(),
            ]
        ),
        6,
    )
    entries, bodies = [], []
    blocks = range(0, len(flat), BLOCK_IDS)
    at = HEAD.size + len(about) + ENTRY.size * len(blocks)
    for start in blocks:
        part = index[start : start + BLOCK_IDS]
        state, words = encode_block(part, freq, cum, bits)
        body = state.astype("<u8").tobytes() + words.astype("<u4").tobytes()
        entries.append(ENTRY.pack(at, len(part), len(state), len(words), zlib.crc32(body)))
        bodies.append(body)
        at += len(body)
    head = HEAD.pack(MAGIC, len(ids), len(flat), bits, len(symbols), len(blocks), len(about))
    return b"".join([head, about, *entries, *bodies])


class Segment:
    """A segment's tables; blocks are decoded one by one."""

    def __init__(self, data: bytes):
        self.data = data
        magic, docs, self.n_ids, self.bits, kinds, blocks, size = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("no segment begins here")
        about, at = zlib.decompress(data[HEAD.size : HEAD.size + size]), 0

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(about, kind, n, at)
            at += found.nbytes
            return found

        known, numbers = take("<u1", docs), take("<i8", docs)
        self.doc_ids = [int(d) if k else None for d, k in zip(numbers, known)]
        self.lengths = take("<u8", docs).astype(np.int64)
        self.symbols = np.cumsum(take("<u4", kinds).astype(np.int64))
        self.freq = take("<u4", kinds).astype(np.uint64)
        self.cum = np.cumsum(self.freq) - self.freq
        self.slots = np.repeat(np.arange(kinds), self.freq.astype(np.int64))
        place = HEAD.size + size
        self.entries = [ENTRY.unpack_from(data, place + ENTRY.size * i) for i in range(blocks)]

    def block(self, number: int) -> np.ndarray:
        """Ids of one block, from its checkpoint alone."""
        at, n, lanes, words, check = self.entries[number]
        body = self.data[at : at + 8 * lanes + 4 * words]
        if zlib.crc32(body) != check:
            raise ValueError(f"block {number} is damaged")
        state = np.frombuffer(body, "<u8", lanes)
        stream = np.frombuffer(body, "<u4", words, 8 * lanes).astype(np.uint64)
        found = decode_block(state, stream, n, self.freq, self.cum, self.slots, self.bits)
        return self.symbols[found]

    def documents(self) -> list[np.ndarray]:
        """Ids of each document."""
        flat = np.concatenate([self.block(i) for i in range(len(self.entries))])
        return np.split(flat, np.cumsum(self.lengths)[:-1])


# --------------------------------------------------------------------------- files

MANIFEST = (
    "part int, segment int, uri string, offset long, size long, n_docs long, n_ids long"
)


def write_files(
    docs: DataFrame,
    folder: str,
    path: str,
    end_id: int,
    id_: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Encode and write all documents; the stored manifest has one row per segment.

    Documents are dealt by ranges of ids, so files and segments in the manifest's order hold
    them in ascending order. A task keeps one segment's ids in memory at a time.
    """
    ordered = (
        docs.select(F.col(id_).cast("long").alias("_id"), F.col(text).alias("_text"))
        .repartitionByRange("_id")
        .sortWithinPartitions("_id", "_text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = common.encoder(path), TaskContext.get().partitionId()
        names, ids, held, rows, at = [], [], 0, [], 0
        uri = file = None

        def flush() -> None:
            nonlocal names, ids, held, at, uri, file
            if file is None:
                uri, file = common.new_file(folder, f"ids-{part:06d}")
            data = pack_segment(names, ids)
            file.write(data)
            rows.append((part, len(rows), uri, at, len(data), len(names), held))
            at += len(data)
            names, ids, held = [], [], 0

        for batch in common.slices(batches):
            found = coder.encode(common.texts_of(batch.column(1)))
            for name, x in zip(batch.column(0).to_pylist(), found):
                names.append(name)
                ids.append(np.append(x, end_id).astype(np.int32))
                held += len(x) + 1
                if held >= SEGMENT_IDS:
                    flush()
        if held:
            flush()
        if file is not None:
            file.close()
        columns = list(zip(*rows)) if rows else [[]] * 7
        kinds = [pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 4]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            ["part", "segment", "uri", "offset", "size", "n_docs", "n_ids"],
        )

    return common.store(ordered.mapInArrow(run, MANIFEST))


def read_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, decoded from the files.

    ``start`` is the number of ids of all documents before it. Segments decode in parallel:
    prefix sums over the files' totals and within a file give each its first position.
    """
    files = manifest.groupBy("part").agg(F.sum("n_ids").alias("_total"))
    # One row a file: that bounds the window and the broadcast.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.select("part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    inside = (
        Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = manifest.withColumn(
        "_inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))
    ).join(F.broadcast(bases), "part")
    tasks = max(1, min(manifest.count(), 4096))
    jobs = placed.select(
        "uri", "offset", "size", (F.col("_base") + F.col("_inside")).alias("first")
    ).repartition(tasks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for job in batch.to_pylist():
                with common.open_file(job["uri"]) as file:
                    segment = Segment(file.read_at(job["size"], job["offset"]))
                found = segment.documents()
                starts = job["first"] + np.cumsum(segment.lengths) - segment.lengths
                for at in range(0, len(found), common.SLICE_ROWS):
                    part = slice(at, at + common.SLICE_ROWS)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(segment.doc_ids[part], pa.int64()),
                            pa.array(starts[part]),
                            pa.array(segment.lengths[part]),
                            pa.array(
                                [x.astype("<u4").tobytes() for x in found[part]], pa.binary()
                            ),
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )

    return jobs.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
