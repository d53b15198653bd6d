"""Packing: concatenate all token sequences and cut the stream into fixed windows.

Two passes: the first encodes every document, keeps its ids in a stored table and so fixes
each task's token total; prefix sums over the totals give every document its place in the
global stream. The second cuts each document at the window bounds. Every id lies in exactly one
piece; only the last sequence is short.

Edge cases: a null or empty text is its end id alone; rows with a null or a repeated id are
documents of their own; equal texts are packed once each; an empty table gives no pieces.
Columns beside id and text are not looked at. The order of documents is that of the stored
table: tasks by number, rows as the task read them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from songweave.llm import common

# Texts that Python is handed at once.
BATCH_ROWS = 1000


def encode_documents(docs: DataFrame, path: str, end_id: int, id_: str, text: str) -> DataFrame:
    """First pass: (part, local_start, doc_id, n, ids) of every document, stored."""
    kind = docs.schema[id_].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, at = common.encoder(path), TaskContext.get().partitionId(), 0
        for batch in common.slices(batches):
            found = coder.encode(common.texts_of(batch.column(1)))
            counts = np.fromiter(map(len, found), np.int64, len(found)) + 1
            starts = at + np.cumsum(counts) - counts
            at += int(counts.sum())
            # Two bytes an id where the vocabulary allows it.
            packed = [np.append(ids, end_id).astype(width).tobytes() for ids in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(found), part, np.int32)),
                    pa.array(starts),
                    batch.column(0),
                    pa.array(counts),
                    pa.array(packed, pa.binary()),
                ],
                ["part", "local_start", id_, "n", "ids"],
            )

    width = id_width(path, end_id)
    return common.store(
        docs.select(id_, text).mapInArrow(
            common.tidy(run), f"part int, local_start long, `{id_}` {kind}, n long, ids binary"
        )
    )


def id_width(path: str, end_id: int) -> str:
    """The little-endian type that holds every id."""
    largest = max(common.encoder(path).tokenizer.get_vocab_size() - 1, end_id)
    return "<u2" if largest < 1 << 16 else "<u4"


def pack(
    docs: DataFrame,
    path: str,
    end_id: int,
    size: int = 2048,
    id_: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces: id, start, length, ids (binary, little-endian unsigned 32 bit), doc_tokens,
    sequence_id, offset, and ``boundary``: whether a window's bound cut the document there
    ("none", "head" for a first piece, "middle", "tail").
    """
    with common.small_batches(docs.sparkSession, BATCH_ROWS):
        stored = encode_documents(docs, path, end_id, id_, text)
    totals = stored.groupBy("part").agg(F.sum("n").alias("total"))
    # One row for each task that wrote the table: that bounds the window and the broadcast.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    placed = stored.join(F.broadcast(bases), "part").select(
        id_, (F.col("base") + F.col("local_start")).alias("at"), "n", "ids"
    )
    kind = docs.schema[id_].dataType.simpleString()
    width = id_width(path, end_id)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            at, n = (batch.column(c).to_numpy().astype(np.int64) for c in ("at", "n"))
            first, last = at // size, (at + n - 1) // size
            pieces = last - first + 1
            row = np.repeat(np.arange(len(at)), pieces)
            sequence = first[row] + np.arange(len(row)) - np.repeat(
                np.cumsum(pieces) - pieces, pieces
            )
            begin = np.maximum(sequence * size, at[row])
            end = np.minimum((sequence + 1) * size, (at + n)[row])
            ids = [
                np.frombuffer(x, width).astype("<u4").tobytes()
                for x in batch.column("ids").to_pylist()
            ]
            bounds = zip(row.tolist(), (begin - at[row]).tolist(), (end - at[row]).tolist())
            boundary = np.where(
                pieces[row] == 1,
                "none",
                np.where(
                    sequence == first[row],
                    "head",
                    np.where(sequence == last[row], "tail", "middle"),
                ),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(id_).take(pa.array(row)),
                    pa.array(begin - at[row]),
                    pa.array(end - begin),
                    pa.array([ids[r][4 * b : 4 * e] for r, b, e in bounds], pa.binary()),
                    pa.array(n[row]),
                    pa.array(sequence),
                    pa.array(begin - sequence * size),
                    pa.array(boundary.tolist(), pa.string()),
                ],
                [id_, "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "boundary"],
            )

    return placed.mapInArrow(
        cut,
        f"`{id_}` {kind}, start long, length long, ids binary, doc_tokens long, "
        "sequence_id long, offset long, boundary string",
    )


def sequences(pieces: DataFrame, size: int = 2048, pad_id: int = 0) -> DataFrame:
    """(sequence_id, n_tokens, ids) put together from pieces; a window bounds each group.

    A short sequence is padded to ``size`` unless its length is a power of two.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    whole = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), joined.alias("ids")
    )
    power = F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) == 0
    missing = F.when(power, 0).otherwise(size - F.col("n_tokens")).cast("int")
    pad = F.unhex(F.repeat(F.lit(int(pad_id).to_bytes(4, "little").hex()), missing))
    return whole.select("sequence_id", "n_tokens", F.concat("ids", pad).alias("ids"))
