"""Chat formatting by prefix-target expansion: every assistant turn is an example of its own.

A conversation is one stream of segments, a segment a turn between its markers. An example is
a prefix of the stream, all turns before an assistant turn and that turn, of which only the
turn's text is trainable. Examples of one conversation share their prefix, so they are kept as
spans into the stream and the output grows with the turns, not with their square; ``render``
writes examples out where they are wanted.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``. Within roles and texts ``<|`` gets a backslash
between its signs, and ``<\\|`` with any number of backslashes one more, so no marker can occur
in them and unescaping takes one away. In roles a backslash and a line feed are escaped first.

Edge cases: null texts and roles are empty; turns are ordered by number (null first), then by
role and text, so repeated rows and ties have one order and all stay; rows with a null
conversation id are one conversation; a conversation without an assistant turn has no example
and no loss text; an empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from songweave.llm.common import slices, store

START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"

SEGMENTS = (
    "conv_id long, position long, example long, segment string, start long, end long, "
    "loss_start long, loss_end long"
)
READ = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, examples long, expanded_chars long"
)


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    plain = unescape(role)
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], plain)


def parse(segment: str) -> tuple[str, str]:
    """(role, text) of a segment."""
    if not segment.startswith(START) or not segment.endswith(END + "\n"):
        raise ValueError("a segment lacks its markers")
    role, _, text = segment[len(START) : -len(END) - 1].partition("\n")
    return unescape_role(role), unescape(text)


def expand(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Segments of all conversations, stored: place in the stream, example and loss span.

    Spans count characters of the stream. ``example`` numbers the assistant turns from 0: that
    example's context is the stream before ``loss_start``, its target the loss span. A task
    reads its conversations in order and keeps two numbers for each, so a conversation may be
    of any length, but is one task's work.
    """
    ordered = (
        turns.select(
            F.col(conv).cast("long").alias("conv_id"),
            F.col(turn).alias("turn"),
            F.coalesce(role, F.lit("")).alias("role"),
            F.coalesce(text, F.lit("")).alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, position, example, at = object(), 0, 0, 0
        for batch in slices(batches):
            out = []
            for row in batch.to_pylist():
                if row["conv_id"] != current:
                    current, position, example, at = row["conv_id"], 0, 0, 0
                head = f"{START}{escape_role(row['role'])}\n"
                body = escape(row["text"])
                segment = f"{head}{body}{END}\n"
                trained = row["role"] == TRAINED
                loss = at + len(head)
                out.append(
                    (
                        current,
                        position,
                        example if trained else None,
                        segment,
                        at,
                        at + len(segment),
                        loss if trained else None,
                        loss + len(body) if trained else None,
                    )
                )
                position, at, example = position + 1, at + len(segment), example + trained
            yield _batch(out, SEGMENTS)

    return store(ordered.mapInArrow(run, SEGMENTS))


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)], [n for n, _ in fields]
    )


def read_back(segments: DataFrame) -> DataFrame:
    """What the output says of every conversation: its turns parsed from the segments in order,
    its loss text and lengths taken from the target span of each of its examples."""
    spans = examples(segments).select(
        F.col("conv_id").alias("conv"),
        F.col("position").alias("at"),
        "context_end",
        "target_start",
        "target_end",
    )
    same = F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("position") == F.col("at"))
    ordered = (
        segments.select("conv_id", "position", "segment", "start")
        .join(spans, same, "left")
        .drop("conv", "at")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "position")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None

        def done() -> tuple:
            return (
                current,
                state["turns"],
                state["sha"].hexdigest(),
                state["loss"],
                state["loss_sha"].hexdigest(),
                state["chars"],
                state["examples"],
                state["expanded"],
            )

        for batch in slices(batches):
            out = []
            for row in batch.to_pylist():
                if state is None or row["conv_id"] != current:
                    if state:
                        out.append(done())
                    current = row["conv_id"]
                    state = dict.fromkeys(("turns", "loss", "chars", "examples", "expanded"), 0)
                    state |= {"sha": hashlib.sha256(), "loss_sha": hashlib.sha256()}
                segment = row["segment"]
                role, text = parse(segment)
                state["turns"] += 1
                state["sha"].update(f"{role}\n{text}\n".encode())
                state["chars"] += len(segment)
                if row["target_start"] is not None:
                    # The context is the stream up to the target, the example ends with its turn.
                    span = slice(row["context_end"] - row["start"], row["target_end"] - row["start"])
                    loss = unescape(segment[span])
                    state["loss"] += len(loss)
                    state["loss_sha"].update(loss.encode())
                    state["examples"] += 1
                    state["expanded"] += row["target_end"] + len(END) + 1
            if out:
                yield _batch(out, READ)
        if state:
            yield _batch([done()], READ)

    return ordered.mapInArrow(run, READ)


def examples(segments: DataFrame) -> DataFrame:
    """One row per assistant turn: the stream's span that is context, and the target's."""
    return segments.where("example is not null").select(
        "conv_id",
        "example",
        "position",
        F.lit(0).cast("long").alias("context_start"),
        F.col("loss_start").alias("context_end"),
        F.col("loss_start").alias("target_start"),
        F.col("loss_end").alias("target_end"),
    )


def render(segments: DataFrame, wanted: DataFrame) -> DataFrame:
    """(conv_id, example, text, target_start, target_end) of the ``wanted`` examples.

    Written-out contexts repeat the stream for every example; their size is the caller's choice.
    """
    chosen = examples(segments).join(wanted.select("conv_id", "example"), ["conv_id", "example"])
    parts = chosen.withColumnRenamed("position", "last").join(
        segments.select("conv_id", "position", "segment"), "conv_id"
    )
    ordered = F.array_sort(F.collect_list(F.struct("position", "segment")))
    return (
        parts.where("position <= last")
        .groupBy("conv_id", "example", "target_start", "target_end")
        .agg(F.array_join(F.transform(ordered, lambda x: x["segment"]), "").alias("text"))
        .select("conv_id", "example", "text", "target_start", "target_end")
    )
