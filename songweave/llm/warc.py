"""WARC archives with a two-level capture index.

Archives hold one gzip member per record, written by ranges of page ids. The index holds one
line per capture, sorted by the URL with its host reversed: lines are cut into compressed
blocks, and a sparse directory keeps each block's first and last key. A lookup searches the
directory by bisection, reads the blocks it names, bisects their lines and reads the records by
their byte ranges.

Of records with equal payloads of at least ``REVISIT_BYTES`` bytes the one with the smallest
page id is a response, the others revisit it and carry no payload. Each record states the
digest and length of its full payload.

Edge cases: a null page is an empty payload; a null URL has the empty key; rows that repeat a
page id are records of their own, and of those with equal payloads one is the response; a null
page id is written as such and is never revisited; empty tables give no archive and no rows.
Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from songweave.llm import common
from songweave.llm.common import store

REVISIT_BYTES = 100
BLOCK_LINES = 3000
TASK_BYTES = 32 << 20  # of archives, read by a task
READ_BYTES = 4 << 20  # neighbouring records are read together up to this
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"

CAPTURES = "key string, page_id long, uri string, offset long, size long, type string"
BLOCKS = "part int, block int, first_key string, last_key string, lines long, data binary"
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)


def url_key(url: str | None) -> str:
    """A URL's sort key: its host reversed, then path and query, in lower case."""
    rest = (url or "").split("://", 1)[-1]
    host, slash, path = rest.partition("/")
    host = host.split("@")[-1].lower()
    name, _, port = host.partition(":")
    reversed_ = ",".join(reversed(name.split("."))) + (f":{port}" if port else "")
    return f"{reversed_}){slash}{path.lower()}" if rest else ""


def _field(text: str) -> str:
    """A header value on one line: control characters and per cent signs become %XX."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 33 or c == "%" or ord(c) == 127 else c for c in text)


def _plain(text: str) -> str:
    parts = text.split("%")
    return parts[0] + "".join(chr(int(p[:2], 16)) + p[2:] for p in parts[1:])


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _number(name: str) -> int | None:
    value = name.removeprefix("<urn:page:").removesuffix(">")
    return None if value == "none" else int(value)


def record(page_id, url, payload, digest: str, size: int, refers_to, date: str) -> bytes:
    """One WARC record; ``payload`` is None for a revisit."""
    revisit = payload is None
    block = HTTP + b"Content-Length: %d\r\n\r\n" % size + (payload or b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Date: {date}",
        *([] if url is None else [f"WARC-Target-URI: {_field(url)}"]),
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {size}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Headers and payload of a record; the stated digest and length hold for revisits."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no record begins here")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record doesn't end where it says")
    revisit = fields["WARC-Type"] == "revisit"
    payload = None if revisit else block.partition(b"\r\n\r\n")[2]
    stated = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    digest = stated if revisit else hashlib.sha256(payload).hexdigest()
    if digest != stated:
        raise ValueError("a payload differs from its digest")
    url = fields.get("WARC-Target-URI")
    return {
        "page_id": _number(fields["WARC-Record-ID"]),
        "url": None if url is None else _plain(url),
        "payload_bytes": int(fields["X-Payload-Length"]) if revisit else len(payload),
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": _number(fields["WARC-Refers-To"]) if revisit else None,
        "payload": payload,
    }


def _member(raw: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def write_archives(
    pages: DataFrame,
    folder: str,
    date: str = "1970-01-01T00:00:00Z",
    id_: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """Write all pages; the stored captures have one row per record."""
    content = F.coalesce(html, F.lit(""))
    prepared = pages.select(
        F.col(id_).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        content.cast("binary").alias("payload"),
        F.octet_length(content).cast("long").alias("bytes"),
        F.sha2(content.cast("binary"), 256).alias("digest"),
    )
    shared = store(
        prepared.where(F.col("bytes") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first is not null")
        .select("digest", "first")
    )
    # Payloads that are certain to be revisits aren't moved.
    ordered = (
        prepared.join(shared, "digest", "left")
        .withColumn(
            "payload",
            F.when(F.col("first").isNull() | F.col("page_id").eqNullSafe(F.col("first")), F.col("payload")),
        )
        .repartitionByRange("page_id")
        .sortWithinPartitions("page_id", "digest", "url")
        .select("page_id", "url", "payload", "bytes", "digest", "first")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, uri, file, before = TaskContext.get().partitionId(), 0, None, None, None
        for batch in common.slices(batches):
            rows = []
            for row in batch.to_pylist():
                if file is None:
                    uri, file = common.new_file(folder, f"pages-{part:06d}")
                page_id, payload, first = row["page_id"], row["payload"], row["first"]
                same = (page_id, row["digest"])
                if first is not None and same == before:
                    payload = None
                before = same
                data = _member(
                    record(page_id, row["url"], payload, row["digest"], row["bytes"], first, date)
                )
                file.write(data)
                kind = "revisit" if payload is None else "response"
                rows.append((url_key(row["url"]), page_id, uri, at, len(data), kind))
                at += len(data)
            yield _rows(rows, CAPTURES)
        if file is not None:
            file.close()

    return store(ordered.mapInArrow(run, CAPTURES))


KINDS = {"long": pa.int64(), "string": pa.string(), "int": pa.int32(), "binary": pa.binary()}


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, KINDS[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields]
    )


def write_index(captures: DataFrame) -> DataFrame:
    """Stored blocks: compressed lines and, beside them, the directory's entries."""
    ordered = captures.repartitionByRange("key", "page_id", "offset").sortWithinPartitions(
        "key", "page_id", "uri", "offset"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, []

        def block(lines: list) -> pa.RecordBatch:
            data = zlib.compress("\n".join(json.dumps(x) for x in lines).encode(), 6)
            return _rows([(part, number, lines[0][0], lines[-1][0], len(lines), data)], BLOCKS)

        for batch in batches:
            held += [list(row.values()) for row in batch.to_pylist()]
            while len(held) >= BLOCK_LINES:
                yield block(held[:BLOCK_LINES])
                number, held = number + 1, held[BLOCK_LINES:]
        if held:
            yield block(held)

    return store(ordered.mapInArrow(run, BLOCKS))


def _lines(data: bytes) -> list[list]:
    return [json.loads(line) for line in zlib.decompress(data).decode().split("\n")]


def all_captures(index: DataFrame) -> DataFrame:
    """Every line of the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                yield _rows(_lines(data), CAPTURES)

    return index.select("data").mapInArrow(run, CAPTURES)


def find_captures(index: DataFrame, urls: DataFrame, url: str = "url") -> DataFrame:
    """Lines of the wanted URLs.

    The driver keeps one key range per index file, a number that the writer's partitions bound.
    A file's directory entries are bisected in a task, and only named blocks are unpacked.
    """
    directory = index.drop("data")
    ranges = (
        directory.groupBy("part")
        .agg(F.min("first_key").alias("lo"), F.max("last_key").alias("hi"))
        .orderBy("lo", "part")
        .collect()
    )
    lows, highs = [r["lo"] for r in ranges], [r["hi"] for r in ranges]
    parts = [r["part"] for r in ranges]

    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key in {url_key(u) for u in batch["url"]}:
                # Ranges of files touch only at their ends, so both ends ascend.
                for at in range(bisect_left(highs, key), bisect_right(lows, key)):
                    rows.append((key, parts[at]))
            yield pd.DataFrame(rows, columns=["key", "part"]).astype({"part": "int32"})

    keys = (
        urls.select(F.col(url).alias("url")).mapInPandas(locate, "key string, part int").distinct()
    )

    def entries(key: tuple, wanted: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values("block")
        first, last = blocks["first_key"].tolist(), blocks["last_key"].tolist()
        named: dict[int, list[str]] = {}
        for k in wanted["key"]:
            for at in range(bisect_left(last, k), bisect_right(first, k)):
                named.setdefault(int(blocks["block"].iloc[at]), []).append(k)
        # Keys of a block travel together, so that its data is copied once for many of them.
        rows = [
            (key[0], block, found[at : at + BLOCK_LINES])
            for block, found in named.items()
            for at in range(0, len(found), BLOCK_LINES)
        ]
        return pd.DataFrame(rows, columns=["part", "block", "keys"])

    named = (
        keys.groupBy("part")
        .cogroup(directory.groupBy("part"))
        .applyInPandas(entries, "part int, block int, keys array<string>")
    )

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for keys, data in batch[["keys", "data"]].itertuples(index=False):
                lines = _lines(data)
                held, rows = [line[0] for line in lines], []
                for key in keys:
                    rows += lines[bisect_left(held, key) : bisect_right(held, key)]
                yield pd.DataFrame(
                    rows, columns=["key", "page_id", "uri", "offset", "size", "type"]
                ).astype({"page_id": "Int64", "offset": "int64", "size": "int64"})

    return named.join(index, ["part", "block"]).mapInPandas(read, CAPTURES)


def read_records(captures: DataFrame, payload: bool = True) -> DataFrame:
    """Records by range reads of the archives; neighbours in a file are read together.

    Captures are a few numbers a record: tasks are dealt by the bytes that they read.
    """
    captures = common.store(captures.select("uri", "offset", "size"))
    total, rows = captures.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("uri")).first()
    cores = captures.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, -(-total // TASK_BYTES), min(cores, rows))
    ordered = (
        captures.repartitionByRange(int(tasks), "uri", "offset")
        .sortWithinPartitions("uri", "offset")
    )
    names = [f.split()[0] for f in RECORDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri, file = None, None
        for batch in common.slices(batches):
            jobs, at = batch.to_pylist(), 0
            while at < len(jobs):
                start, end = jobs[at]["offset"], jobs[at]["offset"] + jobs[at]["size"]
                to = at + 1
                while (
                    to < len(jobs)
                    and jobs[to]["uri"] == jobs[at]["uri"]
                    and jobs[to]["offset"] == end
                    and end - start < READ_BYTES
                ):
                    end += jobs[to]["size"]
                    to += 1
                if jobs[at]["uri"] != uri:
                    if file is not None:
                        file.close()
                    uri = jobs[at]["uri"]
                    file = common.open_file(uri)
                data = file.read_at(end - start, start)
                rows = []
                for job in jobs[at:to]:
                    place = job["offset"] - start
                    found = parse_record(zlib.decompress(data[place : place + job["size"]], 31))
                    if not payload:
                        found["payload"] = None
                    rows.append(tuple(found[n] for n in names))
                yield _rows(rows, RECORDS)
                at = to
        if file is not None:
            file.close()

    return ordered.mapInArrow(run, RECORDS)
