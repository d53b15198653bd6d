"""What the text operators share: rows in, hashed words, token ids, files in the shared folder."""

from __future__ import annotations

import ctypes
import json
import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyarrow import parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from songweave.session import (
    apply_settings,
    ensure_checkpoint_dir,
    filesystem,
    small_batches,  # noqa: F401 - used by the operators
)


# Rows of one Arrow batch that are worked on at once: bounds the memory of long texts.
SLICE_ROWS = 256
# Rows that Python is handed at once, where a session doesn't say fewer.
BATCH_ROWS = 2000
# Distinct runs that an encoder remembers before it starts anew, and the bits its table begins with.
CACHE_ENTRIES = 1_500_000
TABLE_BITS = 12


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the supplied tables. From then on Python is handed at most ``BATCH_ROWS`` rows at
    once: the default of 10,000 texts is held by the JVM and by Python, in every task."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(apply_settings(spark).conf.get(rows))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def give_back() -> None:
    """Hand this process's free memory back to the system. Python workers live on between tasks,
    and what their largest task took would stay theirs."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, a task over batches, which gives free memory back at its end."""

    def tidied(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()

    return tidied


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches cut to at most ``rows`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


# --------------------------------------------------------------------------- words


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (multiply and shift)."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


# A run's bytes are read as little-endian integers of eight bytes, the last one cut off.
CUT = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
# Runs longer than this are hashed one by one.
LONG_RUN = 256


def padded(raw: bytes) -> np.ndarray:
    """The bytes and eight more, so that eight bytes can be read at any place."""
    return np.frombuffer(raw + bytes(8), np.uint8)


def eights(buffer: np.ndarray) -> np.ndarray:
    """The integer of the eight bytes at each place of a padded buffer, without a copy."""
    return np.ndarray((len(buffer) - 7,), "<u8", buffer=buffer, strides=(1,))


def run_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of runs of a padded buffer.

    A run's length and its groups of eight bytes are scrambled in, one after the other. Runs of
    one length of up to eight bytes never share a hash.
    """
    at, sizes = eights(buffer), ends - starts
    found = mix(mix(sizes.astype(np.uint64)) ^ (at[starts] & CUT[np.minimum(sizes, 8)]))
    rest, done = np.flatnonzero((sizes > 8) & (sizes <= LONG_RUN)), 8
    while len(rest):
        left = np.minimum(sizes[rest] - done, 8)
        found[rest] = mix(found[rest] ^ (at[starts[rest] + done] & CUT[left]))
        done += 8
        rest = rest[sizes[rest] > done]
    for i in np.flatnonzero(sizes > LONG_RUN).tolist():
        found[i] = xxhash.xxh3_64_intdigest(buffer[starts[i] : ends[i]].tobytes())
    return found


LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: ASCII white space: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
NOT_SPACE = ~SPACE
#: ASCII letters and digits and every byte of a character beyond ASCII.
ALNUM = np.array([chr(i).isalnum() and i < 128 for i in range(256)])
WORDISH = ALNUM | (np.arange(256) > 127)


def hash_words(texts: list[bytes], inside: np.ndarray = NOT_SPACE) -> list[np.ndarray]:
    """Hashes of each text's words in order; ``inside`` says which bytes make up words.

    A to Z count as lower case.
    """
    buffer = LOWER[padded(b" ".join(texts) + b" ")]
    cuts = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    member = np.zeros(len(buffer) - 7, np.bool_)
    member[1:] = inside[buffer[:-8]]
    edges = np.flatnonzero(member[1:] != member[:-1])
    starts, ends = edges[0::2], edges[1::2]
    return np.split(run_hashes(buffer, starts, ends), np.searchsorted(starts, cuts[:-1]))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """One hash for every ``k`` consecutive words, in order.

    Fewer than ``k`` words make one shingle of the whole sequence; no words make none. The
    number of words is mixed in, so a short sequence never equals a full shingle.
    """
    size = min(k, len(words))
    if size == 0:
        return np.empty(0, np.uint64)
    found = np.full(len(words) - size + 1, size, np.uint64)
    for j in range(size):
        found *= np.uint64(0xD6E8FEB86659FD93)
        found += words[j : len(words) - size + 1 + j]
    return mix(found)


# --------------------------------------------------------------------------- token ids

# White space beyond ASCII, and characters that libraries don't agree to call white space.
ODD = (
    "\x1c\x1d\x1e\x1f\x85\xa0\u1680\u180e\u200b\u2028\u2029\u202f\u205f\u2060\u3000\ufeff"
    + "".join(map(chr, range(0x2000, 0x200B)))
)
STOPS = np.isin(np.arange(256), [ord("."), ord(",")])


class Encoder:
    """Token ids of whole texts by a tokenizer file of the ``tokenizers`` library.

    Each distinct run of a text is encoded once by the library and remembered by its bytes, which
    are compared whole; texts are put together from their runs. Runs begin at white
    space that follows something else and at a full stop or comma that follows an ASCII
    letter or digit: a byte-level pre-tokenizer that splits by its pattern cuts there
    whatever stands around, so the result equals the library's on the whole text. Other
    tokenizers, texts with special strings and texts with white space beyond ASCII go to the
    library whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        about = json.loads(self.tokenizer.to_str())
        splitter, model = about.get("pre_tokenizer") or {}, about["model"]
        self.by_run = (
            splitter.get("type") == "ByteLevel"
            and splitter.get("use_regex", True)
            and not splitter.get("add_prefix_space")
            and about.get("normalizer") is None
            and not model.get("dropout")
            and about.get("truncation") is None
            and about.get("padding") is None
        )
        self.special = [t["content"] for t in about.get("added_tokens", [])]
        self._forget()

    def _table(self, bits: int) -> None:
        # By slot: the first 16 bytes of a run, and its number and length, 0 where free.
        self.bits = bits
        self.low = np.zeros(1 << bits, np.uint64)
        self.high = np.zeros(1 << bits, np.uint64)
        self.places = np.zeros(1 << bits, np.int32)

    def _grow(self, entries: int) -> None:
        """Make room: at least half of the table's slots stay free."""
        if entries * 2 <= 1 << self.bits:
            return
        used = np.flatnonzero(self.places)
        low, high, places = self.low[used], self.high[used], self.places[used].astype(np.int64)
        self._table((entries * 2 - 1).bit_length())
        sizes = places & 31
        self._remember(low, high, sizes, places >> 5)

    def _forget(self) -> None:
        self._table(TABLE_BITS)
        self.longer: dict[bytes, int] = {}
        self.ids = np.empty(0, np.int32)
        self.starts = np.empty(0, np.int64)
        self.counts = np.empty(0, np.int64)

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, np.int32) for x in found]

    def _whole(self, text: str) -> bool:
        odd = ODD[:4] if text.isascii() else ODD
        return any(c in text for c in odd) or any(s in text for s in self.special)

    def _slots(self, low: np.ndarray, high: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        mixed = mix(low ^ mix(high + sizes.astype(np.uint64)))
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _keys(self, buffer: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple:
        """(low, high) of runs of at most 16 bytes: with their size, all that they are."""
        at = eights(buffer)
        low = at[starts] & CUT[np.minimum(sizes, 8)]
        high = at[np.minimum(starts + 8, len(at) - 1)] & CUT[np.clip(sizes - 8, 0, 8)]
        return low, high

    def _find(self, low, high, sizes) -> np.ndarray:
        """Numbers of known runs of at most 16 bytes, -1 for others."""
        out, left = np.full(len(low), -1, np.int64), np.arange(len(low))
        slots = self._slots(low, high, sizes)
        while len(left):
            places = self.places[slots]
            hit = (self.low[slots] == low[left]) & (self.high[slots] == high[left])
            hit &= places & 31 == sizes[left]
            out[left[hit]] = places[hit] >> 5
            on = ~hit & (places != 0)
            left, slots = left[on], (slots[on] + 1) & ((1 << self.bits) - 1)
        return out

    def _remember(self, low, high, sizes, numbers: np.ndarray) -> None:
        left, slots = np.arange(len(low)), self._slots(low, high, sizes)
        while len(left):
            free = self.places[slots] == 0
            _, one = np.unique(slots[free], return_index=True)
            take = np.flatnonzero(free)[one]
            self.low[slots[take]], self.high[slots[take]] = low[left[take]], high[left[take]]
            self.places[slots[take]] = numbers[left[take]] << 5 | sizes[left[take]]
            on = np.ones(len(left), np.bool_)
            on[take] = False
            left, slots = left[on], (slots[on] + 1) & ((1 << self.bits) - 1)

    def _numbers(self, joined: bytes, buffer: np.ndarray, starts, ends) -> np.ndarray:
        """The number of each run; new ones are encoded."""
        sizes = ends - starts
        short, long = np.flatnonzero(sizes <= 16), np.flatnonzero(sizes > 16)
        keys = (*self._keys(buffer, starts[short], sizes[short]), sizes[short])
        numbers = np.full(len(starts), -1, np.int64)
        numbers[short] = self._find(*keys)
        runs = [joined[s:e] for s, e in zip(starts[long].tolist(), ends[long].tolist())]
        numbers[long] = [self.longer.get(r, -1) for r in runs]
        new = np.flatnonzero(numbers[short] < 0)
        low, high, size = (k[new] for k in keys)
        order = np.lexsort([low, high, size])
        same = (np.diff(low[order]) == 0) & (np.diff(high[order]) == 0) & (np.diff(size[order]) == 0)
        one = new[order[np.append(np.ones(min(len(order), 1), np.bool_), ~same)]]
        fresh = list(dict.fromkeys(r for r, n in zip(runs, numbers[long].tolist()) if n < 0))
        if not len(one) and not fresh:
            return numbers
        known = len(self.starts)
        if known and known + len(one) + len(fresh) > CACHE_ENTRIES:
            self._forget()
            return self._numbers(joined, buffer, starts, ends)
        self._grow(known + len(one) + len(fresh))
        first, last = starts[short][one].tolist(), ends[short][one].tolist()
        ids = self._library([joined[s:e].decode() for s, e in zip(first, last)])
        ids += self._library([r.decode() for r in fresh])
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        last = len(self.ids) + np.cumsum(counts)
        self._remember(*[k[one] for k in keys], known + np.arange(len(one)))
        self.longer.update(zip(fresh, range(known + len(one), known + len(ids))))
        self.ids = np.concatenate([self.ids, *ids])
        self.starts = np.concatenate([self.starts, last - counts])
        self.counts = np.concatenate([self.counts, counts])
        numbers[short[new]] = self._find(*[k[new] for k in keys])
        numbers[long] = [self.longer[r] for r in runs]
        return numbers

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (int32) of each text."""
        out: list = [None] * len(texts)
        by_run = []
        for i, text in enumerate(texts):
            if not self.by_run or self._whole(text):
                out[i] = self._library([text])[0]
            else:
                by_run.append(i)
        raw = [texts[i].encode() for i in by_run]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        joined = b"".join(raw)
        if not joined:
            for i in by_run:
                out[i] = np.empty(0, np.int32)
            return out
        buffer = padded(joined)
        text = buffer[:-8]
        space = SPACE[text]
        cut = np.zeros(len(text), np.bool_)
        cut[1:] = (space[1:] & ~space[:-1]) | (STOPS[text[1:]] & ALNUM[text[:-1]])
        begins = np.cumsum(sizes) - sizes
        cut[begins[sizes > 0]] = True
        starts = np.flatnonzero(cut)
        known = self._numbers(joined, buffer, starts, np.append(starts[1:], len(text)))
        counts = self.counts[known]
        last = np.cumsum(counts)
        place = np.repeat(self.starts[known] - (last - counts), counts) + np.arange(last[-1])
        ids = self.ids[place]
        runs_before = np.searchsorted(starts, np.append(begins, len(text)))
        tokens_before = np.append(0, last)[runs_before]
        for j, i in enumerate(by_run):
            out[i] = ids[tokens_before[j] : tokens_before[j + 1]]
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this process for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def tokenizer_path(name: str) -> str:
    """Where the installed vocabulary ``name`` lies (the package is part of the image)."""
    import public_tokenizers

    return public_tokenizers.path(name)


# --------------------------------------------------------------------------- shared files


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's URI below the checkpoint folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def new_file(folder: str, name: str) -> tuple[str, pa.NativeFile]:
    """Open ``folder/name-<random>`` for writing: a task that runs twice never shares a file.

    Readers go by the manifest of the attempt that Spark kept, so files of lost attempts are
    never read.
    """
    uri = f"{folder}/{name}-{uuid.uuid4().hex}"
    store, path = filesystem(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    return uri, store.open_output_stream(path, compression=None)


def open_file(uri: str) -> pa.NativeFile:
    """Open a file for range reads."""
    store, path = filesystem(uri)
    return store.open_input_file(path)


# Files of a small table for each task slot.
FILES_PER_SLOT = 4
# The tables stored within each open scope, the innermost last.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


@contextmanager
def scope() -> Iterator[None]:
    """Tables stored within it are deleted when it ends, but for those stored ``outer``."""
    own: list[str] = []
    before = _SCOPES.set((*_SCOPES.get(), own))
    try:
        yield
    finally:
        _SCOPES.reset(before)
        for uri in own:
            files, path = filesystem(uri)
            files.delete_dir(path)


def store(
    df: DataFrame, compression: str = "zstd", outer: bool = False, small: bool = False
) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back (a lineage cut that is small).

    The table lives as long as the scope it is stored in; ``outer``, as the one around that.
    ``small``: rows are a few numbers, and a few files for each task slot hold them, however many
    partitions they come from. Without Hadoop's native library a local file system starts three
    processes for every file, each a fork of the executor.
    """
    path = shared_folder(df.sparkSession, "table")
    if small:
        df = df.coalesce(FILES_PER_SLOT * df.sparkSession.sparkContext.defaultParallelism)
    df.write.option("compression", compression).parquet(path)
    scopes = _SCOPES.get()[:-1] if outer else _SCOPES.get()
    if scopes:
        scopes[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Rows of a file that are looked up together, as a power of two, and the lost rows in a bucket.
CHUNK_BITS = 20
BUCKET_ROWS = 1 << 13


def placed(docs: DataFrame) -> tuple[DataFrame, Column, Column]:
    """``docs`` with the columns of each row's file and its place in that file.

    A frame that isn't read from Parquet files is stored first. One that is must not repeat
    their rows, as an explode would.
    """
    try:
        docs.select(docs.metadataColumn("_metadata")["row_index"])
    except AnalysisException:
        docs = store(docs)
    origin = docs.metadataColumn("_metadata")
    return docs, origin["file_path"], origin["row_index"]


def without_rows(docs: DataFrame, file: Column, row: Column, lost: DataFrame) -> DataFrame:
    """``docs`` but for the rows at the places ``lost`` (file, row), by the columns of ``placed``.

    Neither texts nor other columns of ``docs`` are shuffled: the places are stored in buckets by
    file and chunk of rows, and a task reads the places lost in the chunks it meets, one at a time.
    """
    lost = store(lost.select("file", "row").distinct(), small=True)
    buckets = max(1, -(-lost.count() // BUCKET_ROWS))

    def bucket(file: Column, row: Column) -> Column:
        chunk = F.shiftright(row.cast("long"), CHUNK_BITS)
        return F.pmod(F.xxhash64(file, chunk), F.lit(buckets)).cast("int")

    folder = shared_folder(docs.sparkSession, "lost")
    dealt = lost.withColumn("bucket", bucket(F.col("file"), F.col("row"))).repartition("bucket")
    dealt.sortWithinPartitions("bucket", "file", "row").write.partitionBy("bucket").parquet(folder)
    if _SCOPES.get():
        _SCOPES.get()[-1].append(folder)

    def lost_in(number: int, name: str, chunk: int) -> np.ndarray:
        files, path = filesystem(f"{folder}/bucket={number}")
        if files.get_file_info(path).type == fs.FileType.NotFound:
            return np.empty(0, np.int64)
        first = chunk << CHUNK_BITS
        within = [("file", "=", name), ("row", ">=", first), ("row", "<", first + (1 << CHUNK_BITS))]
        found = pq.read_table(path, columns=["row"], filters=within, filesystem=files, partitioning=None)
        return found.column("row").to_numpy()

    @F.pandas_udf("boolean")
    def stays(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        at, gone = None, np.empty(0, np.int64)
        for names, rows, numbers in batches:
            codes, files = pd.factorize(names)
            places, keep = rows.to_numpy(np.int64), np.ones(len(rows), np.bool_)
            chunks = np.stack([codes, places >> CHUNK_BITS], 1)
            for code, chunk in np.unique(chunks, axis=0).tolist():
                mine = (chunks == (code, chunk)).all(1)
                if at != (files[code], chunk):
                    at = files[code], chunk
                    gone = lost_in(int(numbers[mine].iloc[0]), *at)
                keep[mine] = ~np.isin(places[mine], gone)
            yield pd.Series(keep)

    return docs.where(stays(file, row, bucket(file, row)))


# Tasks' results that one task puts together.
FAN = 8


def merged_parts(states: DataFrame, together: Callable, schema: str, *by: str) -> DataFrame:
    """The rows left after merging states in groups of ``FAN`` parts, round by round: one, or one
    for each value of ``by``.

    A state has its task's number as ``part``; ``together`` makes one, of part // ``FAN``, of a
    pandas frame of those of a group. No rows without any.
    """
    states = store(states)
    most = states.agg(F.max("part")).first()[0]
    while most is not None and most > 0:
        group = F.floor(F.col("part") / FAN).alias("group")
        states = store(states.groupBy(*by, group).applyInPandas(together, schema))
        most //= FAN
    return states


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have, in any case of letters: ``name``, lengthened."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> str:
    """A column's name as Spark reads it, dots and all."""
    return "`" + name.replace("`", "``") + "`"


def texts_of(column: pa.Array) -> list[str]:
    """The strings of a column; null counts as empty."""
    return [t or "" for t in column.to_pylist()]


def bytes_of(column: pa.Array) -> list[bytes]:
    """The strings of a column in UTF-8; null counts as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]
