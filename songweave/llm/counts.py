"""Token counts of whole texts through a cache keyed by content and tokenizer digests.

Only texts whose digest isn't in the cache are encoded, each distinct text once; their counts
are appended. Counts equal the library's on the whole text.

Edge cases: a null text counts as the empty text; an empty text has no tokens; equal texts
share one entry whatever their ids, and every row, repeated or with a null id, comes back
once; an empty table gives no rows and appends nothing. Columns beside id and text are not
looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from songweave.llm import common

CACHE = T.StructType(
    [
        T.StructField("digest", T.BinaryType()),
        T.StructField("n_tokens", T.LongType()),
    ]
)


def tokenizer_version(path: str) -> str:
    """A digest of the tokenizer file and of the library that reads it."""
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    found = hashlib.sha256(f"{library.__name__} {library.__version__}\n".encode())
    with open(path, "rb") as file:
        found.update(file.read())
    return found.hexdigest()


_PIECES: dict = {}


def library_counts(path: str, texts: list[str]) -> list[int]:
    """Tokens of each text without begin, end or added special tokens."""
    if not path.endswith(".model"):
        return [len(ids) for ids in common.encoder(path).encode(texts)]
    if path not in _PIECES:
        import sentencepiece

        _PIECES[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return [len(ids) for ids in _PIECES[path].encode(texts, num_threads=1)]


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            counts = library_counts(path, common.texts_of(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"]
            )

    return run


def read_cache(df: DataFrame, cache: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer version, one row per digest."""
    spark = df.sparkSession
    store = spark._jvm.org.apache.hadoop.fs.Path(f"{cache}/version={version}")
    if not store.getFileSystem(spark._jsc.hadoopConfiguration()).exists(store):
        return spark.createDataFrame([], CACHE)
    stored = spark.read.schema(CACHE).parquet(f"{cache}/version={version}")
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(
    docs: DataFrame, path: str, cache: str, id_: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, digest, n_bytes, n_tokens) of every row; new counts are appended to ``cache``.

    ``path`` is the tokenizer file on every machine, ``cache`` a folder all machines share.
    An append that ran twice does no harm, as entries of one digest agree.
    """
    version = tokenizer_version(path)
    content = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(
        F.col(id_),
        content.alias("text"),
        F.unhex(F.sha2(content, 256)).alias("digest"),
        F.octet_length(content).cast("long").alias("n_bytes"),
    )
    known = read_cache(docs, cache, version)
    # One text per digest leaves each task, so a group of copies is no burden anywhere.
    missing = (
        keyed.groupBy("digest")
        .agg(F.first("text").alias("text"))
        .join(known, "digest", "left_anti")
    )
    missing.mapInArrow(_encode(path), CACHE).write.mode("append").parquet(
        f"{cache}/version={version}"
    )
    counted = read_cache(docs, cache, version)
    return keyed.drop("text").join(counted, "digest", "left")


def cache_folder(docs: DataFrame) -> str:
    """A new, empty cache in the shared folder."""
    return common.shared_folder(docs.sparkSession, "token-counts")
