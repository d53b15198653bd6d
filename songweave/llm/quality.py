"""Quality classifier: logistic regression over hashed word n-grams, trained by
follow-the-regularised-leader updates and scored as sparse dot products.

A text's words are runs of letters and digits, or runs of other signs, so "word$$$" has two.
Its features are all words and pairs of neighbouring words, hashed to ``2 ** bits`` weights and
weighted so that they sum to one; a bias comes on top. A pair of equal words is one feature
whatever the word, which tells stuttering texts of words never seen.

Edge cases: a null or empty text has no features and scores by the bias alone; documents
without a label, with a null label or with a null id are scored but teach nothing; of
contradicting labels of one document the smaller counts; equal texts score alike; an empty
table gives no rows. Without any label the score is 0.5 throughout. Columns beside id and text
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from songweave.llm import common

# Byte classes: 0 white space, 1 letters, digits and all beyond ASCII, 2 other signs.
CLASSES = np.where(common.SPACE, 0, np.where(common.WORDISH, 1, 2)).astype(np.int8)
#: Any word followed by itself.
REPEATED = np.uint64(1)


@dataclass(frozen=True)
class Settings:
    """``sample``: at most so many labelled documents are learnt from, those first in the
    order of a hash of their id. A shard for every ``shard_rows`` of them learns on its own,
    in ``epochs`` passes, and the shards are averaged. The rest are the updates' own
    parameters."""

    sample: int = 24_000
    shard_rows: int = 6_000
    epochs: int = 2
    bits: int = 18
    alpha: float = 50.0
    beta: float = 1.0
    l1: float = 1e-6
    l2: float = 1e-6


@dataclass(frozen=True)
class Model:
    """Weights of the hashed features and the bias."""

    weights: np.ndarray
    bias: float


def text_features(texts: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all texts in a row, and how many belong to each text."""
    # A space after each text ends its last word and keeps pairs within the text.
    buffer = common.padded(b" ".join(texts) + b" ")
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    kind = CLASSES[buffer[:-8]]
    starts = np.flatnonzero(np.diff(kind, prepend=np.int8(0)) * kind)
    ends = np.flatnonzero(np.diff(kind, append=np.int8(0)) * kind) + 1
    words = common.run_hashes(buffer, starts, ends)
    owner = np.searchsorted(np.cumsum(sizes), starts, side="right")
    pairs = common.mix(words[:-1] + np.uint64(7)) + words[1:]
    pairs[words[:-1] == words[1:]] = REPEATED
    within = owner[:-1] == owner[1:]
    found = np.concatenate([words, pairs[within]])
    owners = np.concatenate([owner, owner[:-1][within]])
    index = (common.mix(found) >> np.uint64(64 - bits)).astype(np.int64)
    return index, owners


def sums(values: np.ndarray, owners: np.ndarray, texts: int) -> np.ndarray:
    return np.bincount(owners, weights=values, minlength=texts)


def scores(model: Model, texts: list[bytes]) -> np.ndarray:
    """Probability of label 1 for each text."""
    bits = len(model.weights).bit_length() - 1
    index, owners = text_features(texts, bits)
    counts = np.bincount(owners, minlength=len(texts))
    dots = sums(model.weights[index], owners, len(texts)) / np.maximum(counts, 1)
    return 1.0 / (1.0 + np.exp(-np.clip(dots + model.bias, -35, 35)))


def train_shard(texts: list[bytes], labels: np.ndarray, settings: Settings) -> Model:
    """One shard's weights: an update of the touched coordinates for every document."""
    size = (1 << settings.bits) + 1  # the last one is the bias
    z, n = np.zeros(size), np.zeros(size)
    rows = []
    for text in texts:
        index, _ = text_features([text], settings.bits)
        found, counts = np.unique(index, return_counts=True)
        values = np.append(counts / max(len(index), 1), 1.0)
        rows.append((np.append(found, size - 1).astype(np.int32), values))

    def weights(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        slack = np.sign(zs) * settings.l1 - zs
        rate = (settings.beta + np.sqrt(ns)) / settings.alpha + settings.l2
        return np.where(np.abs(zs) <= settings.l1, 0.0, slack / rate)

    for _ in range(settings.epochs):
        for (index, values), label in zip(rows, labels):
            zs, ns = z[index], n[index]
            w = weights(zs, ns)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ values, -35, 35)))
            gradient = (p - label) * values
            grown = ns + gradient * gradient
            z[index] = zs + gradient - (np.sqrt(grown) - np.sqrt(ns)) / settings.alpha * w
            n[index] = grown
    w = weights(z, n)
    return Model(w[:-1], float(w[-1]))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings = Settings(),
    id_: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> Model:
    """Learn from the labelled rows of ``labels``; the driver gets one weight vector a shard."""
    picked = (
        labels.where(F.col(id_).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(id_).alias("_id"))
        .agg(F.min(label).cast("double").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(settings.sample)
    )
    picked = common.store(picked)
    shards = max(1, -(-picked.count() // settings.shard_rows))
    # At most ``sample`` ids and labels: a proven bound.
    rows = (
        docs.select(F.col(id_).alias("_id"), F.coalesce(text, F.lit("")).alias("_text"))
        .join(F.broadcast(picked), "_id")
        .withColumn("_shard", F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(shards)))
    )

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        # An order that repeats on every run.
        pdf = pdf.sort_values(["_id", "_text"])
        pdf = pdf.sample(frac=1.0, random_state=7)
        model = train_shard(
            [t.encode() for t in pdf["_text"]], pdf["_label"].to_numpy(), settings
        )
        packed = np.append(model.weights, model.bias).astype("<f8").tobytes()
        common.give_back()
        return pd.DataFrame({"weights": [packed], "rows": [len(pdf)]})

    found = rows.groupBy("_shard").applyInPandas(learn, "weights binary, rows long").collect()
    if not found:
        return Model(np.zeros(1 << settings.bits), 0.0)
    parts = np.array([np.frombuffer(r["weights"], "<f8") for r in found])
    mean = np.average(parts, axis=0, weights=[r["rows"] for r in found])
    return Model(mean[:-1].astype(np.float32), float(mean[-1]))


def score(
    docs: DataFrame, model: Model, id_: str = "doc_id", text: str = "text", out: str = "score"
) -> DataFrame:
    """(id, score) of every row of ``docs``. The model has a fixed size and is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches):
            found = scores(shared.value, common.bytes_of(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.float64())], [id_, out]
            )

    kind = docs.schema[id_].dataType.simpleString()
    return docs.select(id_, text).mapInArrow(run, f"`{id_}` {kind}, `{out}` double")


def with_score(
    docs: DataFrame, model: Model, text: str = "text", out: str = "_score"
) -> DataFrame:
    """All columns of ``docs`` and its score as ``out``, row by row, without a join.

    A column named ``out`` would be lost, so ``docs`` mustn't have one: ``common.fresh`` makes up
    a name."""
    if out.lower() in map(str.lower, docs.columns):
        raise ValueError(f"the documents have a column {out} already")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        found = []
        values = texts.tolist()
        for at in range(0, len(values), common.SLICE_ROWS):
            part = [(t or "").encode() for t in values[at : at + common.SLICE_ROWS]]
            found.append(scores(shared.value, part))
        return pd.Series(np.concatenate(found) if found else np.empty(0))

    return docs.withColumn(out, scored(F.col(text)))
