"""A corpus from raw documents to packed training sequences, one operator a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from songweave.llm import common, decontaminate, jaccard, packing, quality
from songweave.llm.queries import BYTE_BPE, QUALITY_THRESHOLD, quality_model

# Near-duplicate stages compare sets of five-word shingles at a Jaccard similarity of 0.8.
SHINGLE, NUM, DEN = 5, 8, 10
END_ID = 1


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject. Rows keep all their columns,
    whatever their names; a null or empty text scores by the bias; repeated rows share one fate."""
    model = quality_model(spark, docs, sf_dir)
    score = common.fresh(docs, "score")
    scored = quality.with_score(docs, model, out=score)
    return scored.where(F.col(score) >= QUALITY_THRESHOLD).select(*map(common.quoted, docs.columns))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of the n-gram Jaccard join of texts.

    Documents without words link with nothing and stay, as do rows with a null id. Of rows
    that repeat one id, one row of each text stays, unless its own text's component has a
    smaller id. Rows keep all their columns, whatever their names."""
    groups = jaccard.jaccard_components(docs, SHINGLE, NUM, DEN, by_text=True)
    dropped = groups.where("doc_id <> component_id").select("doc_id", "mark").distinct()
    docs, file, row = common.placed(docs)
    texts = common.store(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.xxhash64("text").alias("mark"),
            file.alias("file"),
            row.alias("row"),
        )
    )
    repeated = (
        texts.where("doc_id is not null")
        .groupBy("doc_id", "mark")
        .agg(F.min(F.struct("file", "row")).alias("first"), F.count(F.lit(1)).alias("rows"))
        .where("rows > 1")
    )
    lost = texts.join(dropped, ["doc_id", "mark"]).select("file", "row")
    again = texts.join(repeated, ["doc_id", "mark"]).where(F.struct("file", "row") != F.col("first"))
    return common.without_rows(docs, file, row, lost.unionAll(again.select("file", "row")))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item. Rows with a null id can't be named and stay;
    rows that share an id with a leaking row go with it. Rows keep all their columns, whatever
    their names."""
    items = common.read_table(spark, sf_dir, "benchmark")
    leaks = common.store(
        decontaminate.benchmark_hits(docs, items, SHINGLE, NUM, DEN).select("doc_id").distinct()
    )
    docs, file, row = common.placed(docs)
    places = docs.select("doc_id", file.alias("file"), row.alias("row"))
    return common.without_rows(docs, file, row, places.join(leaks, "doc_id").select("file", "row"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 2048 tokens, with their ids and the ids' checksum. Nothing but id and
    text is looked at; a null text is its end id alone."""
    pieces = packing.pack(docs, common.tokenizer_path(BYTE_BPE), end_id=END_ID)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_classifier", drop_low_quality),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

#: No SQL: the classifier and the tokenizer have none.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again, and what a stage
    stored for itself is deleted."""
    docs = common.read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        with common.scope():
            docs = common.store(stage(spark, docs, sf_dir), outer=True)
    return STAGES[-1][1](spark, docs, sf_dir)
