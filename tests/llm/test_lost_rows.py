"""Rows go by their place in files, without a shuffle of what they hold."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from songweave.llm import common  # noqa: E402


def removed(docs, condition):
    docs, file, row = common.placed(docs)
    lost = docs.where(condition).select(file.alias("file"), row.alias("row"))
    return common.without_rows(docs, file, row, lost)


@pytest.mark.parametrize("bucket_rows,chunk_bits", [(1 << 13, 20), (3, 2), (1, 0)])
def test_lost_rows_go_and_the_others_stay(spark, monkeypatch, bucket_rows, chunk_bits):
    monkeypatch.setattr(common, "BUCKET_ROWS", bucket_rows)
    monkeypatch.setattr(common, "CHUNK_BITS", chunk_bits)
    docs = common.store(
        spark.range(300, numPartitions=5).select(
            F.when(F.col("id") % 7 > 0, F.col("id")).alias("doc_id"),
            F.expr("if(id % 3 = 0, null, repeat('x', int(id)))").alias("text"),
            F.lit("own").alias("_metadata"),
            F.lit(1).alias("a.b"),
            F.col("id").alias("row"),
        )
    )
    want = [r for r in rows(docs) if r[4] % 4 or r[4] < 60]
    got = removed(docs, "row % 4 = 0 and row >= 60")
    assert got.columns == docs.columns and rows(got) == sorted(
        want, key=lambda row: [(v is not None, v) for v in row]
    )


def test_frames_that_are_not_files(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (None, None), (2, "")], "doc_id long, text string")
    assert rows(removed(docs, "doc_id = 1")) == [(None, None), (2, "")]
    assert rows(removed(docs, "false")) == rows(docs)
    assert rows(removed(docs, "true")) == []
    assert rows(removed(docs.limit(0), "true")) == []


def test_texts_are_not_shuffled(spark):
    docs = common.store(spark.range(50).selectExpr("id as doc_id", "repeat('y', 99) as text"))
    plan = removed(docs, "doc_id < 20")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
