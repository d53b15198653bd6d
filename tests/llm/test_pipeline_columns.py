"""Columns of a user's documents outlive the pipeline's stages, whatever their names."""

import os
import random

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from songweave.llm import common, quality, queries, warc  # noqa: E402

DATA = os.environ.get("SONGWEAVE_TEST_DATA", "/root/testdata/sf0.001")
has_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
NAMES = ["_score", "score", "Score_", "mark", "_mark", "MARK_", "component_id", "count", "a.b", "n", "id"]


@has_data
def test_stages_keep_columns_and_their_values(spark):
    import corpus_pipeline as pipeline

    plain = spark.read.parquet(f"{DATA}/documents.parquet")
    wide = plain
    for i, name in enumerate(NAMES):
        wide = wide.withColumn(name, F.concat(F.lit(f"{i}:"), F.col("doc_id").cast("string")))
    docs = wide
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA)
        assert docs.columns == wide.columns
        rows = docs.collect()
        assert rows and all(
            r[name] == f"{i}:{r['doc_id']}" for r in rows for i, name in enumerate(NAMES)
        )
        docs = common.store(docs)
    assert {r["doc_id"] for r in rows} < {r["doc_id"] for r in plain.collect()}


def test_a_score_never_replaces_a_column(spark):
    import numpy as np

    model = quality.Model(np.zeros(1 << 8, np.float32), 0.0)
    docs = spark.createDataFrame([("t", 5)], "text string, SCORE int")
    with pytest.raises(ValueError):
        quality.with_score(docs, model, out="score")
    name = common.fresh(docs, "score")
    assert quality.with_score(docs, model, out=name).columns == ["text", "SCORE", name]


def test_stored_tables_go_with_their_scope(spark):
    def there(df):
        return os.path.isdir(df.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0])

    with common.scope():
        first = common.store(spark.range(5))
        with common.scope():
            second = common.store(spark.range(6))
            third = common.store(spark.range(7), outer=True)
            assert there(first) and there(second)
            kept = common.store(third, outer=True)
            files = second.inputFiles()
        assert not os.path.exists(files[0].removeprefix("file:"))
        assert third.count() == kept.count() == 7
        last = common.store(spark.range(8), outer=True)
    assert last.count() == 8 and there(last)
    assert not os.path.exists(first.inputFiles()[0].removeprefix("file:"))


def test_records_are_read_by_several_tasks(spark):
    rng = random.Random(2)
    rows = [(i, f"http://h{i % 7}.org/{i}", "".join(rng.choices("abcdef ", k=400))) for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    captures = warc.write_archives(pages, common.shared_folder(spark, "warc"))
    found = warc.read_records(captures.select("uri", "offset", "size"))
    sizes = found.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 300
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 200
    assert queries.QUERIES["op7_warc"]
