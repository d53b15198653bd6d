"""Small tables are stored in few files, however many partitions they come from."""

import pytest
from pyspark.sql import functions as F

pytest.importorskip("songweave.llm.common")

from songweave.llm import common, components  # noqa: E402


def files_of(table) -> int:
    return len(table.inputFiles())


def test_a_small_table_is_a_few_files_a_slot(spark):
    many = spark.range(3000).repartition(211)
    most = common.FILES_PER_SLOT * spark.sparkContext.defaultParallelism
    stored = common.store(many, small=True)
    assert files_of(stored) <= most < files_of(common.store(many))
    assert sorted(r["id"] for r in stored.collect()) == list(range(3000))


def test_components_store_few_files(spark, monkeypatch):
    found = []
    store = components.store

    def counted(df, *args, **kwargs):
        found.append(files_of(out := store(df, *args, **kwargs)))
        return out

    monkeypatch.setattr(components, "store", counted)
    edges = spark.range(2000).where("id % 10 <> 0").select(
        (F.col("id") - 1).alias("a"), F.col("id").alias("b")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "97")
    try:
        got = {r["id"]: r["component"] for r in components.components(edges).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == {v: v // 10 * 10 for v in range(2000)}
    assert max(found) <= common.FILES_PER_SLOT * spark.sparkContext.defaultParallelism
