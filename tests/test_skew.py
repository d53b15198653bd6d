import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from songweave.operators.skew import hot_keys, product_sum, salted_join, unit_rows


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    # One key holds most rows; some keys are null or have no partner.
    left = spark.range(600).select(
        F.when(F.col("id") < 400, F.lit(7)).when(F.col("id") % 10 == 0, None)
        .otherwise(F.col("id") % 23).alias("k"),
        F.col("id").alias("v"),
    )
    right = spark.range(15).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    counts = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    hot = hot_keys(counts, ["k"], "n", share=0.01, min_rows=5)
    assert hot.where("k = 7").first()["_salts"] > 10
    salted = salted_join(left, right, ["k"], how, hot)
    plain = left.join(right, "k", how)
    assert sorted(map(str, rows(salted, *plain.columns))) == sorted(map(str, rows(plain)))


def test_hot_keys_are_bounded(spark):
    counts = spark.range(10000).select(F.col("id").alias("k"), F.lit(1).alias("n"))
    assert hot_keys(counts, ["k"], "n", share=1 / 8, min_rows=0).count() == 0
    one = spark.createDataFrame([(1, 90), (2, 5), (3, 5)], "k long, n long")
    assert rows(hot_keys(one, ["k"], "n", share=1 / 8, min_rows=0)) == [(1, 8)]


@pytest.mark.parametrize("chunk", [3, 2048])
def test_product_sum_is_the_matrix_product(spark, chunk):
    rng = np.random.default_rng(0)
    a = rng.integers(0, 3, (12, 9)).astype(float)
    b = rng.integers(0, 3, (12, 7)).astype(float)
    a[0], b[0] = 2.0, 1.0

    def table(m, name):
        cells = [(int(k), int(i), float(m[k, i])) for k, i in zip(*np.nonzero(m))]
        return spark.createDataFrame(cells, f"key long, {name} long, weight double")

    got = product_sum(table(a, "i"), table(b, "j"), "key", "i", "j", chunk=chunk)
    found = np.zeros((9, 7))
    for i, j, v in rows(got, "i", "j", "value"):
        found[i, j] = v
    assert np.allclose(found, a.T @ b)


def test_unit_rows(spark):
    df = spark.createDataFrame([(1, 1, 3.0), (1, 2, 4.0), (2, 1, 0.0)], "u long, i long, weight double")
    assert rows(unit_rows(df, "u")) == [(1, 1, 0.6), (1, 2, 0.8), (2, 1, 0.0)]
