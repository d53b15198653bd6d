import math
import os

import duckdb
import pytest

from songweave.catalog.oracles import ORACLES
from songweave.catalog.queries import QUERIES, flagship

FOLDER = os.environ.get("SONGWEAVE_TEST_DATA", "/root/testdata/sf0.001")
TABLES = "lineitem orders events part embeddings".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return con


def comparable(values):
    out = []
    for v in values:
        if isinstance(v, float):
            out.append("nan" if math.isnan(v) else f"{v + 0.0:.6f}")
        else:
            out.append(str(v))
    return tuple(out)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    doubles = {n for n, kind in df.dtypes if kind == "double"}
    result = duck.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns

    def tidy(row, at):
        picked = [row[at(c)] for c in columns]
        return comparable(
            float(v) if c in doubles and v is not None else v for c, v in zip(columns, picked)
        )

    want = sorted(tidy(r, names.index) for r in result.fetchall())
    got = sorted(tidy(r, lambda c: c) for r in df.collect())
    assert got == want


def test_flagship_runs(spark):
    assert flagship(spark, FOLDER).count() > 0
