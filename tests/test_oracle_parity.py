"""Every catalogue query against its DuckDB oracle on the smallest test tables.

Same comparison as the driver's gate: column names, row count and the
multiset of rows (doubles compared at 6 decimals).
"""

import math
import os

import pytest

import __spark_entry__ as E
from legworks.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF}/lineitem.parquet"),
                                reason="test tables not present")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cols, rows = df.columns, df.collect()
    sqls = E.oracle_sql()
    cur = duck.execute(sqls[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _rows(cols, rows) == _rows(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["YEAR", "recovery_status", "count"]
    assert df.count() > 0
