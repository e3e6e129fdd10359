"""Every registered query against its DuckDB oracle on the smallest driver tables."""
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from pacekit.plans.analog import TABLES
from pacekit.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


# the driver's schema names for a result column, Spark type -> DuckDB type
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v                      # full precision
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "load_label" in df.columns


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, name):
    df = REGISTRY[name](spark, SF)
    rows = [tuple(norm(v) for v in r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        return
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == sorted(df.columns)
    kinds = dict(zip(dcols, (str(d[1]) for d in cur.description), strict=True))
    for c, t in df.dtypes:
        if kinds[c] not in ("HUGEINT", "NULL", '"NULL"'):
            assert TYPES[t] == kinds[c], (c, t, kinds[c])
    idx = [dcols.index(c) for c in df.columns]
    drows = [tuple(norm(r[i]) for i in idx) for r in cur.fetchall()]
    assert sorted(rows, key=key) == sorted(drows, key=key)
