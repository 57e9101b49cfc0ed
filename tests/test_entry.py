import glob
import math

import duckdb
import pytest

import __spark_entry__ as entry
from leafline.plans import catalog

SF = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return [plain(x) for x in v] if isinstance(v, list) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {f.rsplit('/', 1)[1][:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    names = sorted(df.columns)
    got = sorted(str([plain(r[c]) for c in names]) for r in df.collect())
    if name not in catalog.ORACLE_SQL:
        return
    table = duck.sql(catalog.ORACLE_SQL[name])
    assert sorted(table.columns) == names
    at = [table.columns.index(c) for c in names]
    assert sorted(str([plain(r[i]) for i in at]) for r in table.fetchall()) == got


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
