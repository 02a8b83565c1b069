"""Every registered query against its SQL twin on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from tidemark.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(round(v, 9) + 0.0)
    return None if v is None else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    rows, columns = df.collect(), sorted(df.columns)
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert columns
        return
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted(str([plain(r[names.index(c)]) for c in columns]) for r in cursor.fetchall())
    assert sorted(str([plain(r[c]) for c in columns]) for r in rows) == want


def test_every_query_has_a_twin_or_says_why():
    without = set(registry.queries()) - set(registry.oracle_sql())
    assert without <= {"approx_distinct_users"}  # sketches are approximate
