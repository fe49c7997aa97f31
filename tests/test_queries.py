"""Every registered query of the library against its SQL in DuckDB, on the smallest tables."""

import decimal
import math

import duckdb
import pytest

from linkgauge.plans.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, (float, decimal.Decimal)):
        return "nan" if math.isnan(v) else round(float(v), 5) + 0.0
    return v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_against_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    if name not in ORACLE_SQL:
        assert rows
        return
    cursor = duck.execute(ORACLE_SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    expected = sorted(repr([norm(r[columns.index(c)]) for c in sorted(columns)]) for r in cursor.fetchall())
    assert sorted(repr([norm(r[c]) for c in sorted(columns)]) for r in rows) == expected
