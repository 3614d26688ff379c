"""Each query with SQL against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

from aerocube.plans import registry

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(df: pd.DataFrame) -> list[tuple]:
    def plain(x):
        if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and math.isnan(x)):
            return ""
        if isinstance(x, bool) or type(x).__name__ == "bool_":
            return str(bool(x))
        try:
            return repr(float(x) + 0.0)  # every bit counts, but for the sign of 0
        except (TypeError, ValueError):
            return str(x)

    df = df[sorted(df.columns)]
    return sorted(tuple(plain(x) for x in r) for r in df.itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{D}/{t}.parquet')")
    return c


@pytest.mark.skipif(not os.path.isdir(D), reason="no tables")
@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_equals_sql(spark, duck, name):
    got, want = registry.QUERIES[name](spark, D).toPandas(), duck.sql(registry.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_query_is_checked():
    assert set(registry.QUERIES) == set(registry.ORACLE_SQL)
