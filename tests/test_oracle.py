"""Registered queries against their DuckDB oracle on the smallest driver tables."""

import os

import duckdb
import pytest

from conftest import SF_SMALL

sys_path = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

def _names():
    from tidemark.plans.registry import REGISTRY
    return sorted(name for name, q in REGISTRY.items() if q.sql)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings pages "
              "benchmark labels conversations").split():
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    import sys
    sys.path.insert(0, os.path.join(sys_path, "tools"))
    from oracle_check import rows_of

    import __spark_entry__ as E
    sp = E.queries()[name](spark, SF_SMALL).toPandas()
    dk = con.sql(E.oracle_sql()[name]).df()
    c1, r1 = rows_of(sp)
    c2, r2 = rows_of(dk)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "snapshot_date" in df.columns
