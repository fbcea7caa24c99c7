"""Every registered query against its DuckDB oracle SQL on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry
from basketgraph.sources.tables import TABLE_NAMES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLE_NAMES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield c
    c.close()


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def v(x):
        if isinstance(x, float):
            return "nan" if math.isnan(x) else x
        return x.isoformat() if hasattr(x, "isoformat") else x

    return sorted((tuple(v(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(entry.REGISTRY) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) & set(entry.REGISTRY)))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    d_cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(cur.fetchall(), d_cols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["customer_id", "product_id", "score"]
