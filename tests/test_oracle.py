"""Every query with SQL against DuckDB at the smallest scale, row for row."""

import os

import pytest

from dossier import registry

DATA = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    norm = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_duckdb(spark, duck, name):
    got = registry.queries()[name](spark, DATA)
    want = duck.sql(registry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got.columns, [tuple(r) for r in got.collect()]) == _rows(want.columns, want.fetchall())
