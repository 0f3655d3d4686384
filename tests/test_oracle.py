"""Every query of the library that has SQL, against DuckDB on the smallest tables."""

import math

import duckdb
import pytest

from textloom.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return f"{v:.6f}"
    return str(v)


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([tuple(plain(r[i]) for i in order) for r in values])


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, sf_dir, name):
    got = catalog.QUERIES[name](spark, sf_dir)
    found = rows(got.columns, got.collect())
    if name in catalog.ORACLE_SQL:
        want = duck.execute(catalog.ORACLE_SQL[name])
        assert found == rows([c[0] for c in want.description], want.fetchall())
