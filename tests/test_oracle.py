"""Every registered query against its SQL in DuckDB."""

import math
import os

import duckdb
import pytest

from bindery.plans import ORACLES, QUERIES
from bindery.sources.derive import BASE


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if v is None:
            return "~"
        if hasattr(v, "isoformat"):
            return str(v.replace(tzinfo=None)) if hasattr(v, "hour") else str(v)
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
            return "nan" if isinstance(v, float) and math.isnan(v) else f"{float(v):.6f}"
        return str(v)

    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in values)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in BASE:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    mine = rows(df.columns, [tuple(r) for r in df.collect()])
    assert mine[1], "no rows"
    if name in ORACLES:
        found = duck.execute(ORACLES[name])
        theirs = rows([c[0] for c in found.description], found.fetchall())
        assert mine == theirs
