"""Every query with a SQL statement must give the same rows in DuckDB."""

import math
import os

import duckdb
import pytest

from panelcraft.plans import catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return con


def rows_of(frame):
    frame = frame[sorted(frame.columns)]

    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)) or type(v).__name__ == "NAType":
            return None
        return round(v, 6) + 0.0 if isinstance(v, float) else v

    rows = [tuple(cell(v) for v in r) for r in frame.itertuples(index=False, name=None)]
    return list(frame.columns), sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    spark.catalog.clearCache()
    got = rows_of(catalog.queries()[name](spark, SF_DIR).toPandas())
    want = rows_of(duck.execute(catalog.oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    for a, b in zip(*[x[1] for x in (got, want)]):
        assert all((p == q) or (isinstance(p, float) and isinstance(q, float) and abs(p - q) < 2e-6) for p, q in zip(a, b)), (a, b)


def test_statements_belong_to_queries():
    assert set(catalog.oracle_sql()) <= set(catalog.queries())
