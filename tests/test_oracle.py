"""Every registered query against its DuckDB SQL on the smallest driver tables; plus the entry point."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from martcraft.plans.registry import QUERIES
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, rows_of

pytestmark = pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_sql():
    assert set(QUERIES) <= set(E.oracle_sql())


# Spark type name -> DuckDB type name, for the schema half of the comparison.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "double": "DOUBLE",
         "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    spark_types = {k: v.upper() if v.startswith("decimal") else TYPES.get(v, v) for k, v in spark_types.items()}
    rel0 = con.sql(E.oracle_sql()[name])
    assert spark_types == dict(zip(rel0.columns, [str(t) for t in rel0.types]))
    sc, sr = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(E.oracle_sql()[name])
    dc, dr = rows_of(rel.columns, rel.fetchall())
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "revenue_growth_pct" in df.columns
