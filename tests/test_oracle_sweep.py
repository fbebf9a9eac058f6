"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, canon

# the training-data queries have tests of their own (tests/llm)
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k not in entry.LLM_QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(entry.queries()) - set(entry.LLM_QUERIES) == set(ORACLE)


SPARK_TO_DUCKDB = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
                   "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE[name])
    ocols, otypes = rel.columns, [str(t) for t in rel.types]
    want = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    types = dict(zip(ocols, otypes))
    assert {c: SPARK_TO_DUCKDB.get(t, t) for c, t in df.dtypes} == types
    assert canon(got, df.columns, None) == canon(want, ocols, None)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["region", "category_rank", "category_title", "total_views", "unique_videos_count"]
    assert df.count() > 0
