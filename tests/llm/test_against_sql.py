"""Queries with SQL, over awkward rows and over empty tables."""

import duckdb
import pytest

from snaplytics.llm.queries import ORACLE, QUERIES
from tools.check_oracle import canon

from .tables import conversations, documents, pages


@pytest.fixture(scope="module", params=["rows", "empty"])
def sf_dir(request, spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp(f"sf-{request.param}"))
    none = [] if request.param == "empty" else None
    documents(spark, extra=True, rows=none).coalesce(1).write.parquet(f"{path}/documents.parquet")
    pages(spark, rows=none).coalesce(1).write.parquet(f"{path}/pages.parquet")
    conversations(spark, extra=True, rows=none).coalesce(1).write.parquet(f"{path}/conversations.parquet")
    return path


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS FROM '{sf_dir}/{t}.parquet/*.parquet'")
    want = con.execute(ORACLE[name])
    names = [c[0] for c in want.description]
    want = want.fetchall()
    got = QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(names)
    assert canon([tuple(r) for r in got.collect()], got.columns, 6) == canon(want, names, 6)
