"""Queries with a SQL twin give the twin's rows on the smallest table."""

import duckdb
import pytest

from skyframe.llm import queries
from tests.conftest import SF_SMALL
from tools.check_oracle import rows_of


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.execute(queries.ORACLE[name])
    columns = [c[0] for c in want.description]
    df = queries.QUERIES[name](spark, SF_SMALL)
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, want.fetchall())


def test_all_queries_are_registered():
    import __spark_entry__ as entry
    names = list(entry.queries())
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names
