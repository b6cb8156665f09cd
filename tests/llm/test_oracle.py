import duckdb
import pytest

from corpusqa.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import SMALL


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "labels", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    want = con.sql(ORACLE[name])
    frame = QUERIES[name](spark, SMALL)
    assert sorted(frame.columns) == sorted(want.columns)
    at = [frame.columns.index(c) for c in want.columns]
    got = sorted((tuple(plain(r[i]) for i in at) for r in frame.collect()), key=str)
    assert got == sorted((tuple(map(plain, r)) for r in want.fetchall()), key=str)
