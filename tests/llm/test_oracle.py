"""Queries of the training-data operators against their SQL, over whole tables."""

from pathlib import Path

import duckdb
import pytest

from ledgerlake.llm.oracle import ORACLE
from ledgerlake.llm.queries import QUERIES


@pytest.fixture(scope="module")
def sql():
    from conftest import SMALL

    connection = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_sql(spark, sf_dir, sql, name):
    result = sql.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    expected = sorted(result.fetchall(), key=str)
    df = QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
    assert len(got) > 0 and got == expected
