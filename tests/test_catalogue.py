"""Every registered query against its SQL, and the contract of the entry file."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_file
from catalogue.oracle import ORACLE
from catalogue.queries import QUERIES


@pytest.fixture(scope="module")
def sql():
    from conftest import SMALL

    connection = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def sorted_rows(columns, data):
    places = [columns.index(name) for name in sorted(columns)]
    picked = (tuple(row[p] for p in places) for row in data)
    return sorted(picked, key=lambda row: [(v is None, str(v)) for v in row])


TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, sf_dir, sql, name):
    df = QUERIES[name](spark, sf_dir)
    result = sql.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert {c: TYPES[t] for c, t in df.dtypes} == {d[0]: str(d[1]) for d in result.description}
    got, expected = sorted_rows(df.columns, df.collect()), sorted_rows(columns, result.fetchall())
    assert len(got) == len(expected) > 0
    assert got == expected


def test_entry(spark):
    assert set(QUERIES) <= set(entry_file.queries())
    assert set(ORACLE) <= set(entry_file.oracle_sql()) <= set(entry_file.queries())
    book = entry_file.entry(spark)
    assert book.columns == ["customer_id", "ref", *(f"VAR_{n}" for n in range(680))]
