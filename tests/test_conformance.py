"""Every registered query against its SQL, run by DuckDB on the same files."""

from pathlib import Path

import duckdb
import pytest

from conformance.oracles import ORACLES
from conformance.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _sorted_rows(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(([row[i] for i in order] for row in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    actual = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLES[name])
    columns = [column[0] for column in expected.description]
    assert sorted(actual.columns) == sorted(columns)
    got = _sorted_rows([tuple(row) for row in actual.collect()], actual.columns)
    want = _sorted_rows(expected.fetchall(), columns)
    assert len(got) == len(want)
    assert got == want
