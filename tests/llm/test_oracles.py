"""Registered queries against their SQL, on whole small tables."""

from pathlib import Path

import duckdb
import pytest

from shelfscope.llm.oracles import ORACLES
from shelfscope.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    want = duck.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    rows = [tuple(r) for r in got.select(*columns).collect()]
    assert sorted(rows, key=repr) == sorted(want.fetchall(), key=repr)


def test_rollup_counts_rows_with_null_and_repeated_ids(spark, tmp_path):
    rows = [(None, "two words")] * 3 + [(None, "two other")] * 2 + [(1, "one two three")] * 3 + [(1, "one, two"), (2, "one two three"), (3, None)]
    rows += [(4, "four")] * 2 + [(5, "four")] * 2
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = connection.execute(ORACLES["op10_token_rollup"])
    columns = [c[0] for c in want.description]
    got = [tuple(r) for r in QUERIES["op10_token_rollup"](spark, str(tmp_path)).select(*columns).collect()]
    assert got == want.fetchall() and got[0][columns.index("docs")] == 12


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
