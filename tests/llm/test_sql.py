"""The registered queries that SQL can state, against it on another engine."""

from __future__ import annotations

import duckdb
import pytest

from conftest import TESTDATA
from starloom.llm.queries import ORACLE, QUERIES

FOLDER = TESTDATA / "sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages"):
        duck.execute(f"create view {table} as select * from read_parquet('{FOLDER}/{table}.parquet')")
    expected = duck.execute(ORACLE[name])
    names = sorted(column[0] for column in expected.description)
    order = [[column[0] for column in expected.description].index(n) for n in names]
    theirs = sorted(repr([row[i] for i in order]) for row in expected.fetchall())
    ours = QUERIES[name](spark, str(FOLDER))
    assert sorted(ours.columns) == names
    assert sorted(repr(list(row)) for row in ours.select(*names).collect()) == theirs and theirs
