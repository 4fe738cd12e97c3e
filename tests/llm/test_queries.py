"""Every registered operator query on the small tables: against SQL where there is one, else whole results."""

import math
from pathlib import Path

import pytest

from viewloom.llm.oracle import ORACLE
from viewloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables here")


@pytest.fixture(scope="module")
def database():
    connection = pytest.importorskip("duckdb").connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, database, name):
    frame = QUERIES[name](spark, SF_DIR)
    relation = database.sql(ORACLE[name])
    columns = sorted(frame.columns)
    assert columns == sorted(relation.columns)
    ours = sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=str)
    order = [relation.columns.index(c) for c in columns]
    theirs = sorted((tuple(r[i] for i in order) for r in relation.fetchall()), key=str)
    assert ours, "a query without rows shows nothing"
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs):
        for x, y in zip(a, b):
            assert x == y or (isinstance(x, float) and math.isclose(x, y, abs_tol=1e-6)), (a, b)
