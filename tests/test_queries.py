"""Every registered query against its SQL over the same tables."""

import pytest
from compare import database, difference

from __spark_entry__ import entry
from kickflow.oracles import ORACLES
from kickflow.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SPARK_TO_SQL = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    sql = ORACLES[name]
    types = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    assert {column: SPARK_TO_SQL[kind] for column, kind in df.dtypes} == types
    assert difference(df, sql, con) is None


def test_entry(spark):
    assert entry(spark).count() > 0
