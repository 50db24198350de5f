"""Every registered query against its SQL, on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from kinfold.plans import catalogue  # noqa: E402

duckdb = pytest.importorskip("duckdb")
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not there")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def canonical(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(None if r[i] is None else repr(r[i]) for i in order) for r in data), key=repr
    )


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES)
    assert set(catalogue.QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["segment", "customer_count"]


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query(spark, sql, name):
    df = entry.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    cursor = sql.execute(entry.oracle_sql()[name])
    columns = {c[0]: str(c[1]) for c in cursor.description}
    want = cursor.fetchall()
    assert {c: TYPES[t] for c, t in df.dtypes} == columns
    assert canonical(df.columns, got) == canonical(list(columns), want)
