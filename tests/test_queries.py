"""Registered queries against their SQL on the smallest data."""

import duckdb
import pytest

from fieldmart.plans.registry import ORACLE_SQL, QUERIES
from fieldmart.plans.written_oracle import WRITTEN_SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in ("orders", "customer", "events", "part"):
        con.execute(f"create view {t} as select * from read_parquet('{FOLDER}/{t}.parquet')")
    return con


def same(value):
    return float(f"{float(value):.9g}") if isinstance(value, float) or type(value).__name__ == "Decimal" else value


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


SOME = ["dedup_latest", "qc_summary", "similar_phone", "similar_name", "quality_report", "issue_rows", "message_status", "weekly_percent", "schema_missing_columns"]
#: All that write and read, and all ordered and parted reports.
NEW = sorted(WRITTEN_SQL)


@pytest.mark.parametrize("name", SOME + NEW)
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in cursor.description]
    expected = sorted(repr([same(r[columns.index(c)]) for c in sorted(columns)]) for r in cursor.fetchall())
    assert sorted(columns) == sorted(df.columns)
    assert sorted(repr([same(r[c]) for c in sorted(df.columns)]) for r in df.collect()) == expected
