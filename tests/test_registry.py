"""A few registered queries against their SQL; CASEQUARRY_ALL=1 runs all."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from tools.check import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
SHORT = ["pii_merged_spans", "composite_case_text", "hybrid_fusion_topk", "checksum_reconcile", "p95_by_window",
         "proportional_sample", "category_hierarchy", "facet_counts"]
NAMES = sorted(entry_points.oracle_sql()) if os.environ.get("CASEQUARRY_ALL") else SHORT

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = entry_points.queries()[name](spark, FOLDER)
    cursor = con.execute(entry_points.oracle_sql()[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(
        [d[0] for d in cursor.description], cursor.fetchall())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
