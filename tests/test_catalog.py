"""Registered queries against their SQL twins on the smallest tables.

All of them run with OPSFLOW_ALL=1; by default one of each kind does.
"""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import TABLES, rows_of
from opsflow.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
SOME = [
    "tracked_lines", "unhandled_docs", "conflicting_status", "ready_to_confirm", "completion_label", "package_numbers",
    "match_precedence", "todate_counts", "expand_packed_events", "nest_orders", "order_documents", "strings_refs",
    "metric_diff_log", "upsert", "sync_stream", "sales_orders", "tracked_shipments", "packages_to_add",
]
NAMES = list(ORACLES) if os.environ.get("OPSFLOW_ALL") else SOME

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(entry.oracle_sql()[name])
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


@pytest.mark.parametrize("name", ["inventory_summary", "header_detail", "flatten_shipment_reply", "current_shipment"])
def test_groups_beyond_one_part_equal_sql(spark, tmp_path, name):
    """One key with more lines than a document's part holds; the recent shipment is in the second part."""
    con = duckdb.connect()
    con.sql("""CREATE TABLE lineitem AS SELECT CASE WHEN i < 10500 THEN 1 ELSE i % 7 + 2 END::BIGINT AS l_orderkey, i::INT AS l_linenumber,
      CASE WHEN i < 10500 AND i <> 10200 THEN 1 ELSE i % 5 + 2 END::BIGINT AS l_partkey, (i % 13)::BIGINT AS l_suppkey, (i % 9)::DOUBLE AS l_quantity,
      CASE WHEN i = 10200 OR i % 11 = 0 AND i > 10500 THEN TIMESTAMP '1999-05-01' ELSE TIMESTAMP '1995-05-01' END AS l_shipdate FROM range(10600) r(i)""")
    con.sql("CREATE TABLE orders AS SELECT i::BIGINT AS o_orderkey, 'O' AS o_orderstatus, (i + 50)::BIGINT AS o_custkey FROM range(1, 11) r(i)")
    con.sql("""CREATE TABLE conversations AS SELECT CASE WHEN i < 10500 THEN 1 ELSE 2 END::BIGINT AS conv_id, i::INT AS turn,
      CASE WHEN i % 2 = 0 THEN 'user' ELSE 'bot' END AS role, 't' || i AS text FROM range(10600) r(i)""")
    for table in ("lineitem", "orders", "conversations"):
        con.sql(f"COPY {table} TO '{tmp_path}/{table}.parquet' (FORMAT parquet)")
    df = QUERIES[name](spark, str(tmp_path))
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(ORACLES[name])
    assert got == rows_of([d[0] for d in cursor.description], cursor.fetchall())


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
