"""Datasets fit the contracts of the tables they are written to."""

import os
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from opsflow.catalog.base import Tables
from opsflow.catalog.documents import tracking_reports
from opsflow.catalog.erp_tables import erp
from opsflow.operators import tables
from opsflow.plans import contracts, feeds, orders, warehouse
from tests.conftest import rows

FOLDER = "/root/testdata/sf0.001"
AS_OF = datetime(2001, 8, 1)
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, FOLDER)


def fits(df, name):
    stamped = df if "last_checked" in df.columns else df.withColumn("last_checked", F.lit(AS_OF))
    result = tables.conform(stamped, contracts.TABLES[name])
    assert result.count() > 0
    return result


def test_order_datasets_fit(t):
    fits(orders.sales_orders(erp(t), AS_OF, "900 DAYS"), "sales_orders")
    fits(orders.quotes(erp(t), AS_OF, "900 DAYS"), "quotes")
    fits(orders.phone_order_lines(erp(t), AS_OF, "2000 DAYS"), "phone_revenue")


def test_of_company_filters_only_where_it_can(spark):
    both = spark.createDataFrame([(1, "a"), (2, "b")], "company_id int, v string")
    plain = spark.createDataFrame([("c",)], "v string")
    got = orders.of_company({"both": both, "plain": plain}, 2)
    assert rows(got["both"], "v") == [("b",)] and got["plain"].count() == 1


def test_tracking_export_fits(t):
    heads, points = feeds.tracking_export(tracking_reports(t))
    fits(heads, "tracking_export")
    fits(points, "tracking_export_detail")


def test_campaign_fits(spark):
    report = spark.createDataFrame(
        [("2026-01-01", "N (12)", "3", "x", "1.5", "1", "2.25"), (" ", "total", "3", "1", "1", "1", "1"), (None, "t", "1", "1", "1", "1", "1")],
        "Day string, Campaign string, Clicks string, Displays string, AdvertiserCost string, SalesAllPc30d string, RevenueGeneratedAllPc30d string",
    )
    loaded = feeds.campaign_performance(report, 5, F.lit(AS_OF))
    assert rows(loaded, "campaign_id", "campaign_name", "clicks", "impressions", "cost") == [(12, "N", 3, 0, 1.5)]
    stored = fits(loaded, "campaign_daily")
    log, writes = feeds.campaign_diff(stored, loaded.withColumn("clicks", F.lit(4).cast("bigint")))
    fits(log, "campaign_diff_log")
    assert rows(log, "clicks_last", "clicks_current", "diff") == [(3, 4, True)] and writes.count() == 1


def test_crm_snapshots_fit(spark):
    owners = spark.createDataFrame([("1", "Ann"), ("2", "Bo")], "owner_id string, rep_name string")
    teams = spark.createDataFrame([("Ann", "inside")], "rep_name string, team string")
    stages = spark.createDataFrame([("s9", "Closed/Won")], "stage_id string, label string")
    deals = spark.createDataFrame(
        [("d1", {"dealstage": "s9", "owner_id": "1", "amount": "1.5", "createdate": "2001-07-01T00:00:00Z", "dealname": "x"}),
         ("d2", {"dealstage": "s1", "owner_id": "9", "amount": None})],
        "id string, properties map<string,string>",
    )
    snapshot = feeds.deal_snapshot(deals, owners, teams, stages, AS_OF)
    assert rows(snapshot, "deal_id", "rep_name", "team", "amount", "is_true_won", "days_in_pipeline") == [
        ("d1", "Ann", "inside", 1.5, 1, 31), ("d2", "no matching owner", "no matching owner", None, 0, None)
    ]
    event = spark.createDataFrame(
        [(("2001-07-30T01:00:00Z", "2"),), (("bad", "1"),), ((None, "1"),), (("2001-07-30T01:00:00.5Z", None),)],
        "properties struct<timestamp: string, owner_id: string>",
    )
    counts = feeds.activity_snapshot({k: event for k in ("call", "email", "meeting", "task")}, owners, teams, AS_OF)
    fits(counts, "activity_snapshots")
    assert ("Bo", "week", 1, "unknown") in rows(counts, "rep_name", "window", "call_count", "team")
    assert ("Ann", "year", 0, "inside") in rows(counts, "rep_name", "window", "call_count", "team")


def test_return_reports_fit(spark):
    line = "rmaLineID int, rmaLineNumber int, rpStatus string, rpItem string, rpQuantityExp int, dfStatus string, dfItem string, dfQuantityExp int, dfModelNum string"
    fields = [f.split() for f in line.split(", ")]
    struct = ", ".join(f"{n}: {k}" for n, k in fields)
    head = "rmaNumber string, rmaId int, rmaTypeName string, rmaStatus string, customerRef string, rmaTypeDescription string, inboundShipCarrier string, inboundShipPriority string, rmaCreateDate string, rmaLastModifiedDate string"
    data = [
        (f"r{k}", 1, k, "OPEN", "c", "d", "ups", "1", "2026-01-01T00:00:00Z", "2026-01-02T00:00:00Z", [(1, 1, "rs", "ri", 1, "ds", "di", 2, "m")])
        for k in ("W", "3", "X")
    ]
    frame = spark.createDataFrame(data, f"{head}, rmaLines array<struct<{struct}>>")
    got = feeds.return_statuses(frame, F.lit(AS_OF))
    fits(got, "return_status")
    assert rows(got, "rma_type", "inventory_cd", "qty", "descr", "carrier") == [
        ("3", "di", 2, "m", None), ("W", "ri", 1, None, "ups"), ("X", None, None, None, None)
    ]


def test_property_catalogue_fits(spark):
    frame = spark.createDataFrame([("a", "A", 1, False)], "name string, label string, displayOrder int, hidden boolean")
    fits(feeds.property_catalogue({"calls": frame, "leads": frame}), "properties")


def test_recheck_keeps_unknown_numbers(spark):
    numbers = spark.createDataFrame([("a",), ("b",), ("c",)], "rma_number string")
    log = spark.createDataFrame([("d", "200 ERROR: Item does not exist"), ("e", "ok")], "key_value string, response string")
    status = spark.createDataFrame(
        [("a", "CLOSED", None, datetime(2001, 7, 31)), ("b", "CLOSED", None, datetime(2001, 1, 1)), ("c", "OPEN", None, datetime(2001, 1, 1))],
        "rma_number string, rma_status string, line_status string, last_checked timestamp_ntz",
    )
    got = warehouse.numbers_to_recheck(numbers, numbers.limit(0), log, status, AS_OF)
    assert rows(got, "rma_number") == [("a",), ("c",), ("e",)]


def test_purge_follows_all_three_tombstones(spark):
    lines = spark.createDataFrame([("o1", 1), ("o2", 1), ("o2", 2)], "order_nbr string, line_nbr int")
    ships = spark.createDataFrame([("s1",), ("s2",)], "shipment_nbr string")
    kept, left = warehouse.purge(
        lines, ships, lines.where("order_nbr = 'o1'"), lines.where("order_nbr = 'o2' and line_nbr = 2"), ships.where("shipment_nbr = 's2'")
    )
    assert rows(kept) == [("o2", 1)] and rows(left) == [("s1",)]


def test_newest_orders_are_chosen_after_the_joins(spark, t):
    source = {name: df for name, df in erp(t).items()}
    header = source["order_header"].orderBy(F.col("modified_at").desc(), "order_nbr")
    sent = source["order_ledger"].where("false")
    args = ("cust/", "order/", "CRMID", 3)
    want = [r[0] for r in rows(orders.orders_to_send(source, sent, *args), "order_nbr")]
    # newer headers without a contact take no place
    newer = header.where(F.col("order_type") == "SO").limit(5).withColumns(
        {
            "order_nbr": F.concat(F.lit("new"), "order_nbr"), "ship_contact_id": F.lit(-1).cast("bigint"),
            "modified_at": F.col("modified_at") + F.expr("INTERVAL 900 DAYS"),
        }
    ).select(*source["order_header"].columns)
    source["order_header"] = source["order_header"].unionByName(newer)
    got = [r[0] for r in rows(orders.orders_to_send(source, sent, *args), "order_nbr")]
    assert len(want) == 3 and got == want


@pytest.mark.parametrize("build, column, most", [
    (lambda t: orders.sales_orders(erp(t), AS_OF, "900 DAYS"), "s_line1", 5),
    (lambda t: orders.order_shipment_detail(erp(t), "x/"), "item_descr", 4),
    (lambda t: orders.orders_to_resend(erp(t), AS_OF, "900 DAYS", "c/", "o/", "CRMID"), "billing_line1", 6),
])
def test_few_shuffles_carry_wide_columns(t, build, column, most):
    """With every dimension shuffled, the widest columns come in after the other lookups."""
    threshold = t.spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    t.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = build(t)
        plan = t.spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    finally:
        t.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    carried = [x for x in re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan) if re.search(rf"\b{column}#", x)]
    assert len(carried) <= most, len(carried)


def test_order_documents_never_shuffle_documents(spark):
    """Digests of the ledger come to the documents, which stay where their rows were dealt."""
    base = spark.createDataFrame(
        [(1, "F", "NY", "US"), (2, "O", "NJ", "US"), (3, "O", "NJ", "US")],
        "order_nbr bigint, order_status string, billing_state string, billing_country string",
    )
    detail = spark.createDataFrame(
        [(1, 1, 5, 1, 0, "S", 1, None, "Done", 1, 7, None), (1, 1, 5, 1, 0, "S", 1, None, "Done", 1, 8, None), (2, 1, 5, 1, 0, *[None] * 7)],
        "order_nbr bigint, line_nbr int, inventory_cd int, line_qty int, warehouse int, shipment_nbr string, ship_line_nbr int,"
        " ship_date date, ship_status string, ship_line_qty int, tracking int, tracking_created date",
    )
    ledger = spark.createDataFrame([], "order_nbr bigint, decoded_status string, piece int, part bigint, payload string")
    everything = feeds.order_documents(base, detail, ledger)
    sent = everything.select(*ledger.columns).collect()
    ledger = spark.createDataFrame([(*r[:4], "old" if r[0] == 2 else r[4]) for r in sent if r[0] < 3], ledger.schema)
    docs = feeds.order_documents(base, detail, ledger)
    plan = docs._jdf.queryExecution().executedPlan().toString()
    # lines, shipments, packages; orders: distinct, dealt; digests: combined, dealt
    assert plan.count("Exchange hashpartitioning") == 7
    assert rows(docs, "order_nbr") == [(2,), (3,)]
    again = feeds.order_documents(base, detail, everything.select(*ledger.columns))
    # a ledger made by the same flow is dealt already
    assert again._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 12
    assert again.count() == 0
