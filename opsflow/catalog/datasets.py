"""The named datasets over the driver tables in ERP shape."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from opsflow.catalog.base import Tables, day_text, query, time_text
from opsflow.catalog.erp_tables import erp, with_erp
from opsflow.catalog.order_twins import TWINS, day, time
from opsflow.plans import orders, warehouse

AS_OF = datetime(2001, 8, 1)


def plain(df: DataFrame) -> DataFrame:
    """Amounts as doubles, days and times as text, flags as numbers."""
    out = []
    for field in df.schema:
        kind, col = field.dataType.simpleString(), F.col(field.name)
        if kind.startswith("decimal"):
            col = col.cast("double")
        elif kind == "date":
            col = day_text(col)
        elif kind.startswith("timestamp"):
            col = time_text(col)
        elif kind == "boolean":
            col = col.cast("int")
        out.append(col.alias(field.name))
    return df.select(*out)



@query("sales_orders", TWINS["sales_orders"])
def sales_orders(t: Tables) -> DataFrame:
    return plain(orders.sales_orders(erp(t), AS_OF, "500 DAYS"))


@query("quotes", TWINS["quotes"])
def quotes(t: Tables) -> DataFrame:
    return plain(orders.quotes(erp(t), AS_OF, "900 DAYS"))


@query("phone_order_lines", TWINS["phone_order_lines"])
def phone_order_lines(t: Tables) -> DataFrame:
    return plain(orders.phone_order_lines(erp(t), AS_OF, "800 DAYS", excluded_items="11"))


@query("tracked_shipments", TWINS["tracked_shipments"])
def tracked_shipments(t: Tables) -> DataFrame:
    return plain(orders.tracked_shipments(erp(t), date(1999, 1, 1), ["OWN5"], ["101"]))


@query("order_shipment_detail", TWINS["order_shipment_detail"])
def order_shipment_detail(t: Tables) -> DataFrame:
    chosen = t.orders.where(F.col("o_orderdate") >= F.lit(datetime(1998, 1, 1))).select(
        F.col("o_orderkey").cast("string").alias("order_nbr")
    )
    return plain(orders.order_shipment_detail(erp(t), "ship/", orders=chosen))


@query("open_shipments_to_pack", TWINS["open_shipments_to_pack"])
def open_shipments_to_pack(t: Tables) -> DataFrame:
    return plain(orders.open_shipments_to_pack(erp(t), AS_OF, "1500 DAYS", "PARTNERA", ["PB"]))


@query("shipments_ready_to_confirm", TWINS["shipments_ready_to_confirm"])
def shipments_ready_to_confirm(t: Tables) -> DataFrame:
    return orders.shipments_ready_to_confirm(erp(t))


@query("returns_to_send", TWINS["returns_to_send"])
def returns_to_send(t: Tables) -> DataFrame:
    return plain(orders.returns_to_send(erp(t), "PB", "x@y", ["55"], ["77"]))


@query("returns_without_receipt", TWINS["returns_without_receipt"])
def returns_without_receipt(t: Tables) -> DataFrame:
    return plain(orders.returns_without_receipt(erp(t), "PB", "x@y"))


@query("shipments_to_send", TWINS["shipments_to_send"])
def shipments_to_send(t: Tables) -> DataFrame:
    return plain(orders.shipments_to_send(erp(t), "PB", "x@y", ["77"]))


@query("shipments_to_send_with_level", TWINS["shipments_to_send_with_level"])
def shipments_to_send_with_level(t: Tables) -> DataFrame:
    return plain(orders.shipments_to_send_with_level(erp(t), "PartnerA", "x@y", ["5", "105", "205"]))


LINK_TABLES = ("shipment", "shipment_line", "site", "status_lookup", "shipment_attributes")
LINK_SQL = """
    SELECT DISTINCT sh.shipment_nbr, 2 AS company_id, sh.note_id AS record_id, '{0}' AS field_name
    FROM erp_shipment sh JOIN erp_shipment_line shl ON sh.shipment_nbr = shl.shipment_nbr AND sh.shipment_type = shl.shipment_type
    JOIN erp_site si ON shl.site_id = si.site_id JOIN erp_status_lookup j ON sh.status = j.code AND j.tbl = 'SOShipment'
    LEFT JOIN erp_shipment_attributes k ON sh.note_id = k.record_id AND k.field_name = '{0}'
    WHERE rtrim(si.site_cd) = 'PB' AND sh.created_at >= TIMESTAMP '1998-03-01' AND (k.value_string IS NULL OR k.value_string = '')
"""


@query(
    "missing_links",
    with_erp(*LINK_TABLES) + LINK_SQL.format("AttributeLINK3PL") + " UNION " + LINK_SQL.format("AttributeRMAID"),
)
def missing_links(t: Tables) -> DataFrame:
    return orders.missing_links(erp(t), "PB", datetime(1998, 3, 1)).select("shipment_nbr", "company_id", "record_id", "field_name")


@query(
    "link_write_back",
    with_erp(*LINK_TABLES)
    + f""", a AS ({LINK_SQL.format("AttributeLINK3PL")} UNION {LINK_SQL.format("AttributeRMAID")}),
    r AS (SELECT DISTINCT 'S' || CAST(l_orderkey AS VARCHAR) AS rma_number, l_suppkey AS rma_id, l_linenumber FROM lineitem WHERE l_linenumber <> 3)
    SELECT record_id, field_name, CASE field_name WHEN 'AttributeLINK3PL' THEN 'rma/' || CAST(rma_id AS VARCHAR) ELSE CAST(rma_id AS VARCHAR) END AS value_string
    FROM a JOIN r ON a.shipment_nbr = r.rma_number
    """,
)
def link_write_back(t: Tables) -> DataFrame:
    missing = orders.missing_links(erp(t), "PB", datetime(1998, 3, 1))
    links = warehouse.link_per_return(return_status(t), "rma/", ["3"])
    return warehouse.link_write_back(missing, links).select("record_id", "field_name", "value_string")


def return_status(t: Tables) -> DataFrame:
    """Lineitems as warehouse return lines; the type is the line number."""
    checked = F.col("l_shipdate") + F.expr("INTERVAL 3 DAYS")
    return t.lineitem.select(
        F.concat(F.lit("S"), F.col("l_orderkey").cast("string")).alias("rma_number"),
        F.col("l_suppkey").alias("rma_id"), F.col("l_partkey").alias("rma_line_id"), F.col("l_linenumber").cast("string").alias("rma_type"),
        F.when(F.col("l_returnflag") == "R", "CLOSED").when(F.col("l_returnflag") == "A", "OPEN").otherwise("").alias("rma_status"),
        F.when(F.col("l_linestatus") == "F", "RECEIVED").otherwise("WAIT").alias("line_status"),
        F.col("l_partkey").cast("string").alias("inventory_cd"), F.col("l_quantity").cast("int").alias("qty"),
        F.col("l_shipdate").alias("created_at"), F.col("l_shipdate").alias("modified_at"), checked.alias("last_checked"),
    )


@query(
    "link_per_return",
    """
    SELECT DISTINCT 'S' || CAST(l_orderkey AS VARCHAR) AS rma_number, l_suppkey AS rma_id, 'rma/' || CAST(l_suppkey AS VARCHAR) AS link_3pl,
      CAST(l_linenumber AS VARCHAR) AS rma_type FROM lineitem WHERE l_linenumber NOT IN (3, 4)
    """,
)
def link_per_return(t: Tables) -> DataFrame:
    return warehouse.link_per_return(return_status(t), "rma/")


SEND_ORDER_COLUMNS = [
    "date", "order_type", "order_nbr", "line_items", "order_status", "status", "acct_cd", "acct_name", "customer_class", "payment_link", "billing_line1",
    "billing_city", "shipping_line1", "shipping_country", "billing_phone", "billing_email", "shipping_phone", "shipping_email", "sales_person_cd",
    "sales_person", "customer_link", "order_link", "crm_link", "customer_since",
]


@query("orders_to_send", TWINS["orders_to_send"])
def orders_to_send(t: Tables) -> DataFrame:
    tables = erp(t)
    return plain(
        orders.orders_to_send(tables, tables["order_ledger"], "cust/", "order/", "CRMID", 120).select(*SEND_ORDER_COLUMNS)
    )


@query("orders_to_resend", TWINS["orders_to_resend"])
def orders_to_resend(t: Tables) -> DataFrame:
    return plain(
        orders.orders_to_resend(erp(t), AS_OF, "600 DAYS", "cust/", "order/", "CRMID").select(*SEND_ORDER_COLUMNS)
    )


@query(
    "addresses_to_validate",
    with_erp("order_header", "address", "contact", "account", "status_lookup")
    + f"""
    SELECT s.order_nbr, s.order_type, rtrim(b.acct_cd) AS acct_cd, {day('s.order_date')} AS order_date, CAST(sa.is_validated AS INT) AS is_validated,
      j.status AS order_status, sa.line1 AS s_line1, coalesce(sa.line2, '') AS s_line2, sa.city AS s_city, sa.state AS s_state, sa.postal_code AS s_postal_code,
      sa.country AS s_country, ba.line1 AS b_line1, coalesce(ba.line2, '') AS b_line2, ba.city AS b_city, ba.state AS b_state, ba.postal_code AS b_postal_code,
      ba.country AS b_country, CASE WHEN sa.line1 = ba.line1 AND sa.line2 = ba.line2 AND sa.city = ba.city AND sa.state = ba.state
        AND sa.postal_code = ba.postal_code AND sa.country = ba.country THEN 1 ELSE 0 END AS match
    FROM erp_order_header s JOIN erp_address sa ON s.ship_address_id = sa.address_id JOIN erp_contact sc ON s.ship_contact_id = sc.contact_id
    JOIN erp_address ba ON s.bill_address_id = ba.address_id JOIN erp_contact bc ON s.bill_contact_id = bc.contact_id
    JOIN erp_account b ON s.customer_id = b.account_id JOIN erp_status_lookup j ON s.status = j.code AND j.tbl = 'SOOrder'
    WHERE (sa.is_validated IS NULL OR NOT sa.is_validated) AND s.status = 'H' AND s.order_type = 'WB'
    """,
)
def addresses_to_validate(t: Tables) -> DataFrame:
    return plain(orders.addresses_to_validate(erp(t)))


@query(
    "orders_sent_since",
    with_erp("order_ledger")
    + f"""
    SELECT order_nbr, order_nbr || '-' || decoded_status AS order_concat, {time("TIMESTAMP '2000-12-31 19:00:00' - INTERVAL 90 DAY")} AS cutoff
    FROM erp_order_ledger WHERE sent_at >= TIMESTAMP '2000-12-31 19:00:00' - INTERVAL 90 DAY
    """,
)
def orders_sent_since(t: Tables) -> DataFrame:
    sent = warehouse.orders_sent_since(erp(t, "order_ledger")["order_ledger"], datetime(2001, 1, 1), "90 DAYS")
    return sent.select("order_nbr", "order_concat", time_text("cutoff").alias("cutoff"))
