"""The driver tables in the shape of ERP and warehouse tables.

Orders are order headers and, but for held ones, shipments; lineitems their
lines; customers accounts, contacts and addresses; suppliers sites, users and
salespeople. The texts run unchanged on both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from opsflow.catalog.base import Tables

TYPE = """CASE o_orderpriority WHEN '1-URGENT' THEN 'PH' WHEN '2-HIGH' THEN 'SO' WHEN '3-MEDIUM' THEN 'RC'
          WHEN '4-NOT SPECIFIED' THEN 'QT' ELSE 'WB' END"""
VIA = "CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'GROUND' WHEN 2 THEN '2DAY' WHEN 3 THEN 'LTL' ELSE 'WHITEGLOVE399' END"
SHIPPED = "o_orderstatus <> 'P' AND o_orderkey % 4 <> 0"

ERP = {
    "order_header": f"""
        SELECT {TYPE} AS order_type, CAST(o_orderkey AS STRING) AS order_nbr,
          CASE o_orderstatus WHEN 'F' THEN 'C' WHEN 'O' THEN 'N' ELSE 'H' END AS status,
          o_custkey AS customer_id, o_custkey % 97 AS owner_id,
          CASE WHEN o_orderkey % 4 = 0 THEN o_custkey % 50 END AS sales_person_id,
          o_custkey AS ship_address_id, o_custkey + o_orderkey % 2 AS bill_address_id,
          o_custkey AS ship_contact_id, o_custkey + 1 AS bill_contact_id, {VIA} AS ship_via,
          o_orderdate AS order_date, CAST(o_totalprice AS DECIMAL(18,2)) AS order_total,
          CAST(o_totalprice AS DECIMAL(18,2)) AS paid_amt, CAST(o_orderkey % 100 AS DECIMAL(18,2)) AS freight_amt,
          CAST(o_orderkey % 10 AS DECIMAL(18,2)) AS premium_freight_amt, CAST(o_orderkey % 100 + o_orderkey % 10 AS DECIMAL(18,2)) AS freight_total,
          CASE WHEN o_orderkey % 3 = 0 THEN 'REF' || CAST(o_custkey AS STRING) END AS customer_order_nbr,
          CASE WHEN o_orderkey % 2 = 1 THEN 'QT' END AS orig_order_type,
          CASE WHEN o_orderkey % 2 = 1 THEN CAST(o_orderkey - 1 AS STRING) END AS orig_order_nbr,
          'O' || CAST(o_orderkey AS STRING) AS note_id, o_orderdate AS created_at,
          o_orderdate + INTERVAL 1 DAY AS modified_at, o_custkey % 40 AS created_by_id, o_custkey % 130 AS modified_by_id
        FROM orders""",
    "order_line": f"""
        SELECT {TYPE} AS order_type, CAST(l_orderkey AS STRING) AS order_nbr, l_linenumber AS line_nbr, l_partkey AS inventory_id,
          l_suppkey % 6 AS site_id, CAST(l_quantity AS DECIMAL(18,4)) AS order_qty, CAST(l_quantity AS DECIMAL(18,4)) AS shipped_qty,
          CAST(l_tax AS DECIMAL(18,4)) AS unit_price, CAST(l_extendedprice AS DECIMAL(18,4)) AS line_amt,
          CAST(l_discount AS DECIMAL(18,4)) AS disc_amt, CAST(l_tax AS DECIMAL(18,4)) AS ext_cost,
          'D' || CAST(l_linenumber AS STRING) || '  ' AS discount_id, l_linestatus = 'F' AS completed,
          'QT' AS orig_order_type, CASE WHEN l_orderkey % 3 = 1 THEN CAST(l_orderkey - 1 AS STRING) END AS orig_order_nbr
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "order_line_split": f"""
        SELECT DISTINCT {TYPE} AS order_type, CAST(l_orderkey AS STRING) AS order_nbr, l_linenumber AS line_nbr, 1 AS split_line_nbr
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "shipment": f"""
        SELECT 'I' AS shipment_type, 'S' || CAST(o_orderkey AS STRING) AS shipment_nbr,
          CASE o_orderkey % 3 WHEN 0 THEN 'N' WHEN 1 THEN 'F' ELSE 'H' END AS status, o_custkey % 6 AS site_id, o_custkey AS customer_id,
          o_custkey AS ship_contact_id, o_custkey AS ship_address_id, o_orderdate + INTERVAL 2 DAY AS ship_date, {VIA} AS ship_via,
          1 AS package_count, 'SN' || CAST(o_orderkey AS STRING) AS note_id, o_orderdate AS created_at, o_orderdate AS modified_at
        FROM orders WHERE {SHIPPED}""",
    "shipment_line": f"""
        SELECT 'I' AS shipment_type, 'S' || CAST(l_orderkey AS STRING) AS shipment_nbr, l_linenumber AS line_nbr, {TYPE} AS orig_order_type,
          CAST(l_orderkey AS STRING) AS orig_order_nbr, l_linenumber AS orig_line_nbr, 1 AS orig_split_line_nbr, l_partkey AS inventory_id,
          l_suppkey % 6 AS site_id, CAST(l_quantity AS DECIMAL(18,4)) AS shipped_qty, CAST(l_quantity AS DECIMAL(18,4)) AS orig_order_qty,
          l_shipdate AS modified_at
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE {SHIPPED} AND l_returnflag <> 'A'""",
    "shipment_split": f"""
        SELECT 'S' || CAST(l_orderkey AS STRING) AS shipment_nbr, l_linenumber AS line_nbr, 1 + l_suppkey % 2 AS split_line_nbr, l_partkey AS inventory_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE {SHIPPED}""",
    "package_split": f"""
        SELECT 'S' || CAST(l_orderkey AS STRING) AS shipment_nbr, l_linenumber AS shipment_line_nbr, 1 + l_suppkey % 2 AS shipment_split_line_nbr,
          l_partkey AS inventory_id, l_suppkey % 4 AS package_line_nbr,
          CAST(CASE WHEN l_tax > 0.07 THEN l_quantity - 1 ELSE l_quantity END AS DECIMAL(18,4)) AS packed_qty, l_shipdate AS created_at, l_shipdate AS modified_at
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE {SHIPPED} AND l_discount >= 0.02""",
    "package": f"""
        SELECT 'S' || CAST(l_orderkey AS STRING) AS shipment_nbr, l_suppkey % 4 AS line_nbr,
          CASE l_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'PRO ' || chr(9) || '9' || CAST(l_orderkey AS STRING)
            WHEN 2 THEN '1Z' || CAST(l_orderkey AS STRING) ELSE 'X8' || CAST(l_orderkey AS STRING) END AS track_number,
          min(l_shipdate) AS created_at
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE {SHIPPED} GROUP BY l_orderkey, l_suppkey % 4""",
    "item": "SELECT p_partkey AS inventory_id, CAST(p_partkey AS STRING) || '  ' AS inventory_cd, p_name AS descr, p_size % 10 AS item_class_id, p_size > 5 AS is_stock FROM part",
    "item_class": """
        SELECT DISTINCT p_size % 10 AS item_class_id, 'K' || CAST(p_size % 10 AS STRING) || ' ' AS item_class_cd,
          CASE p_size % 10 WHEN 0 THEN 'Spare part' WHEN 1 THEN 'Misc. Other' WHEN 2 THEN 'Main Product' ELSE 'Other' END AS descr FROM part""",
    "item_replenishment": "SELECT p_partkey AS inventory_id, 'R' || CAST(p_size AS STRING) AS class_id FROM part WHERE p_size % 2 = 0",
    "site": """
        SELECT s_suppkey AS site_id, CASE s_suppkey WHEN 0 THEN 'PARTNERA1' WHEN 1 THEN 'PARTNERA2' WHEN 2 THEN 'PB' ELSE 'OWN' || CAST(s_suppkey AS STRING) END || ' ' AS site_cd,
          s_suppkey AS address_id FROM supplier WHERE s_suppkey < 6""",
    "address": """
        SELECT c_custkey AS address_id, c_name AS line1, CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'Apt' END AS line2, c_mktsegment AS city,
          'NY' AS state, CAST(c_custkey % 1000 AS STRING) AS postal_code, CASE WHEN c_nationkey % 2 = 0 THEN 'US' ELSE 'DE' END AS country,
          CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN FALSE ELSE TRUE END AS is_validated FROM customer""",
    "contact": """
        SELECT c_custkey AS contact_id, CASE WHEN c_custkey % 7 <> 0 THEN 'Ann ' || c_name END AS full_name,
          CASE c_custkey % 3 WHEN 0 THEN ' Bo Lee' WHEN 1 THEN '' END AS attention, CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_custkey AS STRING) END AS phone1,
          '+' || CAST(c_custkey AS STRING) AS phone2, CASE WHEN c_custkey % 5 <> 0 THEN 'm' || CAST(c_custkey AS STRING) || ';x' END AS email FROM customer""",
    "account": """
        SELECT c_custkey AS account_id, 'C' || CAST(c_custkey AS STRING) || ' ' AS acct_cd, c_name AS acct_name, c_custkey AS contact_id,
          'A' || CAST(c_custkey AS STRING) AS note_id, TIMESTAMP '1994-05-01 00:00:00' AS created_at FROM customer""",
    "customer": "SELECT c_custkey AS account_id, CASE WHEN c_nationkey % 2 = 0 THEN 'B2B' ELSE 'D2C' END AS class_id FROM {customer}",
    "sales_person": "SELECT s_suppkey AS sales_person_id, 'SP' || CAST(s_suppkey AS STRING) || ' ' AS sales_person_cd, s_name || ' ' AS descr FROM supplier",
    "customer_sales_person": "SELECT c_custkey AS customer_id, c_custkey % 50 AS sales_person_id FROM customer WHERE c_custkey % 5 = 0",
    "users": "SELECT s_suppkey AS user_id, 'corp' || chr(92) || s_name AS user_name FROM supplier",
    "status_lookup": """
        SELECT 'SOOrder' AS tbl, 'C' AS code, 'Completed' AS status UNION ALL SELECT 'SOOrder', 'N', 'Open' UNION ALL SELECT 'SOOrder', 'H', 'On Hold'
        UNION ALL SELECT 'SOShipment', 'N', 'Open' UNION ALL SELECT 'SOShipment', 'F', 'Confirmed' UNION ALL SELECT 'SOShipment', 'H', 'On Hold'""",
    "shipment_attributes": f"""
        SELECT 'SN' || CAST(o_orderkey AS STRING) AS record_id, 'AttributeSHP2WH' AS field_name, CAST(o_orderkey % 2 AS DECIMAL(18,4)) AS value_numeric, CAST(NULL AS STRING) AS value_string FROM orders WHERE {SHIPPED}
        UNION ALL SELECT 'SN' || CAST(o_orderkey AS STRING), 'AttributeCOURCODE', NULL, 'CC' || CAST(o_orderkey % 9 AS STRING) FROM orders WHERE {SHIPPED} AND o_orderkey % 3 = 0
        UNION ALL SELECT 'SN' || CAST(o_orderkey AS STRING), 'AttributeLINK3PL', NULL, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'l' END FROM orders WHERE {SHIPPED} AND o_orderkey % 2 = 0
        UNION ALL SELECT 'SN' || CAST(o_orderkey AS STRING), 'AttributeRSORDERID', NULL, 'P' || CAST(o_orderkey AS STRING) FROM orders WHERE {SHIPPED} AND o_orderkey % 7 = 0""",
    "order_attributes": """
        SELECT 'O' || CAST(o_orderkey AS STRING) AS record_id, 'AttributeRCSHP2WH' AS field_name, CAST(o_orderkey % 2 AS DECIMAL(18,4)) AS value_numeric FROM orders WHERE o_orderkey % 3 <> 2""",
    "account_answers": "SELECT 'A' || CAST(c_custkey AS STRING) AS note_id, 'CRMID' AS attribute_id, 'crm/' || CAST(c_custkey AS STRING) AS value FROM customer WHERE c_custkey % 2 = 0",
    "invoice": f"SELECT CAST(o_orderkey AS STRING) AS order_nbr, {TYPE} AS order_type, 'I' || CAST(o_orderkey AS STRING) AS ref_nbr FROM orders WHERE o_orderkey % 3 = 0",
    "pay_link": "SELECT 'I' || CAST(o_orderkey AS STRING) AS ref_nbr, 'pay/' || CAST(o_orderkey AS STRING) AS url FROM orders WHERE o_orderkey % 6 = 0",
    "order_ledger": """
        SELECT CAST(o_orderkey AS STRING) AS order_nbr, CASE o_orderstatus WHEN 'F' THEN 'C' WHEN 'O' THEN 'N' ELSE 'X' END AS status,
          CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Open' ELSE 'Lost' END AS decoded_status, o_orderdate AS sent_at
        FROM orders WHERE o_orderkey % 5 = 0""",
}


def erp(t: Tables, *names: str) -> dict[str, DataFrame]:
    """The named ERP tables as lazy frames."""
    for table in ("customer", "supplier", "part", "orders", "lineitem"):
        getattr(t, table).createOrReplaceTempView(table)
    return {name: t.spark.sql(ERP[name].replace("{customer}", "customer")) for name in names or ERP}


def with_erp(*names: str) -> str:
    """``WITH`` clause for the SQL twins. ERP names win over driver names."""
    parts = []
    for name in names:
        body = ERP[name].replace("{customer}", "customer")
        parts.append(f"erp_{name} AS ({body})")
    return "WITH " + ",\n".join(parts) + "\n"
