"""Warehouse, campaign, tracking and CRM datasets over the driver tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from opsflow.catalog.base import Tables, cents, day_text, query
from opsflow.catalog.datasets import day, plain, return_status, time
from opsflow.catalog.documents import order_detail, packed_events
from opsflow.operators import nested
from opsflow.operators.joins import Lookup, enrich
from opsflow.plans import contracts, feeds, warehouse
from opsflow.session import scratch

AS_OF = datetime(2001, 8, 1)
SHIP = "'S' || CAST(l_orderkey AS VARCHAR)"


def ship_nbr(key: str = "l_orderkey"):
    return F.concat(F.lit("S"), F.col(key).cast("string"))


# -- warehouse copies ------------------------------------------------------


@query(
    "tracked_shipments_view",
    f"""
    WITH s AS (SELECT {SHIP} AS shipment_nbr, l_linenumber AS ship_line_nbr, CAST(l_orderkey AS VARCHAR) AS order_nbr, l_linenumber AS order_line_nbr,
        l_partkey AS inventory_cd, CASE l_suppkey % 5 WHEN 0 THEN 'Undefined' WHEN 1 THEN 'a,9' ELSE 'T' || CAST(l_suppkey AS VARCHAR) END AS tracking,
        CASE WHEN l_suppkey % 11 <> 0 THEN l_shipdate END AS tracking_created, l_shipdate AS ship_date, o_custkey AS customer_id,
        CASE l_returnflag WHEN 'A' THEN ' Al B' WHEN 'N' THEN '' END AS attention, c_name AS account_name, CASE WHEN o_custkey % 2 = 0 THEN 'US' ELSE 'DE' END AS country,
        CAST(o_custkey AS VARCHAR) AS phone, l_suppkey % 4 AS warehouse, CASE l_linestatus WHEN 'F' THEN 'SmartPost' WHEN 'O' THEN CASE WHEN l_tax > 0.04 THEN 'ups' END END AS carrier,
        CASE WHEN l_discount > 0.05 THEN 'WG' END AS ship_via
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
    first AS (SELECT shipment_nbr, max(tracking) AS t FROM s WHERE ship_line_nbr = 1 GROUP BY 1),
    k AS (SELECT s.* FROM s LEFT JOIN first USING (shipment_nbr) WHERE ship_line_nbr = 1 OR tracking <> t),
    w AS (SELECT s_suppkey AS warehouse, s_name AS line1, 'c' AS city, 'US' AS country FROM supplier WHERE s_suppkey < 4),
    ol AS (SELECT CAST(l_orderkey AS VARCHAR) AS order_nbr, l_linenumber AS line_nbr, o_totalprice AS order_total FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    g AS (SELECT CASE r_name WHEN 'AMERICA' THEN 'fedex' WHEN 'ASIA' THEN 'ups' ELSE lower(r_name) END AS named FROM region)
    SELECT k.shipment_nbr, ship_line_nbr, k.order_nbr, order_line_nbr, inventory_cd, p_name AS product_title, tracking,
      CASE WHEN attention <> '' THEN attention ELSE account_name END AS customer,
      CASE WHEN customer_id % 3 = 0 THEN 'Con' WHEN attention <> '' THEN 'Al' ELSE '' END AS first_name,
      CASE WHEN customer_id % 3 = 0 THEN 'Tact' WHEN attention <> '' THEN 'B' ELSE account_name END AS last_name,
      CASE WHEN k.country = 'US' THEN '+1' || phone ELSE phone END AS phone_number, k.warehouse, w.line1 AS origin_line1, w.city AS origin_city,
      w.country AS origin_country, order_total,
      CASE WHEN tracking LIKE '%,9%' THEN 'usps' WHEN named IS NOT NULL THEN named || '-slug'
           WHEN k.warehouse IN (0, 1) AND carrier IS NULL AND ship_via = 'WG' THEN 'sekologistics' ELSE '' END AS slug, carrier
    FROM k JOIN w ON k.warehouse = w.warehouse JOIN part ON inventory_cd = p_partkey
    JOIN ol ON k.order_nbr = ol.order_nbr AND order_line_nbr = ol.line_nbr
    LEFT JOIN g ON named = CASE carrier WHEN 'SmartPost' THEN 'fedex' ELSE carrier END
    WHERE ship_date >= TIMESTAMP '2001-08-01' - INTERVAL 500 DAY AND tracking <> 'Undefined' AND tracking_created IS NOT NULL AND k.warehouse <> 3
    """,
)
def tracked_shipments_view(t: Tables) -> DataFrame:
    lines = enrich(
        t.lineitem,
        [
            Lookup(t.orders, {"l_orderkey": "o_orderkey"}, {"customer_id": "o_custkey", "_total": "o_totalprice"}, "inner"),
            Lookup(t.customer, {"customer_id": "c_custkey"}, {"account_name": "c_name"}, "inner"),
        ],
    )
    order_nbr = F.col("l_orderkey").cast("string")
    supplier = F.col("l_suppkey")
    status = F.col("l_linestatus")
    shipments = lines.select(
        ship_nbr().alias("shipment_nbr"), F.col("l_linenumber").alias("ship_line_nbr"), order_nbr.alias("order_nbr"),
        F.col("l_linenumber").alias("order_line_nbr"), F.col("l_partkey").alias("inventory_cd"),
        F.when(supplier % 5 == 0, "Undefined").when(supplier % 5 == 1, "a,9").otherwise(F.concat(F.lit("T"), supplier.cast("string"))).alias("tracking"),
        F.when(supplier % 11 != 0, F.col("l_shipdate")).alias("tracking_created"), F.col("l_shipdate").alias("ship_date"), "customer_id",
        F.when(F.col("l_returnflag") == "A", " Al B").when(F.col("l_returnflag") == "N", "").alias("attention"), "account_name",
        F.when(F.col("customer_id") % 2 == 0, "US").otherwise("DE").alias("country"), F.col("customer_id").cast("string").alias("phone"),
        (supplier % 4).alias("warehouse"),
        F.when(status == "F", "SmartPost").when((status == "O") & (F.col("l_tax") > 0.04), "ups").alias("carrier"),
        F.when(F.col("l_discount") > 0.05, "WG").alias("ship_via"),
    )
    warehouses = t.supplier.where(F.col("s_suppkey") < 4).select(
        F.col("s_suppkey").alias("warehouse"), F.col("s_name").alias("line1"), F.lit("c").alias("city"), F.lit("US").alias("country")
    )
    third = F.col("c_custkey") % 3 == 0
    customers = t.customer.select(
        F.col("c_custkey").alias("customer_id"), F.when(third, "B2B").otherwise("D2C").alias("customer_class"),
        F.lit(" Con Tact").alias("contact_name"), F.col("c_name").alias("account_name"),
    )
    order_lines = lines.select(order_nbr.alias("order_nbr"), F.col("l_linenumber").alias("line_nbr"), F.col("_total").alias("order_total"))
    region = F.col("r_name")
    names = F.when(region == "AMERICA", "fedex").when(region == "ASIA", "ups").otherwise(F.lower(region))
    slugs = t.region.select(names.alias("carrier"), F.concat(names, F.lit("-slug")).alias("slug"))
    items = t.part.select(F.col("p_partkey").alias("inventory_cd"), F.col("p_name").alias("descr"))
    return warehouse.tracked_shipments_view(
        shipments, warehouses, items, customers, order_lines, slugs, AS_OF, "500 DAYS", [0, 1], ["WG"], [3]
    )


@query(
    "recent_deletions",
    f"""
    SELECT o_orderpriority AS order_type, CAST(o_orderkey AS VARCHAR) AS order_nbr, 'u' AS deleted_by, {time('o_orderdate')} AS deleted_at
    FROM orders WHERE o_orderstatus = 'P' AND o_orderdate >= TIMESTAMP '2001-08-01' - INTERVAL 400 DAY
    """,
)
def recent_deletions(t: Tables) -> DataFrame:
    tombstones = t.orders.where(F.col("o_orderstatus") == "P").select(
        F.col("o_orderpriority").alias("order_type"), F.col("o_orderkey").alias("order_nbr"), F.lit("u").alias("deleted_by"),
        F.col("o_orderdate").alias("deleted_at"), F.lit("dropped").alias("extra"),
    )
    return plain(warehouse.recent_deletions(tombstones, contracts.TABLES["order_deletions"], AS_OF, "400 DAYS"))


@query(
    "purge_copies",
    """
    SELECT 'orders' AS copy, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
      AND (l_orderkey, l_linenumber) NOT IN (SELECT (o_orderkey, CAST(1 + o_orderkey % 2 AS INT)) FROM orders WHERE o_orderstatus = 'O')
    UNION ALL SELECT 'shipments', count(*) FROM orders WHERE o_orderkey % 3 <> 0
    """,
)
def purge_copies(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("order_nbr"), F.col("l_linenumber").alias("line_nbr"))
    held = t.orders.where(F.col("o_orderstatus") == "P").select(F.col("o_orderkey").alias("order_nbr"))
    gone_lines = t.orders.where(F.col("o_orderstatus") == "O").select(
        F.col("o_orderkey").alias("order_nbr"), (1 + F.col("o_orderkey") % 2).cast("int").alias("line_nbr")
    )
    shipments = t.orders.select(F.col("o_orderkey").alias("shipment_nbr"))
    kept, left = warehouse.purge(lines, shipments, held, gone_lines, shipments.where(F.col("shipment_nbr") % 3 == 0))
    count = F.count(F.lit(1)).alias("n")
    return kept.agg(count).select(F.lit("orders").alias("copy"), "n").unionByName(
        left.agg(count).select(F.lit("shipments").alias("copy"), "n")
    )


@query(
    "fulfilment_audit",
    f"""
    SELECT o_orderkey AS id, {time('o_orderdate')} AS posted_at FROM orders
    WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('F', '')
      AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 7)
    ORDER BY o_orderdate DESC, o_orderkey LIMIT 20
    """,
)
def fulfilment_audit(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    status = F.when(F.col("o_orderpriority") == "1-URGENT", "ERROR").when(F.col("o_orderpriority") == "2-HIGH", "COMPLETED").otherwise("WAIT")
    fulfilment = t.orders.select(
        key.alias("id"), key.alias("shipment_nbr"), F.lit("SO").alias("order_type"), status.alias("ff_status"),
        F.when(F.col("o_orderstatus") == "F", "Confirmed").otherwise("Open").alias("shipment_status"), F.col("o_orderdate").alias("posted_at"),
    )
    deletions = t.lineitem.where(F.col("l_linenumber") == 7).select(F.col("l_orderkey").alias("shipment_nbr"), F.lit("SO").alias("order_type"))
    return plain(warehouse.fulfilment_audit(fulfilment, deletions, 20).select("id", "posted_at"))


@query(
    "refused_returns",
    """
    SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS key_value, '200 ERROR: Item does not exist' AS response,
      CASE WHEN l_orderkey IS NOT NULL THEN CASE l_linestatus WHEN 'O' THEN 'Open' ELSE 'Closed' END END AS return_status,
      CAST(l_partkey AS VARCHAR) AS inventory_cd, p_name AS descr, l_returnflag AS return_type,
      'so/' || coalesce(l_returnflag, '') || '/' || coalesce(CAST(l_orderkey AS VARCHAR), '') AS return_link
    FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag <> 'N') ON o_orderkey = l_orderkey LEFT JOIN part ON l_partkey = p_partkey
    WHERE o_orderkey % 3 = 0 AND (l_orderkey IS NULL OR l_linestatus = 'O') AND o_custkey % 10 <> 0
    """,
)
def refused_returns(t: Tables) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    log = t.orders.select(
        key.alias("key_value"),
        F.when(F.col("o_orderkey") % 3 == 0, "200 ERROR: Item does not exist").otherwise("200 ERROR: other").alias("response"),
    )
    returns = t.lineitem.where(F.col("l_returnflag") != "N").select(
        F.col("l_orderkey").cast("string").alias("return_nbr"), F.when(F.col("l_linestatus") == "O", "Open").otherwise("Closed").alias("return_status"),
        F.concat(F.col("l_partkey").cast("string"), F.lit(" ")).alias("inventory_cd"), F.col("l_returnflag").alias("return_type"),
    )
    items = t.part.select(F.concat(F.col("p_partkey").cast("string"), F.lit(" ")).alias("inventory_cd"), F.col("p_name").alias("descr"))
    gone = t.orders.where(F.col("o_custkey") % 10 == 0).select(key.alias("order_nbr"))
    return warehouse.stuck_returns(log, returns, items, gone, "so/")


def closed(t: Tables) -> DataFrame:
    """Lineitems as closed shipments; the suffix of the number is the line's."""
    return t.lineitem.select(
        F.concat(ship_nbr(), F.lit("-"), (1 + F.col("l_linenumber") % 3).cast("string")).alias("rma_number"),
        F.col("l_partkey").cast("string").alias("inventory_cd"), F.col("l_quantity").cast("int").alias("qty_shipped"),
        F.concat(F.lit("Z"), F.col("l_suppkey").cast("string")).alias("tracking"), F.col("l_returnflag").alias("carrier_code"),
    )


@query(
    "closed_shipments_with_lines",
    f"""
    SELECT replace(replace(replace({SHIP} || '-' || CAST(1 + l_linenumber % 3 AS VARCHAR), '-1', ''), '-2', ''), '-3', '') AS rma_number,
      CAST(l_partkey AS VARCHAR) AS inventory_cd, CAST(l_quantity AS INT) AS qty_shipped, 'Z' || CAST(l_suppkey AS VARCHAR) AS tracking,
      l_returnflag AS carrier_code, count(*) OVER (PARTITION BY l_orderkey) AS lines FROM lineitem
    """,
)
def closed_shipments_with_lines(t: Tables) -> DataFrame:
    return warehouse.closed_shipments_with_lines(closed(t))


READY = f"""
    ff AS (SELECT {SHIP} AS shipment_nbr, l_linenumber AS ship_line_nbr, l_suppkey AS split_line_nbr, CAST(l_partkey AS VARCHAR) AS inventory_cd,
        CAST(l_quantity AS INT) AS ship_qty, CAST(l_quantity AS INT) - CAST(l_tax > 0.06 AS INT) AS rs_qty, concat('T', l_suppkey % 3) AS tracking,
        nullif(l_linestatus, 'F') AS rs_status, CASE l_returnflag WHEN 'R' THEN 'Ready' WHEN 'A' THEN 'Complete' END AS ff_status,
        concat('P', l_orderkey) AS shipment_id FROM lineitem),
    -- one row per shipment and item, per shipment, per shipment and status, per package
    wanted AS (SELECT shipment_nbr, inventory_cd, sum(ship_qty) AS total FROM ff GROUP BY ALL),
    pending AS (SELECT shipment_nbr, count(*) AS pending, count(rs_status) AS known FROM ff WHERE ff_status IS NULL GROUP BY ALL),
    alike AS (SELECT shipment_nbr, rs_status, count(*) AS same FROM ff WHERE ff_status IS NULL GROUP BY ALL),
    package AS (SELECT shipment_nbr, tracking, count(*) AS items_on_package FROM ff WHERE ff_status = 'Ready' GROUP BY ALL),
    load AS (SELECT shipment_nbr, sum(items_on_package) AS max_package_num FROM package GROUP BY ALL HAVING max(items_on_package) < 3),
    ready AS (
      SELECT ff.*, row_number() OVER along_package AS num, row_number() OVER along_shipment AS package_num, concat('c', tracking) AS courier_code,
        concat('n', tracking) AS courier_name, items_on_package, CAST(max_package_num AS BIGINT) AS max_package_num,
        CASE WHEN rs_qty <> total THEN 'Not' WHEN pending > known OR (rs_status IS NOT NULL AND known > coalesce(same, 0)) THEN 'Partially Complete'
             ELSE 'Complete' END AS complete
      FROM ff JOIN load USING (shipment_nbr) JOIN package USING (shipment_nbr, tracking) JOIN wanted USING (shipment_nbr, inventory_cd)
      LEFT JOIN pending USING (shipment_nbr) LEFT JOIN alike USING (shipment_nbr, rs_status)
      WHERE ff_status = 'Ready'
      WINDOW along_package AS (PARTITION BY shipment_nbr, tracking ORDER BY ship_line_nbr, split_line_nbr, inventory_cd),
             along_shipment AS (PARTITION BY shipment_nbr ORDER BY ship_line_nbr, split_line_nbr, inventory_cd))
"""


def ready(t: Tables) -> DataFrame:
    """Ready partner shipments made of lineitems."""
    qty = F.col("l_quantity").cast("int")
    tracking = F.concat(F.lit("T"), (F.col("l_suppkey") % 3).cast("string"))
    partner = F.concat(F.lit("P"), F.col("l_orderkey").cast("string"))
    flag = F.col("l_returnflag")
    fulfil = t.lineitem.select(
        ship_nbr().alias("shipment_nbr"), F.col("l_linenumber").alias("ship_line_nbr"), F.col("l_suppkey").alias("split_line_nbr"),
        F.col("l_partkey").cast("string").alias("inventory_cd"), qty.alias("ship_qty"),
        (qty - F.when(F.col("l_tax") > 0.06, 1).otherwise(0)).alias("rs_qty"), tracking.alias("tracking"),
        F.nullif(F.col("l_linestatus"), F.lit("F")).alias("rs_status"),
        F.when(flag == "R", "Ready").when(flag == "A", "Complete").alias("ff_status"), partner.alias("shipment_id"),
    )
    items = fulfil.select("shipment_id", "shipment_nbr", "inventory_cd", "tracking").distinct().withColumns(
        {"courier_code": F.concat(F.lit("c"), "tracking"), "courier_name": F.concat(F.lit("n"), "tracking")}
    )
    return warehouse.ready_shipments(fulfil, items, max_items=2)


@query("ready_shipments", f"WITH {READY} SELECT * FROM ready")
def ready_shipments(t: Tables) -> DataFrame:
    return ready(t)


@query(
    "packed_event_items",
    """
    WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem)
    SELECT CAST(l_orderkey AS VARCHAR) AS shipment_nbr, CAST(l_partkey AS VARCHAR) AS inventory_cd, CAST(l_quantity AS INT) AS qty
    FROM l WHERE l_orderkey % 10 <> 0 AND l_orderkey % 7 <> 0
      AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F' AND o_orderdate >= TIMESTAMP '2001-08-01' - INTERVAL 1000 DAY)
    """,
)
def packed_event_items(t: Tables) -> DataFrame:
    shipments = t.orders.select(
        F.col("o_orderkey").cast("string").alias("shipment_nbr"), "o_orderdate",
        F.when(F.col("o_orderstatus") == "F", "Completed").otherwise("Open").alias("status"),
    ).withColumnRenamed("o_orderdate", "order_date")
    return warehouse.packed_events(packed_events(t), "jsonData", shipments, AS_OF, "1000 DAYS").select(
        "shipment_nbr", "inventory_cd", "qty"
    )


AWAITING = """
    awaiting AS (SELECT l_orderkey, l_suppkey AS rma_id, l_partkey AS rma_line_id, CAST(l_quantity AS INT) AS qty, l_shipdate FROM lineitem
      WHERE l_linenumber = 3 AND (l_returnflag = 'R' OR l_linestatus = 'F') AND l_shipdate >= TIMESTAMP '2001-08-01' - INTERVAL 1200 DAY)
"""


@query("returns_awaiting_receipt", f"WITH {AWAITING} SELECT rma_id, rma_line_id, qty, {day('l_shipdate')} AS created_at FROM awaiting")
def returns_awaiting_receipt(t: Tables) -> DataFrame:
    rows = warehouse.returns_awaiting_receipt(return_status(t), AS_OF, "1200 DAYS")
    return rows.select("rma_id", "rma_line_id", "qty", day_text("created_at").alias("created_at"))


@query(
    "receipts_to_create",
    f"""
    WITH {AWAITING}, f AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, rma_id, rma_line_id) AS rn FROM awaiting)
    SELECT o_orderpriority AS order_type, 'S' || CAST(o_orderkey AS VARCHAR) AS order_nbr, o_custkey AS acct_cd, o_orderstatus AS inventory_cd, 1 AS qty,
      CAST(rma_line_id AS VARCHAR) AS inventory_cd_3pl, f.qty AS qty_3pl
    FROM orders JOIN f ON o_orderkey = l_orderkey AND rn = 1 WHERE o_orderpriority = '3-MEDIUM'
    """,
)
def receipts_to_create(t: Tables) -> DataFrame:
    open_returns = t.orders.where(F.col("o_orderpriority") == "3-MEDIUM").select(
        F.col("o_orderpriority").alias("order_type"), ship_nbr("o_orderkey").alias("return_nbr"), F.col("o_custkey").alias("acct_cd"),
        F.col("o_orderstatus").alias("inventory_cd"), F.lit(1).alias("qty"),
    )
    status = return_status(t).withColumn("rma_number", F.concat("rma_number", F.lit("-2")))
    return warehouse.receipts_to_create(open_returns, warehouse.returns_awaiting_receipt(status, AS_OF, "1200 DAYS"))


RANKED = """
    c AS (SELECT DISTINCT l_orderkey AS order_nbr, CASE l_returnflag WHEN 'R' THEN 'Open' WHEN 'A' THEN 'Completed' ELSE 'On Hold' END AS status FROM lineitem),
    k AS (SELECT *, CASE status WHEN 'Completed' THEN 1 WHEN 'Open' THEN 4 ELSE 6 END AS rank FROM c),
    n AS (SELECT *, row_number() OVER (PARTITION BY order_nbr ORDER BY rank, status) AS rn FROM k),
    conflicts AS (SELECT a.order_nbr, a.status, b.status AS alternative, a.rank FROM n a JOIN n b ON a.order_nbr = b.order_nbr AND a.rn = 1 AND b.rn = 2)
"""


def status_copy(t: Tables) -> DataFrame:
    flag = F.col("l_returnflag")
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_nbr"),
        F.when(flag == "R", "Open").when(flag == "A", "Completed").otherwise("On Hold").alias("status"),
    )


@query("status_conflicts", f"WITH {RANKED} SELECT * FROM conflicts")
def status_conflicts(t: Tables) -> DataFrame:
    return warehouse.status_conflicts(status_copy(t))


@query(
    "clean_status_conflicts",
    f"""
    WITH {RANKED}, truth AS (SELECT o_orderkey AS order_nbr, CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Open' ELSE 'On Hold' END AS status FROM orders)
    SELECT 'doomed' AS kind, l_returnflag AS name, count(*) AS n FROM lineitem JOIN conflicts ON l_orderkey = conflicts.order_nbr JOIN truth ON l_orderkey = truth.order_nbr
    WHERE CASE l_returnflag WHEN 'R' THEN 'Open' WHEN 'A' THEN 'Completed' ELSE 'On Hold' END <> truth.status GROUP BY ALL
    UNION ALL SELECT 'orders', truth.status, count(*) FROM conflicts JOIN truth USING (order_nbr) GROUP BY ALL
    """,
)
def clean_status_conflicts(t: Tables) -> DataFrame:
    status = F.col("o_orderstatus")
    truth = t.orders.select(
        F.col("o_orderkey").alias("order_nbr"),
        F.when(status == "F", "Completed").when(status == "O", "Open").otherwise("On Hold").alias("status"),
    )
    doomed, counts = warehouse.clean_status_conflicts(status_copy(t), truth)
    name = F.when(F.col("status") == "Open", "R").when(F.col("status") == "Completed", "A").otherwise("N")
    return doomed.groupBy(F.lit("doomed").alias("kind"), name.alias("name")).agg(F.count(F.lit(1)).alias("n")).unionByName(
        counts.select(F.lit("orders").alias("kind"), F.col("true_status").alias("name"), F.col("orders").alias("n"))
    )


@query(
    "numbers_to_recheck",
    f"""
    WITH k AS (SELECT {SHIP} AS rma_number FROM lineitem WHERE l_linenumber = 1 UNION SELECT {SHIP} FROM lineitem WHERE l_linenumber = 2
               UNION SELECT 'S' || CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus <> 'F'),
    s AS (SELECT {SHIP} AS rma_number, l_shipdate + INTERVAL 3 DAY AS c, CASE l_returnflag WHEN 'R' THEN 'CLOSED' WHEN 'A' THEN 'OPEN' ELSE '' END AS rma_status,
            CASE l_linestatus WHEN 'F' THEN 'RECEIVED' ELSE 'WAIT' END AS line_status FROM lineitem WHERE l_linenumber < 5)
    SELECT DISTINCT k.rma_number, {time('c')} AS last_checked, rma_status, line_status FROM k LEFT JOIN s ON k.rma_number = s.rma_number
    WHERE (rma_status NOT IN ('CLOSED', '') OR rma_status IS NULL) OR (c >= TIMESTAMP '2001-08-01' - INTERVAL 300 DAY AND rma_status <> 'OPEN')
    """,
)
def numbers_to_recheck(t: Tables) -> DataFrame:
    numbers = t.lineitem.select(ship_nbr().alias("rma_number"), "l_linenumber")
    log = t.orders.select(
        ship_nbr("o_orderkey").alias("key_value"), F.when(F.col("o_orderstatus") == "F", "Item does not exist").otherwise("ok").alias("response")
    )
    status = return_status(t).where(F.col("rma_type").cast("int") < 5)
    line = F.col("l_linenumber")
    return plain(
        warehouse.numbers_to_recheck(numbers.where(line == 1), numbers.where(line == 2), log, status, AS_OF, "300 DAYS")
    )


PACK = f"""
    WITH {READY},
    base AS (SELECT {SHIP} AS shipment_nbr, l_linenumber AS ship_line_nbr, l_suppkey AS split_line_nbr, CAST(l_partkey AS VARCHAR) AS inventory_cd, l_orderkey
             FROM lineitem WHERE l_linestatus = 'O'),
    ev AS (SELECT {SHIP} AS shipment_nbr, CAST(l_partkey AS VARCHAR) AS inventory_cd, CAST(l_quantity AS INT) AS qty, 'E' || CAST(l_suppkey % 2 AS VARCHAR) AS tracking
           FROM lineitem WHERE l_returnflag = 'N' AND l_quantity < 20),
    cl AS (SELECT shipment_nbr, inventory_cd, qty, tracking FROM (
             SELECT {SHIP} AS shipment_nbr, CAST(l_partkey AS VARCHAR) AS inventory_cd, CAST(l_quantity AS INT) AS qty, 'Z' || CAST(l_suppkey AS VARCHAR) AS tracking,
               row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY 'Z' || CAST(l_suppkey AS VARCHAR), CAST(l_quantity AS INT), l_returnflag) AS rn FROM lineitem WHERE l_discount >= 0.05) WHERE rn = 1),
    m AS (
      SELECT b.shipment_nbr, b.ship_line_nbr, b.split_line_nbr, b.inventory_cd, ev.qty AS qty_3pl, ev.tracking, 'events' AS source
      FROM base b JOIN ev ON b.shipment_nbr = ev.shipment_nbr AND b.inventory_cd = ev.inventory_cd
      UNION ALL SELECT b.shipment_nbr, b.ship_line_nbr, b.split_line_nbr, b.inventory_cd, r.rs_qty, r.tracking, 'ready'
      FROM base b JOIN ready r ON b.shipment_nbr = r.shipment_nbr AND b.ship_line_nbr = r.ship_line_nbr AND b.split_line_nbr = r.split_line_nbr AND b.inventory_cd = r.inventory_cd
      WHERE NOT EXISTS (SELECT 1 FROM ev WHERE b.shipment_nbr = ev.shipment_nbr AND b.inventory_cd = ev.inventory_cd)
      UNION ALL SELECT b.shipment_nbr, b.ship_line_nbr, b.split_line_nbr, b.inventory_cd, cl.qty, cl.tracking, 'closed'
      FROM base b JOIN cl ON b.shipment_nbr = cl.shipment_nbr AND b.inventory_cd = cl.inventory_cd)
"""


def packing(t: Tables) -> tuple[DataFrame, DataFrame]:
    open_lines = t.lineitem.where(F.col("l_linestatus") == "O").select(
        ship_nbr().alias("shipment_nbr"), F.col("l_linenumber").alias("ship_line_nbr"), F.col("l_suppkey").alias("split_line_nbr"),
        F.col("l_partkey").cast("string").alias("inventory_cd"), F.col("l_quantity").cast("int").alias("ship_qty"),
        F.col("l_quantity").cast("int").alias("order_qty"),
    )
    events = t.lineitem.where((F.col("l_returnflag") == "N") & (F.col("l_quantity") < 20)).select(
        F.concat(ship_nbr(), F.lit("-1")).alias("shipment_nbr"), F.col("l_partkey").cast("string").alias("inventory_cd"),
        F.col("l_quantity").cast("int").alias("qty"), F.concat(F.lit("E"), (F.col("l_suppkey") % 2).cast("string")).alias("tracking"),
        F.col("l_linenumber").alias("order_item_qty"), F.col("l_returnflag").alias("courier"),
    )
    shipped = t.lineitem.where(F.col("l_discount") >= 0.05).select(
        ship_nbr().alias("rma_number"), F.col("l_partkey").cast("string").alias("inventory_cd"), F.col("l_quantity").cast("int").alias("qty_shipped"),
        F.concat(F.lit("Z"), F.col("l_suppkey").cast("string")).alias("tracking"), F.col("l_returnflag").alias("carrier_code"),
    )
    return warehouse.packages_to_add(
        open_lines, ready(t), events, warehouse.closed_shipments_with_lines(shipped), "01/31/2024 00:00:00"
    )


@query("packages_matched", PACK + "SELECT * FROM m")
def packages_matched(t: Tables) -> DataFrame:
    return packing(t)[0].select("shipment_nbr", "ship_line_nbr", "split_line_nbr", "inventory_cd", "qty_3pl", "tracking", "source")


@query(
    "packages_to_add",
    PACK + "SELECT shipment_nbr, count(DISTINCT tracking) AS n_packages, count(*) AS n_contents, CAST(sum(qty_3pl) AS BIGINT) AS qty FROM m GROUP BY 1",
)
def packages_to_add(t: Tables) -> DataFrame:
    contents = F.flatten("packages.PackageContents")
    return packing(t)[1].select(
        "shipment_nbr", F.size("packages").alias("n_packages"), F.size(contents).alias("n_contents"),
        F.aggregate(contents, F.lit(0).cast("bigint"), lambda n, c: n + c["Quantity"]["value"]).alias("qty"),
    )


@query(
    "failed_payloads",
    """
    SELECT DISTINCT 'S' || CAST(o_orderkey AS VARCHAR) AS shipment_nbr, CAST(o_custkey AS VARCHAR) AS customer_id FROM orders
    WHERE o_orderstatus = 'F' AND CAST(o_orderdate AS DATE) = DATE '2000-03-01'
    """,
)
def failed_payloads(t: Tables) -> DataFrame:
    def boxed(col):
        return F.struct(col.alias("value"))

    payload = F.to_json(
        F.struct(boxed(ship_nbr("o_orderkey")).alias("ShipmentNbr"), boxed(F.col("o_custkey").cast("string")).alias("CustomerID"))
    )
    log = t.orders.select(
        payload.alias("payload"), F.when(F.col("o_orderstatus") == "F", "Failure").otherwise("Success").alias("response"),
        F.col("o_orderdate").alias("ts"), ship_nbr("o_orderkey").alias("key_value"),
    )
    return warehouse.failed_payloads(log.unionByName(log), F.lit(date(2000, 3, 1)), ["x"]).drop("payload")


# -- partner reports -------------------------------------------------------

UTC = "yyyy-MM-dd'T'HH:mm:ss'Z'"


@query(
    "closed_shipment_lines",
    f"SELECT {SHIP} AS rma_number, l_suppkey AS rma_line_id, {day('l_shipdate')} AS line_day, CAST(l_quantity AS BIGINT) AS qty_shipped FROM lineitem",
)
def closed_shipment_lines(t: Tables) -> DataFrame:
    stamp = F.date_format("l_shipdate", UTC)
    reports = nested.collect_parts(
        t.lineitem, ["l_orderkey", "l_shipdate"], ["l_linenumber", "l_partkey", "l_suppkey"],
        F.struct(
            F.col("l_suppkey").alias("rmaLineId"), F.col("l_partkey").alias("itemNum"), F.col("l_quantity").cast("bigint").alias("qtyShipped"),
            F.col("l_quantity").cast("bigint").alias("qtytoShip"), F.lit("loc").alias("location"), F.lit("cat").alias("category"), F.lit("m").alias("model"),
        ),
        "shipLines",
    ).select(
        ship_nbr().alias("rmaNumber"), F.col("l_orderkey").alias("rmaId"), F.lit("W").alias("rmaType"), stamp.alias("createDate"), stamp.alias("shipDate"),
        F.lit("c").alias("carrier"), F.lit("cc").alias("carrierCode"), F.lit("t").alias("trackingNum"), F.lit("p").alias("priority"),
        F.lit(1.0).alias("freightCost"), F.lit("o").alias("outboundShipMethod"), "shipLines",
    )
    return feeds.closed_shipments(reports).select("rma_number", "rma_line_id", day_text("ship_date").alias("line_day"), "qty_shipped")


@query(
    "receipt_rows",
    f"SELECT {SHIP} AS rma_number, {time('l_shipdate')} AS receipt_date, l_linenumber AS receipt_id, l_suppkey AS rma_line_id, l_quantity AS qty FROM lineitem",
)
def receipt_rows(t: Tables) -> DataFrame:
    reports = t.lineitem.select(
        ship_nbr().alias("rmaNumber"), F.date_format("l_shipdate", UTC).alias("receiptDate"), F.col("l_linenumber").alias("receiptId"),
        F.col("l_orderkey").alias("rmaId"), F.col("l_suppkey").alias("rmaLineId"), F.col("l_quantity").alias("quantity"),
        F.col("l_partkey").alias("itemNumber"), F.lit("l").alias("location"), F.lit("t").alias("itemType"), F.lit("c").alias("category"),
        F.lit("d").alias("description"), F.col("l_extendedprice").alias("price"), F.col("l_tax").alias("cost"),
    )
    return plain(feeds.receipts(reports).select("rma_number", "receipt_date", "receipt_id", "rma_line_id", "qty"))


@query(
    "campaign_performance",
    """
    WITH r AS (SELECT CAST(o_orderdate AS DATE) AS report_date, o_orderkey AS campaign_id, 'Camp ' || o_orderstatus AS campaign_name, o_custkey AS clicks,
        CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS cost FROM orders),
    old AS (SELECT * FROM r WHERE campaign_id % 3 <> 0)
    SELECT r.campaign_id, strftime(r.report_date, '%Y-%m-%d') AS report_date, r.campaign_name, r.clicks, r.cost,
      CASE WHEN r.campaign_id % 3 = 0 THEN 'insert' ELSE 'update' END AS fate
    FROM r WHERE campaign_id % 3 = 0 OR campaign_id % 4 = 0
    """,
)
def campaign_performance(t: Tables) -> DataFrame:
    """A report written, read and cleaned, compared with an older state."""
    path = scratch(t.spark, "campaigns")
    key = F.col("o_orderkey")
    t.orders.select(
        day_text("o_orderdate").alias("Day"), F.concat(F.lit("Camp "), "o_orderstatus", F.lit(" ("), key.cast("string"), F.lit(")")).alias("Campaign"),
        key.alias("CampaignId"), F.col("o_custkey").alias("Clicks"), F.lit("x").alias("Displays"), cents(F.col("o_totalprice")).alias("AdvertiserCost"),
        F.lit(1).alias("SalesAllPc30d"), F.lit("2.5").alias("RevenueGeneratedAllPc30d"),
    ).write.option("sep", ";").option("header", True).csv(path)
    loaded = feeds.load_campaigns(t.spark, path, 7, F.lit(AS_OF))
    cost = F.when(F.col("campaign_id") % 4 == 0, F.col("cost") + 1).otherwise(F.col("cost"))
    stored = loaded.where(F.col("campaign_id") % 3 != 0).withColumn("cost", cost.cast("decimal(18,4)"))
    log, writes = feeds.campaign_diff(stored, loaded)
    fate = enrich(
        writes, [Lookup(log.select("campaign_id", "report_date", "diff"), {"campaign_id": "campaign_id", "report_date": "report_date"}, {"_d": "diff"})]
    )
    return fate.select(
        "campaign_id", day_text("report_date").alias("report_date"), "campaign_name", "clicks", "cost",
        F.when(F.col("_d").isNull(), "insert").otherwise("update").alias("fate"),
    )


@query(
    "sales_by_campaign",
    """
    SELECT concat('#', user_id) AS order_name, event_type AS utm_source, strftime(ts, '%Y-%m-%d') AS day,
      CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS gross_sales, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS net_sales
    FROM events WHERE user_id % 5 <> 0 AND CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'
    GROUP BY ALL HAVING gross_sales <> 0
    """,
)
def sales_by_campaign(t: Tables) -> DataFrame:
    sales = t.events.select(
        F.concat(F.lit("#"), F.col("user_id").cast("string")).alias("order_name"), F.col("event_type").alias("utm_source"),
        F.lit("").alias("order_utm_source"), F.col("ts").alias("day"),
        (F.col("user_id") % 5 == 0).alias("is_canceled_order"), cents(F.col("value")).alias("gross_sales"), cents(F.col("value")).alias("net_sales"),
    )
    report = feeds.sales_by_campaign(sales, date(2024, 1, 10), date(2024, 1, 20))
    amounts = [F.col(c).cast("double").alias(c) for c in ("gross_sales", "net_sales")]
    return report.select("order_name", "utm_source", day_text("day").alias("day"), *amounts)


@query(
    "helpdesk_documents",
    """
    WITH n AS (SELECT l_orderkey, count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_quantity, l_suppkey % 3 FROM lineitem) GROUP BY 1)
    SELECT o_orderkey AS order_nbr, coalesce(n, 0) AS n_lines, 'New York' AS billing_state_name FROM orders LEFT JOIN n ON o_orderkey = l_orderkey WHERE o_orderkey % 2 = 1
    """,
)
def helpdesk_documents(t: Tables) -> DataFrame:
    """Documents of all orders; the ledger holds the even ones as they are now."""
    base = t.orders.select(
        F.col("o_orderkey").alias("order_nbr"), F.col("o_orderstatus").alias("order_status"), F.lit("NY").alias("billing_state"), F.lit("US").alias("billing_country")
    )
    detail = order_detail(t)
    empty = t.spark.createDataFrame([], "order_nbr BIGINT, decoded_status STRING, piece INT, part BIGINT, payload STRING")
    everything = feeds.order_documents(base, detail, empty)
    ledger = everything.where(F.col("order_nbr") % 2 == 0).select("order_nbr", "decoded_status", "piece", "part", "payload")
    fresh = feeds.order_documents(base, detail, ledger)
    return fresh.select("order_nbr", F.size("line_items").cast("bigint").alias("n_lines"), "billing_state_name")


def parcels(t: Tables) -> DataFrame:
    """Orders as tracked shipments."""
    name = F.concat(F.lit("Cust "), F.col("o_custkey").cast("string"))
    none = F.lit(None).cast("string")
    return t.orders.select(
        F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("tracking"), F.lit("ups").alias("slug"), ship_nbr("o_orderkey").alias("shipment_nbr"),
        name.alias("customer"), F.lit("US").alias("origin_country"), F.lit("NJ").alias("origin_state"), F.lit("o").alias("origin_line1"), none.alias("origin_line2"),
        F.lit("US").alias("dest_country"), F.lit("NY").alias("dest_state"), F.lit("d").alias("dest_line1"), F.lit("e").alias("dest_line2"),
        F.col("o_orderkey").cast("string").alias("order_nbr"), F.col("o_orderdate").alias("order_date"), F.lit("p").alias("product_title"),
        F.lit("a@b").alias("email"), F.lit("+1").alias("phone_number"), F.col("o_orderpriority").alias("customer_class"),
        F.col("o_orderstatus").alias("item_class"), none.alias("package_value"),
    )


@query(
    "new_trackings",
    """
    SELECT 'T' || CAST(o_orderkey AS VARCHAR) AS tracking_number, 'New York' AS destination_state, CAST(o_custkey AS VARCHAR) AS last_name FROM orders
    WHERE o_orderkey % 4 <> 0 AND o_orderkey % 6 <> 0
    """,
)
def new_trackings(t: Tables) -> DataFrame:
    shipments = parcels(t)
    number = F.col("order_nbr").cast("bigint")
    log = shipments.where(number % 4 == 0).select("shipment_nbr", "order_nbr", "tracking")
    old = shipments.where(number % 6 == 0).select("order_nbr", "tracking")
    return feeds.new_trackings(shipments, log, old).select("tracking_number", "destination_state", F.col("custom_fields.last_name").alias("last_name"))


@query(
    "tracking_updates",
    """
    SELECT 'id' || CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderkey % 5 = 0 THEN 'Cust ' || CAST(o_custkey AS VARCHAR) END AS name,
      CASE WHEN o_orderkey % 7 = 0 THEN o_orderpriority || '|' || o_orderstatus END AS tags, 'S' || CAST(o_orderkey AS VARCHAR) AS shipment_nbr
    FROM orders WHERE o_orderkey % 5 = 0 OR o_orderkey % 7 = 0
    """,
)
def tracking_updates(t: Tables) -> DataFrame:
    """Records as sent before; some with another name, some with other tags."""
    shipments = parcels(t)
    documents = nested.tracking_documents(shipments, {"NY": "New York"})
    number = F.col("order_number").cast("bigint")
    first = F.get("customers", F.lit(0))
    renamed = F.array(first.withField("name", F.when(number % 5 == 0, "Old").otherwise(F.upper(first["name"]))))
    records = documents.select(
        F.concat(F.lit("id"), "order_number").alias("id"), "tracking_number", "order_number", renamed.alias("customers"),
        F.when(number % 7 == 0, F.array(F.lit("old"))).otherwise(F.col("shipment_tags")).alias("shipment_tags"),
    )
    return feeds.tracking_updates(records, shipments).select(
        "id", F.get("customers", F.lit(0))["name"].alias("name"), F.array_join("shipment_tags", "|").alias("tags"), "shipment_nbr"
    )


# -- CRM -------------------------------------------------------------------


@query(
    "open_deals",
    """
    SELECT o_orderkey AS id FROM orders WHERE o_orderpriority = '1-URGENT' AND
      ((o_orderdate >= TIMESTAMP '1999-08-01' AND o_orderstatus NOT IN ('F', 'P')) OR (o_orderdate >= TIMESTAMP '2001-01-01' AND o_orderstatus IN ('F', 'P')))
    """,
)
def open_deals(t: Tables) -> DataFrame:
    deals = t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("pipeline"), F.col("o_orderdate").alias("created_at"), F.col("o_orderstatus").alias("deal_stage")
    )
    return feeds.open_deals(deals.unionByName(deals), "1-URGENT", ["F", "P"], datetime(1999, 8, 1), datetime(2001, 1, 1)).select("id")


@query(
    "deal_snapshot",
    """
    SELECT o_orderkey AS deal_id, o_orderstatus AS stage, coalesce(s_name, 'no matching owner') AS rep_name,
      CASE WHEN s_name IS NULL THEN 'no matching owner' WHEN s_suppkey % 2 = 0 THEN 'inside' ELSE 'unknown' END AS team,
      CAST(o_custkey AS DOUBLE) AS amount, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_true_won,
      date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01') AS days_in_pipeline
    FROM orders LEFT JOIN supplier ON o_custkey = s_suppkey
    """,
)
def deal_snapshot(t: Tables) -> DataFrame:
    text_of = {
        "dealname": F.lit("d"), "dealstage": F.col("o_orderstatus"), "dealtype": F.lit("t"), "product": F.lit("p"),
        "amount": F.col("o_custkey").cast("string"), "owner_id": F.col("o_custkey").cast("string"), "createdate": F.date_format("o_orderdate", UTC),
    }
    bag = F.create_map(*[c for name, value in text_of.items() for c in (F.lit(name), value)])
    deals = t.orders.select(F.col("o_orderkey").alias("id"), bag.alias("properties"))
    owners = t.supplier.select(F.col("s_suppkey").cast("string").alias("owner_id"), F.col("s_name").alias("rep_name"))
    teams = t.supplier.where(F.col("s_suppkey") % 2 == 0).select(F.col("s_name").alias("rep_name"), F.lit("inside").alias("team"))
    stages = t.orders.where(F.col("o_orderstatus") == "F").select(F.col("o_orderstatus").alias("stage_id"), F.lit("Closed/Won").alias("label")).distinct()
    return feeds.deal_snapshot(deals, owners, teams, stages, AS_OF).select(
        "deal_id", "stage", "rep_name", "team", "amount", "is_true_won", "days_in_pipeline"
    )


@query(
    "activity_snapshot",
    """
    WITH w AS (SELECT * FROM (VALUES ('week', TIMESTAMP '2024-01-29'), ('month', TIMESTAMP '2024-01-01'), ('year', TIMESTAMP '2024-01-01')) v("window", s)),
    e AS (SELECT date_trunc('second', ts) AS ts, event_type, s_name FROM events JOIN supplier ON user_id = s_suppkey WHERE event_id % 9 <> 0),
    reps AS (SELECT s_name AS rep_name FROM supplier WHERE s_suppkey % 2 = 0 UNION SELECT s_name FROM e WHERE event_type IN ('click', 'view'))
    SELECT rep_name, "window", CASE WHEN CAST(right(rep_name, 9) AS INT) % 2 = 0 THEN 'inside' ELSE 'unknown' END AS team,
      (SELECT count(*) FROM e WHERE s_name = rep_name AND e.ts >= s AND event_type = 'click') AS call_count,
      (SELECT count(*) FROM e WHERE s_name = rep_name AND e.ts >= s AND event_type = 'view') AS email_count
    FROM w CROSS JOIN reps
    """,
)
def activity_snapshot(t: Tables) -> DataFrame:
    stamp = F.when(F.col("event_id") % 9 != 0, F.date_format("ts", UTC))
    bags = t.events.select(
        "event_type", F.struct(stamp.alias("timestamp"), F.col("user_id").cast("string").alias("owner_id")).alias("properties")
    )
    owners = t.supplier.select(F.col("s_suppkey").cast("string").alias("owner_id"), F.col("s_name").alias("rep_name"))
    teams = t.supplier.where(F.col("s_suppkey") % 2 == 0).select(F.col("s_name").alias("rep_name"), F.lit("inside").alias("team"))
    kinds = {"call": "click", "email": "view"}
    activities = {kind: bags.where(F.col("event_type") == event) for kind, event in kinds.items()}
    return feeds.activity_snapshot(activities, owners, teams, datetime(2024, 1, 31)).select(
        "rep_name", "window", "team", "call_count", "email_count"
    )


@query(
    "property_catalogue",
    "SELECT 'part' AS object_type, p_name AS name, count(*) AS n FROM part GROUP BY ALL UNION ALL SELECT 'customer', c_mktsegment, count(*) FROM customer GROUP BY ALL",
)
def property_catalogue(t: Tables) -> DataFrame:
    def definitions(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[F.col(name).cast("string").alias(f) if f == "name" else F.lit("x").alias(f) for f in feeds.PROPERTY_FIELDS])

    both = feeds.property_catalogue({"part": definitions(t.part, "p_name"), "customer": definitions(t.customer, "c_mktsegment")})
    return both.groupBy("object_type", "name").agg(F.count(F.lit(1)).alias("n"))
