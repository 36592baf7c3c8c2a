"""Whole documents in long form, compared leaf by leaf, and the send flows that end in them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from opsflow.catalog.base import Tables, query
from opsflow.catalog.datasets import erp
from opsflow.catalog.documents import AS_OF_TEXT, LINE_ORDER, order_detail
from opsflow.catalog.order_twins import TWINS
from opsflow.functions import text
from opsflow.operators import longform
from opsflow.operators.joins import Lookup, enrich
from opsflow.plans import orders, sending
from opsflow.session import settle


def leaves(source: str, keys: str, path: str, at: str, values: Mapping[str, str]) -> str:
    """SQL: one row per leaf of the nodes in ``source``."""
    names = ", ".join(f"'{n}'" for n in values)
    texts = ", ".join(f"CAST({v} AS VARCHAR)" for v in values.values())
    return f"SELECT {keys}, '{path}' AS path, {at} AS at, unnest([{names}]) AS name, unnest([{texts}]) AS value FROM {source}"


@query(
    "collect_nodes",
    "WITH c AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) AS k FROM conversations) "
    + leaves("c", "conv_id", "lines", "CAST(k AS VARCHAR)", {"turn": "turn", "role": "role", "text": "text"}),
)
def collect_nodes(t: Tables) -> DataFrame:
    """Conversations with their turns, whole texts included."""
    rows = t.conversations.withColumn("_tie", F.xxhash64("text"))
    turns = longform.Level("lines", rows, ["conv_id"], ["turn", "role", "_tie"], {c: F.col(c) for c in ("turn", "role", "text")})
    return longform.leaves_of(longform.document_nodes(t.conversations.select("conv_id").distinct(), ["conv_id"], {}, [turns]), ["conv_id"])


ORDER_CTE = """
    WITH d AS (SELECT l_orderkey AS o, l_linenumber AS n, l_partkey AS i, CAST(l_quantity AS BIGINT) AS q, l_suppkey % 3 AS w,
                 l_linestatus = 'F' AS gone, CAST(l_orderkey AS VARCHAR) || 'S' || CAST(l_linenumber % 2 AS VARCHAR) AS s,
                 CAST(l_shipdate AS DATE) AS sd, l_shipdate AS tc, l_suppkey AS t FROM lineitem),
    lines AS (SELECT *, row_number() OVER (PARTITION BY o ORDER BY n, i, q, w) AS a FROM (SELECT DISTINCT o, n, i, q, w FROM d)),
    ships AS (SELECT *, row_number() OVER (PARTITION BY o, n ORDER BY s NULLS FIRST, sd, q) AS b
              FROM (SELECT DISTINCT o, n, CASE WHEN gone THEN s END AS s, CASE WHEN gone THEN n END AS sl, CASE WHEN gone THEN sd END AS sd,
                           CASE WHEN gone THEN 'Completed' END AS st, CASE WHEN gone THEN q END AS q FROM d)),
    packs AS (SELECT *, row_number() OVER (PARTITION BY o, s ORDER BY t, tc) AS c FROM (SELECT DISTINCT o, s, t, tc FROM d WHERE gone)),
    line_ships AS (SELECT l.a, ships.* FROM lines l JOIN ships ON l.o = ships.o AND l.n = ships.n),
    ship_packs AS (SELECT ls.o, ls.a, ls.b, p.c, p.t, p.tc FROM line_ships ls JOIN packs p ON ls.o = p.o AND ls.s = p.s)
"""
ORDER_LEAVES = " UNION ALL ".join(
    [
        leaves("orders", "o_orderkey AS order_nbr", "$", "''", {"status": "o_orderstatus"}),
        leaves("lines", "o AS order_nbr", "line_items", "CAST(a AS VARCHAR)", {"line_nbr": "n", "inventory_cd": "i", "line_qty": "q", "warehouse": "w"}),
        leaves(
            "line_ships", "o AS order_nbr", "line_items.shipments", "concat_ws('.', a, b)",
            {"shipment_nbr": "s", "ship_line_nbr": "sl", "ship_date": "sd", "ship_status": "st", "ship_line_qty": "q"},
        ),
        leaves("ship_packs", "o AS order_nbr", "line_items.shipments.packages", "concat_ws('.', a, b, c)", {"tracking": "t", "tracking_created": "tc"}),
    ]
)


def order_nodes(t: Tables) -> DataFrame:
    docs = t.orders.select(F.col("o_orderkey").alias("order_nbr"), F.col("o_orderstatus").alias("status"))
    return longform.order_nodes(docs, order_detail(t), {"status": F.col("status")})


@query("order_nodes", ORDER_CTE + ORDER_LEAVES)
def order_nodes_leaves(t: Tables) -> DataFrame:
    """Orders, lines, shipments and packages."""
    return longform.leaves_of(order_nodes(t), ["order_nbr"])


@query(
    "order_pages",
    ORDER_CTE
    + """, nodes AS (SELECT o_orderkey AS o, 0 AS a, 0 AS b, 0 AS c FROM orders UNION ALL SELECT o, a, 0, 0 FROM lines
                     UNION ALL SELECT o, a, b, 0 FROM line_ships UNION ALL SELECT o, a, b, c FROM ship_packs),
    placed AS (SELECT *, row_number() OVER (PARTITION BY o ORDER BY a, b, c) - 1 AS k FROM nodes)
    SELECT o AS order_nbr, k // 7 AS page, count(*) AS n_nodes, CAST(sum((c > 0)::INT) AS BIGINT) AS n_packages,
           min_by(rtrim(replace(concat_ws('.', a, b, c) || '.', '.0', ''), '.'), k) AS first_at
    FROM placed GROUP BY o, k // 7
    """,
)
def order_pages(t: Tables) -> DataFrame:
    """The same documents in pages of seven nodes."""
    cut = longform.pages(order_nodes(t), ["order_nbr"], 7)
    first = F.array_join(F.transform(F.get("nodes", F.lit(0))["at"], lambda n: n.cast("string")), ".")
    return cut.select(
        "order_nbr", "page", F.size("nodes").cast("bigint").alias("n_nodes"),
        F.size(F.filter("nodes", lambda n: n["path"].endswith("packages"))).cast("bigint").alias("n_packages"),
        F.when(first == "", "0").otherwise(first).alias("first_at"),
    )


@query(
    "package_nodes",
    f"""
    WITH m AS (SELECT l_orderkey AS o, 'T' || CAST(l_suppkey % 4 AS VARCHAR) AS t, l_partkey AS i, CAST(l_quantity AS BIGINT) AS q,
                      l_linenumber AS n, l_suppkey AS u FROM lineitem),
    p AS (SELECT o, t, row_number() OVER (PARTITION BY o ORDER BY t) AS a FROM (SELECT DISTINCT o, t FROM m)),
    c AS (SELECT m.*, p.a, row_number() OVER (PARTITION BY m.o, m.t ORDER BY n, i, u) AS b FROM m JOIN p USING (o, t))
    """
    + leaves(
        "p", "o AS shipment_nbr", "packages", "CAST(a AS VARCHAR)",
        {"BoxID": "'DEFAULT BOX'", "TrackingNbr": "t", "Description": f"'Package added via API @ {AS_OF_TEXT}'", "Weight": "0", "UOM": "'LBS'"},
    )
    + " UNION ALL "
    + leaves(
        "c", "o AS shipment_nbr", "packages.contents", "concat_ws('.', a, b)",
        {"InventoryID": "i", "Quantity": "q", "UOM": "'EA'", "ShipmentSplitLineNbr": "n"},
    ),
)
def package_nodes(t: Tables) -> DataFrame:
    matched = t.lineitem.select(
        F.col("l_orderkey").alias("shipment_nbr"), F.concat(F.lit("T"), (F.col("l_suppkey") % 4).cast("string")).alias("tracking"),
        F.col("l_partkey").alias("inventory_cd"), F.col("l_quantity").cast("bigint").alias("qty"),
        F.col("l_linenumber").alias("split_line_nbr"), "l_suppkey",
    )
    nodes = longform.package_nodes(matched, ["split_line_nbr", "inventory_cd", "l_suppkey"], AS_OF_TEXT)
    return longform.leaves_of(nodes, ["shipment_nbr"])


CREATE_CTE = """
    WITH l AS (SELECT l_orderkey AS o, l_partkey % 50 AS item, CAST(l_quantity AS BIGINT) AS qty, l_returnflag AS level, o_orderstatus AS kind,
        o_orderpriority AS ref, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn,
        count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    g AS (SELECT o, any_value(n) AS n, any_value(kind) AS kind, any_value(ref) AS ref, n = 2 AND count(DISTINCT item) = 1 AS merges, sum(qty) AS total,
                 max(CASE WHEN rn = 1 THEN level END) AS first_level, max(CASE WHEN rn = n THEN level END) AS last_level,
                 max(CASE WHEN rn = n - 1 THEN level END) AS prev_level FROM l GROUP BY o, n),
    h AS (SELECT *, CASE WHEN merges THEN first_level WHEN n > 1 AND last_level = 'N' THEN prev_level ELSE last_level END AS method,
                 CASE WHEN kind = 'P' THEN ref END AS reference FROM g),
    k AS (SELECT l.o, l.rn, l.item, CASE WHEN merges THEN total ELSE l.qty END AS qty, method FROM l JOIN h USING (o) WHERE NOT merges OR l.rn = 1)
"""
CREATE_LINES = {"sku": "item", "qty": "qty", "item_ref": "item", "shipVia": "method"}


@query(
    "order_create_nodes",
    CREATE_CTE
    + leaves("h", "o AS shipment_nbr", "$", "''", {"shipping_method": "method", "reference": "reference"})
    + " UNION ALL "
    + leaves("k", "o AS shipment_nbr", "lines", "CAST(rn AS VARCHAR)", CREATE_LINES),
)
def order_create_nodes(t: Tables) -> DataFrame:
    lines = enrich(
        t.lineitem,
        [Lookup(t.orders, {"l_orderkey": "o_orderkey"}, {"order_type": "o_orderstatus", "customer_ref": "o_orderpriority"}, "inner")],
    ).select(
        F.col("l_orderkey").alias("shipment_nbr"), (F.col("l_partkey") % 50).alias("item"), F.col("l_quantity").cast("bigint").alias("qty"),
        F.col("l_returnflag").alias("level"), "order_type", "customer_ref", *LINE_ORDER,
    )
    return longform.leaves_of(longform.order_create_nodes(lines, LINE_ORDER, "N", "P"), ["shipment_nbr"])


@query(
    "xml_chunks",
    """
    WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS k,
                      count(*) OVER (PARTITION BY l_orderkey) AS n
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)
    SELECT l_orderkey AS o_orderkey, 0 AS place, '<NewRMA><Ref>' || CAST(l_orderkey AS VARCHAR) || '</Ref><To><Name>' ||
      replace(left(c_name || ' & co', 20), '&', '&amp;') || '</Name></To><RMALines>' AS xml FROM l WHERE k = 1
    UNION ALL SELECT l_orderkey, k, '<RMALine><Item>' || CAST(l_partkey AS VARCHAR) || '</Item><Qty>' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) ||
      '</Qty></RMALine>' FROM l
    UNION ALL SELECT l_orderkey, n + 1, '</RMALines></NewRMA>' FROM l WHERE k = 1
    """,
)
def xml_chunks(t: Tables) -> DataFrame:
    wide = enrich(
        t.lineitem,
        [
            Lookup(t.orders, {"l_orderkey": "o_orderkey"}, {"_c": "o_custkey"}, "inner"),
            Lookup(t.customer, {"_c": "c_custkey"}, {"_name": "c_name"}, "inner"),
        ],
    ).withColumnRenamed("l_orderkey", "o_orderkey")
    name = text.markup_text(F.concat(F.col("_name"), F.lit(" & co")), 20)
    return longform.xml_chunks(
        wide, "o_orderkey", LINE_ORDER, {"Ref": F.col("o_orderkey"), "To": {"Name": name}},
        {"Item": F.col("l_partkey"), "Qty": F.col("l_quantity").cast("bigint")}, "NewRMA", "RMALine",
    )


# -- ledger of digests ---------------------------------------------------------


@query(
    "changed_orders",
    """
    SELECT o_orderkey AS order_nbr, o_orderstatus AS status FROM orders
    WHERE o_orderstatus = 'P' OR (o_orderstatus = 'O' AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity >= 45))
    """,
)
def changed_orders(t: Tables) -> DataFrame:
    """Orders never sent in their status, or sent with another leaf somewhere; the ledger holds digests."""
    keys = ["order_nbr", "status"]
    now = order_nodes(t).join(t.orders.select(F.col("o_orderkey").alias("order_nbr"), F.col("o_orderstatus").alias("status")), "order_nbr")
    now = settle(now, "nodes")  # read by both digests and by the documents to send
    qty = F.element_at("leaves", "line_qty")
    older = F.when(
        (F.col("status") == "O") & (F.col("path") == "line_items") & (qty.cast("bigint") >= 45),
        F.map_concat(F.map_filter("leaves", lambda k, _: k != "line_qty"), F.create_map(F.lit("line_qty"), F.lit("1"))),
    ).otherwise(F.col("leaves"))
    sent = longform.digests(now.where("status <> 'P'").withColumn("leaves", older), keys)
    nodes, due = sending.unsent_documents(now, keys, sent)
    return nodes.select(*keys).distinct().join(due, keys).select(*keys)


# -- send flows ------------------------------------------------------------------

LEVEL_LINES = f"(SELECT *, row_number() OVER (PARTITION BY shipment_nbr ORDER BY line_nbr, inventory_cd) AS rn, count(*) OVER (PARTITION BY shipment_nbr) AS n FROM ({TWINS['shipments_to_send_with_level']}))"


def level_lines(t: Tables) -> DataFrame:
    return orders.shipments_to_send_with_level(erp(t), "PartnerA", "x@y", ["5", "105", "205"])


def at_partner(lines: DataFrame) -> DataFrame:
    """Landed lookups: the partner has the shipments with a line of 48 or more."""
    return lines.where("qty >= 48").select("shipment_nbr").distinct()


@query(
    "partner_requests",
    f"""
    WITH l AS {LEVEL_LINES}
    SELECT shipment_nbr, min(acct_cd) AS acct_cd, concat(shipment_nbr, ', order.', CASE WHEN max(qty) >= 48 THEN 'search' ELSE 'create' END) AS operation,
           CASE WHEN max(qty) >= 48 THEN 'Already at partner' END AS note
    FROM l GROUP BY shipment_nbr HAVING count(*) FILTER (WHERE coalesce(partner_order_id, '') = '') > 0
    """,
)
def partner_requests(t: Tables) -> DataFrame:
    lines = level_lines(t)
    return sending.partner_requests(lines, at_partner(lines))


@query(
    "partner_orders",
    f"""
    WITH a AS {LEVEL_LINES},
    l AS (SELECT * FROM a WHERE shipment_nbr IN (SELECT shipment_nbr FROM a GROUP BY 1 HAVING max(qty) < 48 AND count(*) FILTER (WHERE coalesce(partner_order_id, '') = '') > 0)),
    g AS (SELECT shipment_nbr, n, n = 2 AND count(DISTINCT inventory_cd) = 1 AND count(inventory_cd) = 2 AS merges, sum(qty) AS total,
                 max(CASE WHEN rn = 1 THEN level END) AS first_level, max(CASE WHEN rn = n THEN level END) AS last_level,
                 max(CASE WHEN rn = n - 1 THEN level END) AS prev_level FROM l GROUP BY shipment_nbr, n),
    h AS (SELECT l.*, merges, total, CASE WHEN merges THEN first_level WHEN l.n > 1 AND last_level = 'cheapest_ALL' THEN prev_level ELSE last_level END AS method
          FROM g JOIN l USING (shipment_nbr) WHERE rn = 1),
    k AS (SELECT l.shipment_nbr, l.rn, l.inventory_cd AS item, CASE WHEN merges THEN total ELSE l.qty END AS qty, method
          FROM l JOIN (SELECT shipment_nbr, merges, total, method FROM h) USING (shipment_nbr) WHERE NOT merges OR l.rn = 1)
    """
    + leaves(
        "h", "shipment_nbr", "$", "''",
        {"shipping_method": "method", "reference": "CASE WHEN orig_order_type = 'RT' THEN orig_order_nbr END",
         **{n: c for n, c in sending.RECEIVER.items() if c != "shipment_nbr"}, "unique_id": "shipment_nbr"},
    )
    + " UNION ALL "
    + leaves("k", "shipment_nbr", "lines", "CAST(rn AS VARCHAR)", CREATE_LINES),
)
def partner_orders(t: Tables) -> DataFrame:
    """Shipments for the second partner: extract, lookup, service level and order document in one."""
    lines = level_lines(t)
    nodes = sending.partner_orders(lines, at_partner(lines), sending.LINE_ORDER, "cheapest_ALL", "RT", "orig_order_nbr")
    return longform.leaves_of(nodes, ["shipment_nbr"])


def escaped(value: str, width: int | None = None) -> str:
    cut = f"left({value}, {width})" if width else f"CAST({value} AS VARCHAR)"
    return f"coalesce(replace(replace(replace({cut}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '')"


def return_xml_sql(source: str, reference: str) -> str:
    """SQL: chunks of the XML text per ``rma_number``."""
    block = {
        "CompanyName": escaped("company_name", 25), "Contact": f"CASE WHEN coalesce(trim(ship_to_name), '') = '' THEN {escaped('company_name', 25)} ELSE {escaped('ship_to_name', 25)} END",
        "ContactEmail": escaped("ship_to_email"), "Address1": escaped("ship_to_line1"), "Address2": escaped("ship_to_line2"),
        "City": escaped("ship_to_city"), "State": escaped("ship_to_state"), "Zip": escaped("ship_to_postal_code"),
        "Phone": escaped("ship_to_phone"), "Country": escaped("ship_to_country"),
    }
    tag = lambda name, value: f"'<{name}>' || {value} || '</{name}>'"
    head = " || ".join(
        [tag("RMANumber", "rma_number"), tag("RMATypeName", "rma_type"), tag("ShipMethod", escaped("ship_via")), tag("CustomerRef", escaped(reference)),
         tag("Customer", tag("ShipTo", " || ".join(tag(n, v) for n, v in block.items())))]
    )
    line = " || ".join(
        [tag("RMALineNumber", "CAST(line_nbr AS VARCHAR)"), tag("ItemNumber", escaped("inventory_cd")), tag("Quantity", "coalesce(CAST(qty AS VARCHAR), '')"),
         tag("Location", "coalesce(location, '')"), tag("Description", escaped("item_descr"))]
    )
    return f"""
    WITH l AS (SELECT *, row_number() OVER (PARTITION BY rma_number ORDER BY line_nbr, inventory_cd) AS k, count(*) OVER (PARTITION BY rma_number) AS n
               FROM ({source}))
    SELECT rma_number, 0 AS place, '<NewRMA>' || {head} || '<RMALines>' AS xml FROM l WHERE k = 1
    UNION ALL SELECT rma_number, k, '<RMALine>' || {line} || '</RMALine>' FROM l
    UNION ALL SELECT rma_number, n + 1, '</RMALines></NewRMA>' FROM l WHERE k = 1
    """


@query("returns_to_send_xml", return_xml_sql(TWINS["returns_to_send"], "original_order_nbr"))
def returns_to_send_xml(t: Tables) -> DataFrame:
    """Returns for the first partner, as whole XML texts in chunks."""
    return sending.return_xml(orders.returns_to_send(erp(t), "PB", "x@y", ["55"], ["77"]), sending.LINE_ORDER, "original_order_nbr")


@query("shipments_to_send_xml", return_xml_sql(TWINS["shipments_to_send"], "order_nbr"))
def shipments_to_send_xml(t: Tables) -> DataFrame:
    return sending.return_xml(orders.shipments_to_send(erp(t), "PB", "x@y", ["77"]), sending.LINE_ORDER, "order_nbr")
