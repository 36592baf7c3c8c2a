"""Flattening and assembling nested records."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from opsflow.catalog.base import LINE_KEY, Tables, flag, query, time_text
from opsflow.functions import nested as nf, text
from opsflow.operators import nested, windows
from opsflow.operators.joins import Lookup, enrich

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey"]
AS_OF_TEXT = "01/31/2024 00:00:00"


def turns(t: Tables) -> DataFrame:
    """Conversations as header records with an array of turns."""
    return nested.collect_parts(
        t.conversations, ["conv_id"], ["turn", "role", "text"], F.struct("turn", "role", "text"), "lines"
    )


@query(
    "collect_rows",
    """
    SELECT conv_id, 0 AS piece, 0 AS part, count(*) AS n_lines, min(turn) AS first_turn, max(turn) AS last_turn,
           string_agg(role, '|' ORDER BY turn) AS roles
    FROM conversations GROUP BY conv_id
    """,
)
def collect_rows(t: Tables) -> DataFrame:
    return turns(t).select(
        "conv_id", "piece", "part",
        F.size("lines").alias("n_lines"),
        F.get("lines", F.lit(0))["turn"].alias("first_turn"),
        F.element_at("lines", -1)["turn"].alias("last_turn"),
        F.array_join("lines.role", "|").alias("roles"),
    )


@query(
    "flatten_lines",
    "SELECT conv_id, turn, role, length(text) AS n_chars FROM conversations",
)
def flatten_lines(t: Tables) -> DataFrame:
    return nested.flatten_lines(
        turns(t), "lines", {"conv_id": F.col("conv_id")}, {"turn": "turn", "role": "role", "text": "text"}
    ).select("conv_id", "turn", "role", F.length("text").alias("n_chars"))


def return_reports(t: Tables) -> DataFrame:
    """Orders as return reports whose line fields depend on the report's type."""
    kinds = enrich(
        t.lineitem,
        [Lookup(t.orders, {"l_orderkey": "o_orderkey"}, {"_s": "o_orderstatus"}, "inner")],
    ).select(
        *LINE_KEY,
        F.when(F.col("_s") == "F", "W").when(F.col("_s") == "O", "3").otherwise("X").alias("kind"),
        "l_returnflag", "l_linestatus", "l_quantity",
    )
    return nested.collect_parts(
        kinds,
        ["l_orderkey"],
        LINE_ORDER,
        F.struct(
            F.col("l_linenumber").alias("nbr"),
            F.col("l_partkey").alias("rpItem"), F.col("l_returnflag").alias("rpStatus"),
            F.col("l_suppkey").alias("dfItem"), F.col("l_linestatus").alias("dfStatus"),
            F.col("l_quantity").cast("bigint").alias("dfModel"),
        ),
        "lines",
        carry=[F.max("kind").alias("kind")],
    )


@query(
    "flatten_variant",
    """
    SELECT l_orderkey AS rma, l_linenumber AS line_nbr,
      CASE o_orderstatus WHEN 'F' THEN l_partkey WHEN 'O' THEN l_suppkey END AS item,
      CASE o_orderstatus WHEN 'F' THEN l_returnflag WHEN 'O' THEN l_linestatus END AS line_status,
      CASE o_orderstatus WHEN 'F' THEN 'in' END AS carrier
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
)
def flatten_variant(t: Tables) -> DataFrame:
    return nested.flatten_variant(
        return_reports(t),
        "lines",
        "kind",
        {"rma": F.col("l_orderkey")},
        {"line_nbr": "nbr"},
        {"item": {"W": "rpItem", "3": "dfItem"}, "line_status": {"W": "rpStatus", "3": "dfStatus"}},
        {"carrier": ("W", F.lit("in"))},
    )


def stock_reports(t: Tables) -> DataFrame:
    """Parts with their stock per carrier as text quantities."""
    return nested.collect_parts(
        t.lineitem.select(*LINE_KEY, "l_quantity"),
        ["l_partkey"],
        ["l_orderkey", "l_linenumber", "l_suppkey"],
        F.struct(
            (F.col("l_suppkey") % 10).cast("string").alias("warehouse_id"),
            F.format_string("%d.5000", F.col("l_quantity").cast("bigint")).alias("qty_on_hand"),
        ),
        "detailed",
        carry=[F.concat(F.sum(F.col("l_quantity").cast("bigint")).cast("string"), F.lit(".0000")).alias("qty_on_hand")],
    ).withColumnRenamed("l_partkey", "sku")


@query(
    "inventory_detail",
    """
    SELECT l_partkey AS item, CASE l_suppkey % 10 WHEN 6 THEN 'WEST' WHEN 7 THEN 'EAST' ELSE 'Unknown' END AS warehouse,
           CAST(l_quantity AS BIGINT) AS on_hand
    FROM lineitem
    """,
)
def inventory_detail(t: Tables) -> DataFrame:
    return inventory(t)[1]


@query(
    "inventory_summary",
    "SELECT l_partkey AS item, CAST(sum(l_quantity) AS BIGINT) AS on_hand FROM lineitem GROUP BY 1",
)
def inventory_summary(t: Tables) -> DataFrame:
    return inventory(t)[0]


def inventory(t: Tables) -> tuple[DataFrame, DataFrame]:
    summary, detail = nested.inventory_levels(
        stock_reports(t), "sku", {"on_hand": "qty_on_hand"}, "detailed", "warehouse_id",
        {"6": "WEST", "7": "EAST"},
    )
    # a large group has a report per part
    return summary.groupBy("item").agg(F.sum("on_hand").alias("on_hand")), detail


@query(
    "header_detail",
    """
    SELECT conv_id, 'head' AS kind, count(*) AS n FROM conversations GROUP BY conv_id
    UNION ALL SELECT conv_id, role AS kind, count(*) AS n FROM conversations GROUP BY conv_id, role
    """,
)
def header_detail(t: Tables) -> DataFrame:
    heads, lines = nested.header_detail(
        turns(t), "lines",
        {"conv_id": F.col("conv_id"), "n": F.size("lines").cast("bigint")},
        {"conv_id": F.col("conv_id")},
        {"role": "role"},
    )
    by_role = lines.groupBy("conv_id", F.col("role").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    whole = heads.groupBy("conv_id").agg(F.sum("n").alias("n"))  # a large group has a head per part
    return whole.withColumn("kind", F.lit("head")).unionByName(by_role)


def packed_events(t: Tables) -> DataFrame:
    """Orders as packed-event JSON. Every tenth has no tracking numbers, every
    third one for all items, the others one per item."""
    order = F.col("l_orderkey")
    lines = windows.with_sequence(t.lineitem.select(*LINE_KEY, "l_quantity"), ["l_orderkey"], LINE_ORDER, "rn")
    tracking = F.concat(F.lit("T"), order.cast("string"), F.lit("-"), F.col("rn").cast("string"))
    docs = nested.collect_parts(
        lines.withColumn("tracking", tracking),
        ["l_orderkey"],
        LINE_ORDER,
        F.struct(
            F.struct(
                F.col("l_partkey").cast("string").alias("sku"),
                F.col("l_quantity").cast("int").alias("quantity"),
                F.col("l_linenumber").alias("order_item_qty"),
            ).alias("item"),
            "tracking",
        ),
        "rows",
        basis=t.lineitem,
    )
    trackings = (
        F.when(order % 10 == 0, F.slice("rows.tracking", 1, 0))
        .when(order % 3 == 0, F.slice("rows.tracking", 1, 1))
        .otherwise(F.col("rows.tracking"))
    )
    package = F.struct(
        F.concat(F.lit("C"), (order % 5).cast("string")).alias("manifest_courier"),
        F.col("rows.item").alias("items"),
        trackings.alias("tracking_numbers"),
    )
    topic = F.when(order % 7 == 0, "shipment:created").otherwise("shipment:packed")
    return docs.select(
        F.to_json(
            F.struct(
                topic.alias("topic"),
                F.struct(order.cast("string").alias("order_unique_id"), F.array(package).alias("packages")).alias("message"),
            )
        ).alias("jsonData")
    )


@query(
    "expand_packed_events",
    """
    WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem)
    SELECT CAST(l_orderkey AS VARCHAR) AS shipment_nbr, CAST(l_partkey AS VARCHAR) AS inventory_cd,
           'T' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE rn END AS VARCHAR) AS tracking,
           CAST(l_quantity AS BIGINT) AS qty, 'C' || CAST(l_orderkey % 5 AS VARCHAR) AS courier, l_linenumber AS order_item_qty
    FROM l WHERE l_orderkey % 10 <> 0 AND l_orderkey % 7 <> 0
    """,
)
def expand_packed_events(t: Tables) -> DataFrame:
    return nested.expand_packed_events(packed_events(t), "jsonData")


def order_detail(t: Tables) -> DataFrame:
    """Lines as order detail: shipped ones have a shipment and a tracking number."""
    order = F.col("l_orderkey")
    shipped = F.col("l_linestatus") == "F"
    return t.lineitem.select(
        order.alias("order_nbr"),
        F.col("l_linenumber").alias("line_nbr"),
        F.col("l_partkey").alias("inventory_cd"),
        F.col("l_quantity").cast("bigint").alias("line_qty"),
        (F.col("l_suppkey") % 3).alias("warehouse"),
        F.when(shipped, F.concat(order.cast("string"), F.lit("S"), (F.col("l_linenumber") % 2).cast("string"))).alias("shipment_nbr"),
        F.when(shipped, F.col("l_linenumber")).alias("ship_line_nbr"),
        F.when(shipped, F.col("l_shipdate").cast("date")).alias("ship_date"),
        F.when(shipped, F.lit("Completed")).alias("ship_status"),
        F.when(shipped, F.col("l_quantity").cast("bigint")).alias("ship_line_qty"),
        F.when(shipped, F.col("l_suppkey")).alias("tracking"),
        F.when(shipped, F.col("l_shipdate")).alias("tracking_created"),
    )


@query(
    "nest_orders",
    """
    WITH d AS (SELECT l_orderkey AS o, l_linenumber AS n, l_partkey AS i, CAST(l_quantity AS BIGINT) AS q, l_suppkey % 3 AS w,
                 CASE WHEN l_linestatus = 'F' THEN CAST(l_orderkey AS VARCHAR) || 'S' || CAST(l_linenumber % 2 AS VARCHAR) END AS s,
                 CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS sd,
                 CASE WHEN l_linestatus = 'F' THEN l_suppkey END AS t FROM lineitem),
    lines AS (SELECT DISTINCT o, n, i, q, w FROM d),
    ships AS (SELECT DISTINCT o, n, s, sd, CASE WHEN s IS NOT NULL THEN q END AS q FROM d),
    packs AS (SELECT o, s, count(*) AS k FROM (SELECT DISTINCT o, s, t, sd FROM d WHERE s IS NOT NULL) GROUP BY o, s),
    per_line AS (SELECT o, n, count(*) AS ships, sum(coalesce(k, 0)) AS packs FROM ships LEFT JOIN packs USING (o, s) GROUP BY o, n)
    SELECT o_orderkey AS order_nbr, o_orderstatus AS status, 0 AS piece, 0 AS part, count(lines.o) AS n_lines,
           CAST(coalesce(sum(ships), 0) AS BIGINT) AS n_shipments, CAST(coalesce(sum(packs), 0) AS BIGINT) AS n_packages,
           CAST(coalesce(sum(lines.q), 0) AS BIGINT) AS qty
    FROM orders LEFT JOIN lines ON o_orderkey = lines.o LEFT JOIN per_line ON lines.o = per_line.o AND lines.n = per_line.n
    GROUP BY o_orderkey, o_orderstatus
    """,
)
def nest_orders(t: Tables) -> DataFrame:
    orders = t.orders.select(F.col("o_orderkey").alias("order_nbr"), F.col("o_orderstatus").alias("status"))
    docs = nested.nest_orders(orders, order_detail(t))
    zero = F.lit(0).cast("bigint")
    return docs.select(
        "order_nbr", "status", "piece", "part",
        F.size("line_items").alias("n_lines"),
        F.aggregate("line_items", zero, lambda n, l: n + F.size(l["shipments"])).alias("n_shipments"),
        F.aggregate(
            F.flatten("line_items.shipments"), zero, lambda n, s: n + F.size(s["packages"])
        ).alias("n_packages"),
        F.aggregate("line_items", zero, lambda n, l: n + l["line_qty"]).alias("qty"),
    )


@query(
    "package_documents",
    """
    WITH m AS (SELECT l_orderkey, 'T' || CAST(l_suppkey % 4 AS VARCHAR) AS tracking, CAST(l_quantity AS BIGINT) AS qty FROM lineitem)
    SELECT l_orderkey AS shipment_nbr, 0 AS piece, 0 AS part, count(DISTINCT tracking) AS n_packages,
           count(*) AS n_contents, CAST(sum(qty) AS BIGINT) AS qty, min(tracking) AS first_tracking, max(tracking) AS last_tracking
    FROM m GROUP BY l_orderkey
    """,
)
def package_documents(t: Tables) -> DataFrame:
    matched = t.lineitem.select(
        F.col("l_orderkey").alias("shipment_nbr"),
        F.concat(F.lit("T"), (F.col("l_suppkey") % 4).cast("string")).alias("tracking"),
        F.col("l_partkey").alias("inventory_cd"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.col("l_linenumber").alias("split_line_nbr"),
        "l_suppkey",
    )
    docs = nested.package_documents(matched, ["split_line_nbr", "inventory_cd", "l_suppkey"], AS_OF_TEXT)
    contents = F.flatten("packages.PackageContents")
    return docs.select(
        "shipment_nbr", "piece", "part",
        F.size("packages").alias("n_packages"),
        F.size(contents).alias("n_contents"),
        F.aggregate(contents, F.lit(0).cast("bigint"), lambda n, c: n + c["Quantity"]["value"]).alias("qty"),
        F.get("packages", F.lit(0))["TrackingNbr"]["value"].alias("first_tracking"),
        F.element_at("packages", -1)["TrackingNbr"]["value"].alias("last_tracking"),
    )


@query(
    "return_package_documents",
    """
    SELECT l_orderkey AS shipment_nbr, count(*) AS n_contents,
      CASE WHEN l_orderkey % 3 = 0 THEN 'E' || CAST(l_orderkey AS VARCHAR)
           WHEN l_orderkey % 3 = 1 THEN 'T' || CAST(l_orderkey AS VARCHAR)
           ELSE 'No ExtRefNbr for tracking' END AS tracking
    FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey
    """,
)
def return_package_documents(t: Tables) -> DataFrame:
    key = F.col("l_orderkey")
    lines = t.lineitem.where(F.col("l_returnflag") == "R").select(
        key.alias("shipment_nbr"),
        F.when(key % 3 == 0, F.concat(F.lit("E"), key.cast("string"))).otherwise(F.lit("")).alias("ext_ref"),
        F.when(key % 3 == 1, F.concat(F.lit("T"), key.cast("string"))).alias("tracking"),
        F.col("l_partkey").alias("inventory_cd"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.col("l_linenumber").alias("split_line_nbr"),
        "l_suppkey",
    )
    docs = nested.return_package_documents(lines, ["split_line_nbr", "inventory_cd", "l_suppkey"], AS_OF_TEXT)
    first = F.get("packages", F.lit(0))
    return docs.select(
        "shipment_nbr",
        F.size(first["PackageContents"]).alias("n_contents"),
        first["TrackingNbr"]["value"].alias("tracking"),
    )


@query(
    "order_documents",
    """
    WITH l AS (SELECT l_orderkey, l_partkey % 50 AS item, CAST(l_quantity AS BIGINT) AS qty, l_returnflag AS level,
        row_number() OVER w AS rn, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS back,
        count(*) OVER (PARTITION BY l_orderkey) AS n
      FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey)),
    g AS (SELECT l_orderkey, max(n) AS n, count(DISTINCT item) AS items, CAST(sum(qty) AS BIGINT) AS qty,
                 max(CASE WHEN rn = 1 THEN level END) AS first_level,
                 max(CASE WHEN back = 1 THEN level END) AS last_level, max(CASE WHEN back = 2 THEN level END) AS prev_level,
                 string_agg(CAST(item AS VARCHAR), ',' ORDER BY rn) AS skus
          FROM l GROUP BY l_orderkey)
    SELECT l_orderkey AS shipment_nbr,
      CASE WHEN n = 2 AND items = 1 THEN first_level
           WHEN n > 1 AND last_level = 'N' THEN prev_level ELSE last_level END AS shipping_method,
      CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS reference,
      CASE WHEN n = 2 AND items = 1 THEN 1 ELSE n END AS n_lines, qty,
      CASE WHEN n = 2 AND items = 1 THEN split_part(skus, ',', 1) ELSE skus END AS skus
    FROM g JOIN orders ON l_orderkey = o_orderkey
    """,
)
def order_documents(t: Tables) -> DataFrame:
    lines = enrich(
        t.lineitem,
        [Lookup(t.orders, {"l_orderkey": "o_orderkey"},
                {"order_type": "o_orderstatus", "customer_ref": "o_orderpriority"}, "inner")],
    ).select(
        F.col("l_orderkey").alias("shipment_nbr"), (F.col("l_partkey") % 50).alias("item"),
        F.col("l_quantity").cast("bigint").alias("qty"), F.col("l_returnflag").alias("level"),
        "order_type", "customer_ref", *LINE_ORDER,
    )
    docs = nested.order_documents(lines, LINE_ORDER, "N", "P")
    return docs.select(
        "shipment_nbr", "shipping_method", "reference",
        F.size("lines").alias("n_lines"),
        F.aggregate("lines", F.lit(0).cast("bigint"), lambda n, l: n + l["qty"]).alias("qty"),
        F.array_join(F.transform("lines", lambda l: l["sku"].cast("string")), ",").alias("skus"),
    )


STATES = {"AMERICA": "America", "ASIA": "Asia", "EUROPE": "Europe"}


@query(
    "tracking_documents",
    """
    SELECT o_orderkey AS order_number, CASE WHEN n_name = 'NATION_1' THEN 'USA' ELSE n_name END AS country,
      CASE r_name WHEN 'AMERICA' THEN 'America' WHEN 'ASIA' THEN 'Asia' WHEN 'EUROPE' THEN 'Europe' END AS state,
      c_mktsegment || ' ' || CAST(o_custkey AS VARCHAR) AS place, strftime(o_orderdate, '%Y-%m-%d') AS day,
      c_mktsegment AS first_name, c_name AS last_name, 'a' || CAST(c_custkey AS VARCHAR) AS email,
      array_to_string(list_sort(list_distinct([c_mktsegment, o_orderpriority])), '|') AS tags
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    """,
)
def tracking_documents(t: Tables) -> DataFrame:
    wide = enrich(
        t.orders,
        [
            Lookup(t.customer, {"o_custkey": "c_custkey"}, {"_n": "c_nationkey", "_name": "c_name", "_seg": "c_mktsegment"}, "inner"),
            Lookup(t.nation, {"_n": "n_nationkey"}, {"_nation": "n_name", "_r": "n_regionkey"}, "inner"),
            Lookup(t.region, {"_r": "r_regionkey"}, {"_region": "r_name"}, "inner"),
        ],
    )
    country = F.when(F.col("_nation") == "NATION_1", "US").otherwise(F.col("_nation"))
    customer = F.concat_ws(" ", "_seg", "_name")
    rows = wide.select(
        F.col("o_orderkey").alias("tracking"), F.lit("fedex").alias("slug"), F.col("o_orderkey").alias("shipment_nbr"),
        customer.alias("customer"), country.alias("origin_country"), F.col("_region").alias("origin_state"),
        F.col("_seg").alias("origin_line1"), F.lit(None).cast("string").alias("origin_line2"),
        country.alias("dest_country"), F.col("_region").alias("dest_state"), F.col("_seg").alias("dest_line1"),
        F.col("o_custkey").cast("string").alias("dest_line2"), F.col("o_orderkey").alias("order_nbr"),
        F.col("o_orderdate").alias("order_date"), F.lit("p").alias("product_title"),
        F.concat(F.lit("a"), F.col("o_custkey").cast("string"), F.lit(";b")).alias("email"),
        F.lit("+1").alias("phone_number"), F.col("_seg").alias("customer_class"),
        F.col("o_orderpriority").alias("item_class"), F.lit(None).cast("string").alias("package_value"),
    )
    docs = nested.tracking_documents(rows, STATES)
    return docs.select(
        "order_number",
        F.col("destination_country_iso3").alias("country"),
        F.col("destination_state").alias("state"),
        F.col("destination_raw_location").alias("place"),
        F.left("order_date", F.lit(10)).alias("day"),
        F.col("custom_fields.first_name"), F.col("custom_fields.last_name"),
        F.get("customers", F.lit(0))["email"].alias("email"),
        F.array_join("shipment_tags", "|").alias("tags"),
    )


@query(
    "address_documents",
    """
    SELECT c_custkey AS order_nbr, n_name AS ship_city,
      CASE WHEN c_custkey % 3 = 0 THEN n_name WHEN c_custkey % 3 = 1 THEN c_mktsegment END AS bill_city
    FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0
    """,
)
def address_documents(t: Tables) -> DataFrame:
    third = F.col("c_custkey") % 3
    wide = enrich(t.customer, [Lookup(t.nation, {"c_nationkey": "n_nationkey"}, {"_n": "n_name"}, "inner")])
    blocks = {}
    for prefix, city, present in (("vs_", "_n", F.col("c_acctbal") > 0), ("vb_", "c_mktsegment", third == 1)):
        for name in nested.ADDRESS_FIELDS:
            blocks[prefix + name] = F.when(present, F.col(city))
    docs = nested.address_documents(
        wide.withColumns(blocks).select(
            F.lit("SO").alias("order_type"), F.col("c_custkey").alias("order_nbr"), F.col("c_name").alias("customer"),
            F.when(third == 0, 1).otherwise(0).alias("match"), *blocks,
        )
    )
    return docs.select(
        F.col("OrderNbr.value").alias("order_nbr"),
        F.col("ShipToAddress.city.value").alias("ship_city"),
        F.col("BillToAddress.city.value").alias("bill_city"),
    )


@query(
    "render_xml",
    """
    SELECT o_orderkey, '<NewRMA><Ref>' || CAST(o_orderkey AS VARCHAR) || '</Ref><To>' ||
      replace(left(c_name || ' & co', 20), '&', '&amp;') || '</To><RMALines>' ||
      string_agg('<RMALine><Item>' || CAST(l_partkey AS VARCHAR) || '</Item><Qty>' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) ||
                 '</Qty></RMALine>', '' ORDER BY l_linenumber, l_partkey, l_suppkey) || '</RMALines></NewRMA>' AS xml
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    GROUP BY o_orderkey, c_name
    """,
)
def render_xml(t: Tables) -> DataFrame:
    wide = enrich(
        t.lineitem,
        [
            Lookup(t.orders, {"l_orderkey": "o_orderkey"}, {"_c": "o_custkey"}, "inner"),
            Lookup(t.customer, {"_c": "c_custkey"}, {"_name": "c_name"}, "inner"),
        ],
    ).withColumnRenamed("l_orderkey", "o_orderkey")
    name = text.markup_text(F.concat(F.col("_name"), F.lit(" & co")), 20)
    return nested.render_xml(
        wide, "o_orderkey", LINE_ORDER,
        {"Ref": F.col("o_orderkey"), "To": name},
        {"Item": F.col("l_partkey"), "Qty": F.col("l_quantity").cast("bigint")},
        "NewRMA", "RMALine",
    ).select("o_orderkey", "xml")


@query(
    "classify_replies",
    """
    SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '200 Done: R' || CAST(o_orderkey AS VARCHAR) || ' posted successfully!'
        WHEN 1 THEN '200 ERROR: RMA already exists' WHEN 2 THEN '200 ERROR: Item does not exist'
        ELSE '500 ERROR: Error parsing response' END AS reply,
      CASE WHEN o_orderkey % 4 IN (2, 3) THEN 1 ELSE 0 END AS failed
    FROM orders
    """,
)
def classify_replies(t: Tables) -> DataFrame:
    kind = F.col("o_orderkey") % 4
    number = F.concat(F.lit("<RMANumber>R"), F.col("o_orderkey").cast("string"), F.lit("</RMANumber>"))
    inner = (
        F.when(kind == 0, F.concat(number, F.lit("<Message>Done</Message>")))
        .when(kind == 1, F.lit("<Message>RMA already exists</Message>"))
        .when(kind == 2, F.lit("<Message>Item does not exist</Message>"))
    )
    body = F.when(kind < 3, F.concat(F.lit("<r><CreateNewResult>"), inner, F.lit("</CreateNewResult></r>"))).otherwise(F.lit("oops"))
    replies = t.orders.select(
        "o_orderkey", F.when(kind == 3, 500).otherwise(200).alias("status_code"), body.alias("body")
    )
    return nested.classify_replies(replies).select("o_orderkey", "reply", flag(F.col("failed")).alias("failed"))


@query(
    "flatten_properties",
    """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS amount,
      CASE WHEN CAST(json_extract_string(props, '$.k') AS INT) >= 90 THEN 1 ELSE 0 END AS is_won,
      coalesce(c_name, 'no matching owner') AS rep_name
    FROM events LEFT JOIN customer ON user_id = c_custkey AND c_acctbal > 3000
    """,
)
def flatten_properties(t: Tables) -> DataFrame:
    bags = t.events.select(
        "event_id", "user_id", F.from_json("props", "map<string,string>").alias("properties")
    )
    flat = nested.flatten_properties(
        bags,
        "properties",
        {
            "amount": ("k", F.col("_p_amount").try_cast("double")),
            "is_won": ("k", F.when(F.col("_p_is_won").try_cast("int") >= 90, 1).otherwise(0)),
        },
    )
    owners = t.customer.where(F.col("c_acctbal") > 3000)
    named = enrich(flat, [Lookup(owners, {"user_id": "c_custkey"}, {"rep_name": "c_name"})])
    return named.fillna("no matching owner", subset=["rep_name"]).select("event_id", "amount", "is_won", "rep_name")


@query(
    "flatten_shipment_reply",
    """
    SELECT l_orderkey AS shipment_nbr, l_linenumber AS line_nbr, l_partkey AS inventory_cd, l_quantity AS qty,
           CASE WHEN l_suppkey % 5 > 0 THEN l_suppkey END AS split_line_nbr,
           count(*) OVER (PARTITION BY l_orderkey) AS line_count
    FROM lineitem
    """,
)
def flatten_shipment_reply(t: Tables) -> DataFrame:
    split = nf.wrap(SplitLineNbr=F.col("l_suppkey"))
    lines = t.lineitem.select(
        *LINE_KEY, "l_quantity", F.filter(F.array(split), lambda a: a["SplitLineNbr"]["value"] % 5 > 0).alias("allocations")
    )
    docs = nested.collect_parts(
        lines, ["l_orderkey"], LINE_ORDER,
        F.struct(
            nf.wrapped(F.col("l_linenumber")).alias("LineNbr"), nf.wrapped(F.col("l_partkey")).alias("InventoryID"),
            nf.wrapped(F.col("l_quantity")).alias("ShippedQty"), F.col("allocations").alias("Allocations"),
        ),
        "Details",
    ).select(
        nf.wrapped(F.col("l_orderkey")).alias("ShipmentNbr"), nf.wrapped(F.lit("Open")).alias("Status"),
        nf.wrapped(F.lit(1)).alias("PackageCount"), "Details",
    )
    # a large group has a reply per part
    flat = nested.flatten_shipment_reply(docs).drop("line_count")
    return windows.with_group_total(flat, ["shipment_nbr"], {"line_count": F.count(F.lit(1))}).select(
        "shipment_nbr", "line_nbr", "inventory_cd", "qty", "split_line_nbr", "line_count"
    )


@query(
    "attribute_documents",
    """
    SELECT o_orderkey AS shipment_nbr, l_suppkey AS order_id, 'link/' || CAST(l_suppkey AS VARCHAR) AS link, l_returnflag AS courier
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus = 'P'
    """,
)
def attribute_documents(t: Tables) -> DataFrame:
    sent = t.orders.where(F.col("o_orderstatus") == "P").select(F.col("o_orderkey").alias("shipment_nbr"))
    replies = t.lineitem.select(
        F.col("l_orderkey").alias("shipment_nbr"), F.col("l_suppkey").alias("order_id"),
        F.col("l_returnflag").alias("shipping_description"), F.col("l_linestatus").alias("shipping_method"),
    )
    docs = nested.attribute_documents(sent, replies, "link/", F.lit(datetime(2024, 1, 31)))
    a = F.col("attributes")
    return docs.select(
        "shipment_nbr",
        a["order_id"]["value"].alias("order_id"), a["link"]["value"].alias("link"), a["courier_code"]["value"].alias("courier"),
    )


@query(
    "ledger_rows",
    """
    SELECT CASE WHEN l_suppkey % 2 = 0 THEN CAST(l_suppkey AS VARCHAR) ELSE CAST(o_custkey AS VARCHAR) END AS order_nbr,
           CAST(l_linenumber AS VARCHAR) AS response_code, l_returnflag AS message, l_partkey AS id
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    """,
)
def ledger_rows(t: Tables) -> DataFrame:
    requests = t.orders.select(F.col("o_orderkey").alias("request"), F.col("o_custkey").cast("string").alias("order_nbr"))
    number = F.when(F.col("l_suppkey") % 2 == 0, F.col("l_suppkey").cast("string")).when(F.col("l_suppkey") % 3 == 0, F.lit(""))
    replies = t.lineitem.select(
        F.col("l_orderkey").alias("request"), number.alias("order_nbr"), F.col("l_linenumber").alias("code"),
        F.col("l_returnflag").alias("message"), F.col("l_partkey").alias("id"),
    )
    return nested.ledger_rows(requests, replies, "request", ["order_nbr"], F.lit(datetime(2024, 1, 31))).drop("ts")


@query(
    "current_shipment",
    """
    WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, count(*) OVER (PARTITION BY l_orderkey) AS n,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY (l_shipdate < TIMESTAMP '1999-01-01'), l_linenumber, l_partkey, l_suppkey) AS pick
      FROM lineitem)
    SELECT o_orderkey AS order_nbr, CASE WHEN n = 1 OR l_shipdate >= TIMESTAMP '1999-01-01' THEN l_partkey END AS shipment_nbr,
           CASE WHEN n = 1 OR l_shipdate >= TIMESTAMP '1999-01-01' THEN o_custkey END AS customer_id
    FROM orders LEFT JOIN s ON o_orderkey = l_orderkey AND pick = 1
    """,
)
def current_shipment(t: Tables) -> DataFrame:
    since = F.lit(datetime(1999, 1, 1)).cast("timestamp_ntz")
    line = F.struct(*LINE_ORDER, F.col("l_shipdate").alias("modified_at"), F.col("l_partkey").alias("shipment_nbr"))
    # the lines that decide, whatever the size of the group: the first one and the first recent one
    lines = t.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.min(line).alias("first"), F.min(F.when(F.col("l_shipdate") >= since, line)).alias("recent")
    )
    several = F.array("first", F.coalesce("recent", "first"))
    shipments = lines.select("l_orderkey", F.when(F.col("n") > 1, several).otherwise(F.array("first")).alias("shipments"))
    orders = enrich(t.orders, [Lookup(shipments, {"o_orderkey": "l_orderkey"}, {"shipments": "shipments"})]).select(
        F.col("o_orderkey").alias("order_nbr"), F.col("o_orderstatus").alias("order_type"),
        F.col("o_custkey").alias("customer_id"), F.lit("d").alias("description"), F.lit("e").alias("ext_ref"), "shipments",
    )
    return nested.current_shipment(orders, since).select("order_nbr", "shipment_nbr", "customer_id")


def tracking_reports(t: Tables) -> DataFrame:
    """Conversations as tracking reports with checkpoints; every fifth has no phone."""
    stamp = F.concat(F.lit("2026-01-0"), (1 + F.col("conv_id") % 9).cast("string"), F.lit("T12:00:00-05:00"))
    point = F.struct(
        F.concat(F.lit("2026-01-01T0"), (F.col("turn") % 10).cast("string"), F.lit(":00:00+00:00")).alias("checkpoint_time"),
        F.concat(F.lit("2026-01-01T0"), (F.col("turn") % 10).cast("string"), F.lit(":30:00")).alias("created_at"),
        F.col("text").alias("message"), F.col("role").alias("tag"), F.lit("c").alias("city"),
        F.lit("s").alias("state"), F.lit("ups").alias("slug"),
        *[F.lit("x").alias(c) for c in ("subtag", "subtag_message", "postal_code", "raw_tag", "source")],
    )
    points = nested.collect_parts(t.conversations, ["conv_id"], ["turn", "role", "text"], point, "checkpoints")
    key = F.col("conv_id").cast("string")
    phone = F.when(F.col("conv_id") % 5 > 0, F.concat(F.lit("+1"), key))
    return points.select(
        key.alias("id"), key.alias("order_number"), F.when(F.col("conv_id") % 2 == 0, key).alias("order_id"),
        key.alias("tracking_number"), stamp.alias("created_at"), stamp.alias("updated_at"), F.lit("t").alias("tag"),
        F.lit("s").alias("subtag"), F.array(F.struct(phone.alias("phone_number"))).alias("customers"),
        F.struct(F.lit(1.5).alias("value")).alias("shipment_weight"), "checkpoints",
        F.struct(F.lit("p").alias("product_title")).alias("custom_fields"),
        *[
            F.lit("x").alias(c)
            for c in (
                "shipment_type", "courier_tracking_link", "destination_raw_location", "destination_city", "destination_state",
                "destination_postal_code", "subtag_message",
            )
        ],
    )


@query(
    "tracking_export",
    """
    SELECT DISTINCT CAST(conv_id AS VARCHAR) AS id, CASE WHEN conv_id % 2 = 0 THEN CAST(conv_id AS VARCHAR) ELSE '' END AS shipment_nbr,
           '1' || CAST(conv_id AS VARCHAR) AS phone, 1.5 AS weight, '2026-01-0' || CAST(1 + conv_id % 9 AS VARCHAR) || ' 12:00:00' AS created
    FROM conversations WHERE conv_id % 5 > 0
    """,
)
def tracking_export(t: Tables) -> DataFrame:
    heads, _ = nested.tracking_export(tracking_reports(t), "America/New_York")
    return heads.select("id", "shipment_nbr", "phone", "weight", time_text("created").alias("created"))


@query(
    "tracking_export_detail",
    """
    SELECT CAST(conv_id AS VARCHAR) AS id, role AS tag, text AS message,
           strftime(TIMESTAMP '2026-01-01' + to_hours(CAST(turn % 10 AS INT)) - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS checkpoint_time,
           strftime(TIMESTAMP '2026-01-01 00:30:00' + to_hours(CAST(turn % 10 AS INT)), '%Y-%m-%d %H:%M:%S') AS created_at
    FROM conversations WHERE conv_id % 5 > 0
    """,
)
def tracking_export_detail(t: Tables) -> DataFrame:
    _, points = nested.tracking_export(tracking_reports(t), "America/New_York")
    return points.select(
        "id", "tag", "message", time_text("checkpoint_time").alias("checkpoint_time"), time_text("created_at").alias("created_at")
    )
