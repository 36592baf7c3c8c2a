"""Partner reports as datasets, the tombstone tables, reports without ids, values and match groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from opsflow.catalog.base import Tables, cents, day_text, query, time_text
from opsflow.catalog.datasets import plain
from opsflow.catalog.partners import AS_OF, UTC, ship_nbr
from opsflow.operators import aggregates, matching
from opsflow.operators.joins import Lookup, enrich
from opsflow.plans import contracts, feeds, warehouse
from opsflow.session import scratch


@query(
    "return_statuses",
    """
    SELECT 'S' || CAST(l_orderkey AS VARCHAR) AS rma_number, CASE o_orderstatus WHEN 'F' THEN 'W' WHEN 'O' THEN '3' ELSE 'X' END AS rma_type,
      o_orderpriority AS rma_status, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS created_at, l_suppkey AS rma_line_id, l_linenumber AS rma_line_nbr,
      CASE o_orderstatus WHEN 'F' THEN l_returnflag WHEN 'O' THEN l_linestatus END AS line_status,
      CASE o_orderstatus WHEN 'F' THEN 'w' || CAST(l_partkey AS VARCHAR) WHEN 'O' THEN 'd' || CAST(l_partkey AS VARCHAR) END AS inventory_cd,
      CASE o_orderstatus WHEN 'F' THEN CAST(l_quantity AS BIGINT) WHEN 'O' THEN CAST(l_quantity AS BIGINT) + 1 END AS qty,
      CASE WHEN o_orderstatus = 'O' THEN 'model' END AS descr, CASE WHEN o_orderstatus = 'F' THEN 'ups' END AS carrier,
      CASE WHEN o_orderstatus = 'F' THEN 'high' END AS priority
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
)
def return_statuses(t: Tables) -> DataFrame:
    """Return reports of both types, one row per line of either."""
    lines = enrich(
        t.lineitem,
        [Lookup(t.orders, {"l_orderkey": "o_orderkey"}, {"_s": "o_orderstatus", "_p": "o_orderpriority", "_d": "o_orderdate"}, "inner")],
    )
    qty = F.col("l_quantity").cast("bigint")
    item = F.struct(
        F.col("l_suppkey").alias("rmaLineID"), F.col("l_linenumber").alias("rmaLineNumber"), F.col("l_returnflag").alias("rpStatus"),
        F.col("l_linestatus").alias("dfStatus"), F.concat(F.lit("w"), F.col("l_partkey").cast("string")).alias("rpItem"),
        F.concat(F.lit("d"), F.col("l_partkey").cast("string")).alias("dfItem"), qty.alias("rpQuantityExp"), (qty + 1).alias("dfQuantityExp"),
        F.lit("model").alias("dfModelNum"),
    )
    # one report per line: how many lines a report has changes no row
    stamp = F.date_format("_d", UTC)
    reports = lines.select(
        ship_nbr().alias("rmaNumber"), F.col("l_orderkey").alias("rmaId"),
        F.when(F.col("_s") == "F", "W").when(F.col("_s") == "O", "3").otherwise("X").alias("rmaTypeName"), F.col("_p").alias("rmaStatus"),
        F.lit("ref").alias("customerRef"), F.lit("desc").alias("rmaTypeDescription"), stamp.alias("rmaCreateDate"),
        stamp.alias("rmaLastModifiedDate"), F.lit("ups").alias("inboundShipCarrier"), F.lit("high").alias("inboundShipPriority"),
        F.array(item).alias("rmaLines"),
    )
    return feeds.return_statuses(reports, F.lit(AS_OF)).select(
        "rma_number", "rma_type", "rma_status", time_text("created_at").alias("created_at"), "rma_line_id", "rma_line_nbr", "line_status",
        "inventory_cd", "qty", "descr", "carrier", "priority",
    )


QTY_SQL = ", ".join(f"CAST(sum(l_quantity + {i}) AS BIGINT) AS {q}" for i, q in enumerate(feeds.QUANTITIES))
PER_LINE_SQL = ", ".join(f"CAST(l_quantity + {i} AS BIGINT) AS {q}" for i, q in enumerate(feeds.QUANTITIES))


def stock(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Stock reports with all nine quantities, per item and in detail per warehouse."""
    text_of = lambda c: F.concat(c.cast("string"), F.lit(".7500"))
    qty = F.col("l_quantity").cast("bigint")
    lines = t.lineitem.select(
        "l_partkey", F.struct((F.col("l_suppkey") % 10).cast("string").alias("warehouse_id"),
                              *[text_of(qty + i).alias(f"qty_{q}") for i, q in enumerate(feeds.QUANTITIES)]).alias("_line"),
        *[(qty + i).alias(f"_{q}") for i, q in enumerate(feeds.QUANTITIES)],
    )
    sums = t.lineitem.groupBy("l_partkey").agg(*[text_of(F.sum(qty + i)).alias(f"qty_{q}") for i, q in enumerate(feeds.QUANTITIES)])
    # an item's detail may come in several reports, its totals in one
    none = F.array().cast(f"array<{lines.schema['_line'].dataType.simpleString()}>")
    totals = sums.select(F.col("l_partkey").alias("sku"), *[f"qty_{q}" for q in feeds.QUANTITIES], none.alias("detailed"))
    parts = lines.select(F.col("l_partkey").alias("sku"), *[F.lit(None).cast("string").alias(f"qty_{q}") for q in feeds.QUANTITIES], F.array("_line").alias("detailed"))
    names = {"6": "WEST", "7": "EAST"}
    return feeds.inventory_levels(totals, names, F.lit(AS_OF))[0], feeds.inventory_levels(parts, names, F.lit(AS_OF))[1]


@query("inventory_levels", f"SELECT l_partkey AS item, {QTY_SQL} FROM lineitem GROUP BY 1")
def inventory_levels(t: Tables) -> DataFrame:
    return stock(t)[0].drop("ts")


@query(
    "inventory_levels_detail",
    f"SELECT l_partkey AS item, CASE l_suppkey % 10 WHEN 6 THEN 'WEST' WHEN 7 THEN 'EAST' ELSE 'Unknown' END AS warehouse, {PER_LINE_SQL} FROM lineitem",
)
def inventory_levels_detail(t: Tables) -> DataFrame:
    return stock(t)[1].drop("ts")


# -- tombstones ------------------------------------------------------------------

SINCE = "TIMESTAMP '2001-08-01' - INTERVAL 900 DAY"


@query(
    "line_deletions",
    f"""
    SELECT o_orderstatus AS order_type, CAST(l_orderkey AS VARCHAR) AS order_nbr, l_linenumber AS line_nbr, CAST(l_quantity AS INT) AS order_qty,
           CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS ext_price, 'u' AS deleted_by, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS deleted_at,
           NULL::VARCHAR AS reason_code
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' AND l_shipdate >= {SINCE}
    """,
)
def line_deletions(t: Tables) -> DataFrame:
    """Tombstones of order lines in the shape of their target: all its columns, unknown ones empty."""
    spec = contracts.TABLES["line_deletions"]
    lines = enrich(t.lineitem.where(F.col("l_returnflag") == "R"), [Lookup(t.orders, {"l_orderkey": "o_orderkey"}, {"order_type": "o_orderstatus"}, "inner")])
    known = {
        "order_nbr": F.col("l_orderkey").cast("string"), "line_nbr": F.col("l_linenumber"), "deleted_at": F.col("l_shipdate"),
        "deleted_by": F.lit("u"), "order_qty": F.col("l_quantity").cast("int"), "ext_price": cents(F.col("l_extendedprice")), "inventory_id": F.col("l_partkey"),
    }
    rest = {f.name: F.lit(None).cast(f.dataType) for f in spec.schema if f.name not in known and f.name != "order_type"}
    found = warehouse.recent_deletions(lines.withColumns({**known, **rest}), spec, AS_OF, "900 DAYS")
    return found.select(
        "order_type", "order_nbr", "line_nbr", "order_qty", F.col("ext_price").cast("double").alias("ext_price"), "deleted_by",
        time_text("deleted_at").alias("deleted_at"), "reason_code",
    )


@query(
    "shipment_deletions",
    f"""
    SELECT 'S' || CAST(o_orderkey AS VARCHAR) AS shipment_nbr, strftime(o_orderdate, '%Y-%m-%d') AS ship_date, o_orderpriority AS deleted_by,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS deleted_at
    FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= {SINCE}
    """,
)
def shipment_deletions(t: Tables) -> DataFrame:
    gone = t.orders.where(F.col("o_orderstatus") == "F").select(
        ship_nbr("o_orderkey").alias("shipment_nbr"), F.col("o_orderdate").cast("date").alias("ship_date"),
        F.col("o_orderpriority").alias("deleted_by"), F.col("o_orderdate").alias("deleted_at"),
    )
    found = warehouse.recent_deletions(gone, contracts.TABLES["shipment_deletions"], AS_OF, "900 DAYS")
    return found.select("shipment_nbr", day_text("ship_date").alias("ship_date"), "deleted_by", time_text("deleted_at").alias("deleted_at"))


@query(
    "order_shipment_deletions",
    f"""
    SELECT DISTINCT o_orderstatus AS order_type, CAST(l_orderkey AS VARCHAR) AS order_nbr, 'S' || CAST(l_orderkey AS VARCHAR) AS shipment_nbr,
           'u' AS deleted_by, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS deleted_at
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linestatus = 'F' AND o_orderdate >= {SINCE}
    """,
)
def order_shipment_deletions(t: Tables) -> DataFrame:
    gone = enrich(
        t.lineitem.where(F.col("l_linestatus") == "F").select("l_orderkey").distinct(),
        [Lookup(t.orders, {"l_orderkey": "o_orderkey"}, {"order_type": "o_orderstatus", "deleted_at": "o_orderdate"}, "inner")],
    ).select(
        "order_type", F.col("l_orderkey").cast("string").alias("order_nbr"), ship_nbr().alias("shipment_nbr"),
        F.lit(None).cast("date").alias("ship_date"), F.lit("u").alias("deleted_by"), "deleted_at",
    )
    found = warehouse.recent_deletions(gone, contracts.TABLES["order_shipment_deletions"], AS_OF, "900 DAYS")
    return found.select("order_type", "order_nbr", "shipment_nbr", "deleted_by", time_text("deleted_at").alias("deleted_at"))


@query(
    "campaigns_without_ids",
    """
    SELECT o_orderkey AS campaign_id, 'Camp ' || o_orderstatus AS campaign_name, strftime(o_orderdate, '%Y-%m-%d') AS report_date, o_custkey AS clicks,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS cost
    FROM orders
    """,
)
def campaigns_without_ids(t: Tables) -> DataFrame:
    """A report file without an id column: the id is in parentheses at the end of the name."""
    path = scratch(t.spark, "campaigns")
    name = F.concat(F.lit("Camp "), "o_orderstatus", F.lit(" ("), F.col("o_orderkey").cast("string"), F.lit(")"))
    t.orders.select(
        day_text("o_orderdate").alias("day"), name.alias("campaign_name"), F.col("o_custkey").alias("clicks"), F.lit(3).alias("displays"),
        cents(F.col("o_totalprice")).alias("cost"), F.lit(1).alias("sales"), F.lit("2.5").alias("revenue"),
    ).write.option("sep", ";").option("header", True).csv(path)
    loaded = feeds.load_campaigns(t.spark, path, 7, F.lit(AS_OF))
    return loaded.select("campaign_id", "campaign_name", day_text("report_date").alias("report_date"), "clicks", "cost")


# -- values and match groups -------------------------------------------------------

VALUE_COLUMNS = ("o_orderstatus", "o_orderpriority", "o_custkey", "o_orderkey")


@query(
    "column_values",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", row_number() OVER (ORDER BY {c}) AS place, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM orders GROUP BY {c}"
        for c in VALUE_COLUMNS
    ),
)
def column_values(t: Tables) -> DataFrame:
    """All distinct values of four columns in order, ids among them."""
    return aggregates.column_values(t.orders, VALUE_COLUMNS)


@query(
    "profile_of_values",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count({c}) AS BIGINT) AS n_values, count(DISTINCT {c}) AS n_unique, CAST(min({c}) AS VARCHAR) AS lowest, "
        f"CAST(max({c}) AS VARCHAR) AS highest FROM orders"
        for c in VALUE_COLUMNS
    ),
)
def profile_of_values(t: Tables) -> DataFrame:
    return aggregates.profile_of_values(aggregates.column_values(t.orders, VALUE_COLUMNS))


@query(
    "match_groups",
    """
    SELECT c_mktsegment AS segment, n_left, n_right, CAST(n_left * n_right AS BIGINT) AS n_pairs
    FROM (SELECT c_mktsegment, count(*) AS n_left FROM customer GROUP BY 1)
    JOIN (SELECT c_mktsegment AS s, count(*) AS n_right FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1) ON s = c_mktsegment
    """,
)
def match_groups(t: Tables) -> DataFrame:
    """Customers and orders of a segment: five keys, each hot on both sides."""
    left = t.customer.select(F.col("c_mktsegment").alias("segment"), "c_custkey")
    right = enrich(t.orders, [Lookup(t.customer, {"o_custkey": "c_custkey"}, {"segment": "c_mktsegment"}, "inner")])
    return matching.match_groups(left, right.select("segment", "o_orderkey"), ["segment"]).groups.withColumn("n_pairs", F.col("n_pairs").cast("bigint"))


@query(
    "precedence_groups",
    """
    WITH s AS (SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'R') AS a, count(*) FILTER (WHERE l_returnflag = 'A') AS b,
                      count(*) FILTER (WHERE l_returnflag = 'N' AND l_linestatus = 'F') AS c FROM lineitem GROUP BY 1)
    SELECT o_orderkey, 'events' AS source, a AS n FROM orders JOIN s ON o_orderkey = l_orderkey WHERE a > 0
    UNION ALL SELECT o_orderkey, 'list', b FROM orders JOIN s ON o_orderkey = l_orderkey WHERE a = 0 AND b > 0
    UNION ALL SELECT o_orderkey, 'other', c FROM orders JOIN s ON o_orderkey = l_orderkey WHERE c > 0
    """,
)
def precedence_groups(t: Tables) -> DataFrame:
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    flag_is = F.col("l_returnflag")
    return matching.precedence_groups(
        t.orders.select("o_orderkey"),
        [("events", lines.where(flag_is == "R"), ["o_orderkey"]), ("list", lines.where(flag_is == "A"), ["o_orderkey"])],
        [("other", lines.where((flag_is == "N") & (F.col("l_linestatus") == "F")), ["o_orderkey"])],
    )
