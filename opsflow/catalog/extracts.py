"""Wide extracts, filters and ledger checks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from opsflow.catalog.base import LINE_KEY, Tables, cents, day_text, flag, query
from opsflow.functions import numbers, predicates as p, text
from opsflow.operators import joins, rows
from opsflow.operators.joins import Lookup
from opsflow.operators.windows import with_group_total


def slug(tracking):
    """Carrier from the first characters of a tracking number."""
    one, two = F.left(tracking, F.lit(1)), F.left(tracking, F.lit(2))
    return p.first_match(
        [
            (one == "9", "usps"),
            ((one == "8") | two.isin("38", "39", "87"), "fedex"),
            (two == "1Z", "ups"),
        ]
    )


@query(
    "tracked_lines",
    """
    WITH base AS (
      SELECT l.*, CAST(l_partkey AS VARCHAR) AS tracking,
             sum(CAST(l_extendedprice AS DECIMAL(18,2)))
               OVER (PARTITION BY l_orderkey, l_linestatus) AS package_value
      FROM lineitem l)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           c_name AS customer, n_name AS nation, p_name AS product, tracking,
           CASE WHEN left(tracking, 1) = '9' THEN 'usps'
                WHEN left(tracking, 1) = '8' OR left(tracking, 2) IN ('38', '39', '87') THEN 'fedex'
                WHEN left(tracking, 2) = '1Z' THEN 'ups' END AS slug,
           CASE WHEN package_value < 20000 THEN '$0-19999.99'
                WHEN package_value < 50000 THEN '$20000-49999.99'
                WHEN package_value < 100000 THEN '$50000-99999.99'
                WHEN package_value < 200000 THEN '$100000-199999.99'
                ELSE '$200000+' END AS package_value,
           'order/' || CAST(l_orderkey AS VARCHAR) || '-' || o_orderstatus AS link
    FROM base JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN part ON l_partkey = p_partkey
    """,
)
def tracked_lines(t: Tables) -> DataFrame:
    lines = t.lineitem.select(*LINE_KEY, "l_linestatus", "l_extendedprice")
    valued = with_group_total(
        lines,
        ["l_orderkey", "l_linestatus"],
        {"_value": F.sum(cents(F.col("l_extendedprice")))},
    )
    wide = joins.enrich(
        valued,
        [
            Lookup(t.orders, {"l_orderkey": "o_orderkey"}, {"_cust": "o_custkey", "_status": "o_orderstatus"}, "inner"),
            Lookup(t.customer, {"_cust": "c_custkey"}, {"customer": "c_name", "_nation": "c_nationkey"}, "inner"),
            Lookup(t.nation, {"_nation": "n_nationkey"}, {"nation": "n_name"}, "inner"),
            Lookup(t.part, {"l_partkey": "p_partkey"}, {"product": "p_name"}, "inner"),
        ],
    )
    tracking = F.col("l_partkey").cast("string")
    return wide.select(
        *LINE_KEY, "customer", "nation", "product",
        tracking.alias("tracking"),
        slug(tracking).alias("slug"),
        p.bucketize(
            F.col("_value"),
            [20000, 50000, 100000, 200000],
            ["$0-19999.99", "$20000-49999.99", "$50000-99999.99", "$100000-199999.99", "$200000+"],
        ).alias("package_value"),
        text.join_text("order/", F.col("l_orderkey").cast("string"), "-", F.col("_status")).alias("link"),
    )


CODES = """
    (VALUES ('order', 'F', 'Completed'), ('order', 'O', 'Open'), ('line', 'F', 'Shipped'),
            ('line', 'O', 'Waiting')) AS codes(tbl, code, status)
"""


def status_codes(t: Tables) -> DataFrame:
    """Status meanings by domain: a small fixed lookup table."""
    return t.spark.createDataFrame(
        [("order", "F", "Completed"), ("order", "O", "Open"), ("line", "F", "Shipped"), ("line", "O", "Waiting")],
        "tbl string, code string, status string",
    )


@query(
    "sales_order_extract",
    f"""
    SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey,
           strftime(o_orderdate, '%Y-%m-%d') AS date_placed,
           rtrim(c_name) AS customer, cn.n_name AS customer_nation, sn.n_name AS carrier_nation,
           p_name AS item, CAST(trunc(l_quantity) AS INT) AS quantity,
           CAST(CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                AS DECIMAL(18,2)) AS DOUBLE) AS line_price,
           os.status AS order_status, ls.status AS line_status,
           coalesce(sn.n_name, cn.n_name) AS ship_from
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN part ON l_partkey = p_partkey
    LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey AND s_acctbal >= 5000
    JOIN (SELECT * FROM {CODES}) os ON o_orderstatus = os.code AND os.tbl = 'order'
    LEFT JOIN (SELECT * FROM {CODES}) ls ON l_linestatus = ls.code AND ls.tbl = 'line'
    WHERE o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED')
      AND o_orderdate >= TIMESTAMP '2001-08-01' - INTERVAL 700 DAY
    """,
)
def sales_order_extract(t: Tables) -> DataFrame:
    recent = t.orders.where(
        ~F.col("o_orderpriority").isin("5-LOW", "4-NOT SPECIFIED")
        & p.changed_since(F.col("o_orderdate"), datetime(2001, 8, 1), "700 DAYS")
    )
    codes = status_codes(t)
    lines = joins.enrich(
        t.lineitem.select(*LINE_KEY, "l_quantity", "l_extendedprice", "l_discount", "l_linestatus"),
        [Lookup(recent, {"l_orderkey": "o_orderkey"},
                {"_cust": "o_custkey", "_date": "o_orderdate", "_status": "o_orderstatus"}, "inner")],
    )
    wide = joins.enrich(
        lines,
        [
            Lookup(t.customer, {"_cust": "c_custkey"}, {"_name": "c_name", "_cn": "c_nationkey"}, "inner"),
            Lookup(t.part, {"l_partkey": "p_partkey"}, {"item": "p_name"}, "inner"),
            Lookup(t.nation, {"_cn": "n_nationkey"}, {"customer_nation": "n_name"}),
            Lookup(t.supplier, {"l_suppkey": "s_suppkey"},
                   {"_sn": "s_nationkey"}, where=F.col("s_acctbal") >= 5000),
            Lookup(t.nation, {"_sn": "n_nationkey"}, {"carrier_nation": "n_name"}),
        ],
    )
    wide = joins.lookup_code(wide, codes, "order", "_status", "order_status", "inner")
    wide = joins.lookup_code(wide, codes, "line", "l_linestatus", "line_status")
    return wide.select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey",
        day_text("_date").alias("date_placed"),
        F.rtrim("_name").alias("customer"), "customer_nation", "carrier_nation", "item",
        numbers.whole(F.col("l_quantity")).alias("quantity"),
        numbers.money(
            F.col("l_extendedprice").cast("decimal(14,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
        ).cast("double").alias("line_price"),
        "order_status", "line_status",
        p.prefer(F.col("carrier_nation"), F.col("customer_nation")).alias("ship_from"),
    )


@query(
    "phone_revenue",
    """
    SELECT DISTINCT c_custkey, coalesce(ltrim(nullif(c_mktsegment, 'BUILDING')), c_name) AS name,
           o_orderkey, l_linenumber, strftime(o_orderdate, '%Y-%m-%d') AS order_date,
           rtrim(p_brand) AS item, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS line_amt
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND c_mktsegment IS NOT NULL
      AND p_name NOT ILIKE '%widget%'
      AND greatest(o_orderdate, l_shipdate) >= TIMESTAMP '2001-08-01' - INTERVAL 365 DAY
    """,
)
def phone_revenue(t: Tables) -> DataFrame:
    orders = t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    parts = t.part.where(~F.col("p_name").ilike("%widget%"))
    wide = joins.enrich(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate"),
        [
            Lookup(orders, {"l_orderkey": "o_orderkey"}, {"_cust": "o_custkey", "_date": "o_orderdate"}, "inner"),
            Lookup(parts, {"l_partkey": "p_partkey"}, {"_brand": "p_brand"}, "inner"),
            Lookup(t.customer.where(F.col("c_mktsegment").isNotNull()), {"_cust": "c_custkey"},
                   {"_name": "c_name", "_segment": "c_mktsegment"}, "inner"),
        ],
    ).where(p.any_changed_since([F.col("_date"), F.col("l_shipdate")], datetime(2001, 8, 1), "365 DAYS"))
    return wide.select(
        F.col("_cust").alias("c_custkey"),
        p.contact_name(F.lit(None).cast("string"), F.nullif(F.col("_segment"), F.lit("BUILDING")), F.col("_name")).alias("name"),
        F.col("l_orderkey").alias("o_orderkey"),
        "l_linenumber",
        day_text("_date").alias("order_date"),
        F.rtrim("_brand").alias("item"),
        cents(F.col("l_extendedprice")).cast("double").alias("line_amt"),
    ).distinct()


@query(
    "filter_groups",
    """
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
    WHERE (o_orderstatus = 'O' AND o_totalprice >= 300000 AND o_orderpriority NOT IN ('5-LOW', '1-URGENT'))
       OR (o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderpriority IN ('5-LOW', '1-URGENT'))
    """,
)
def filter_groups(t: Tables) -> DataFrame:
    closed = ["5-LOW", "1-URGENT"]
    groups = [
        [
            {"column": "o_orderstatus", "operator": "EQ", "value": "O"},
            {"column": "o_totalprice", "operator": "GTE", "value": 300000},
            {"column": "o_orderpriority", "operator": "NOT_IN", "values": closed},
        ],
        [
            {"column": "o_orderstatus", "operator": "EQ", "value": "F"},
            {"column": "o_orderdate", "operator": "GTE", "value": F.lit(datetime(2000, 1, 1)).cast("timestamp_ntz")},
            {"column": "o_orderpriority", "operator": "IN", "values": closed},
        ],
    ]
    return t.orders.where(p.filter_groups(groups)).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(
    "all_equal_flag",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE WHEN cn.n_name = sn.n_name AND cn.n_regionkey = sn.n_regionkey THEN 1 ELSE 0 END AS same_place
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey AND s_acctbal > 1000
    LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey
    LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey
    """,
)
def all_equal_flag(t: Tables) -> DataFrame:
    wide = joins.enrich(
        t.lineitem.select(*LINE_KEY),
        [
            Lookup(t.orders, {"l_orderkey": "o_orderkey"}, {"_cust": "o_custkey"}, "inner"),
            Lookup(t.customer, {"_cust": "c_custkey"}, {"_cn": "c_nationkey"}, "inner"),
            Lookup(t.supplier, {"l_suppkey": "s_suppkey"}, {"_sn": "s_nationkey"}, where=F.col("s_acctbal") > 1000),
            Lookup(t.nation, {"_cn": "n_nationkey"}, {"a_name": "n_name", "a_region": "n_regionkey"}),
            Lookup(t.nation, {"_sn": "n_nationkey"}, {"b_name": "n_name", "b_region": "n_regionkey"}),
        ],
    )
    pairs = [(F.col("a_name"), F.col("b_name")), (F.col("a_region"), F.col("b_region"))]
    return wide.select(*LINE_KEY, p.all_equal(pairs).alias("same_place"))


@query(
    "orders_without_lines",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def orders_without_lines(t: Tables) -> DataFrame:
    ledger = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.not_in_ledger(t.orders.select("o_orderkey", "o_orderstatus"), ledger, ["o_orderkey"])


@query(
    "unhandled_docs",
    """
    SELECT doc_id, lang, source FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
      AND NOT EXISTS (SELECT 1 FROM benchmark b WHERE b.text = d.text)
    """,
)
def unhandled_docs(t: Tables) -> DataFrame:
    return joins.not_in_ledgers(
        t.documents.select("doc_id", "lang", "source", "text"),
        [(t.labels, ["doc_id"]), (t.benchmark, ["text"])],
    ).drop("text")


@query(
    "restrict_to_keys",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders
                         WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')
    """,
)
def restrict_to_keys(t: Tables) -> DataFrame:
    keys = t.orders.where(
        (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")
    ).select(F.col("o_orderkey").alias("l_orderkey"))
    return joins.restrict_to(t.lineitem.select(*LINE_KEY), keys, ["l_orderkey"])


@query(
    "renamed_key_join",
    """
    SELECT o_orderkey, c_name, o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE c_mktsegment = 'MACHINERY'
    """,
)
def renamed_key_join(t: Tables) -> DataFrame:
    from opsflow.sources import join_sources

    customers = t.customer.where(F.col("c_mktsegment") == "MACHINERY")
    return join_sources(t.orders, customers, {"o_custkey": "c_custkey"}).select(
        "o_orderkey", "c_name", "o_orderstatus"
    )


@query(
    "derived_orders",
    """
    WITH o AS (SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day,
                      strftime(o_orderdate + INTERVAL 7 DAY, '%Y-%m-%d') AS week_later FROM orders)
    SELECT a.o_orderkey, b.o_orderkey AS derived FROM o a
    LEFT JOIN o b ON a.o_custkey = b.o_custkey AND a.week_later = b.day
    """,
)
def derived_orders(t: Tables) -> DataFrame:
    days = t.orders.select(
        "o_orderkey",
        "o_custkey",
        day_text("o_orderdate").alias("day"),
        day_text(F.col("o_orderdate") + F.expr("INTERVAL 7 DAYS")).alias("week_later"),
    )
    return joins.derived_rows(
        days, ["o_custkey", "week_later"], ["o_custkey", "day"], {"derived": "o_orderkey"}
    ).select("o_orderkey", "derived")


@query(
    "map_lookup",
    """
    SELECT c_custkey, coalesce(r_name, 'unknown') AS region FROM customer
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey AND r_name <> 'ASIA'
    """,
)
def map_lookup(t: Tables) -> DataFrame:
    nations = joins.map_lookup(
        t.customer.select("c_custkey", "c_nationkey"), "c_nationkey", t.nation, "n_nationkey", "n_regionkey", "_r"
    )
    regions = t.region.where(F.col("r_name") != "ASIA")
    return joins.map_lookup(nations, "_r", regions, "r_regionkey", "r_name", "region", "unknown").select(
        "c_custkey", "region"
    )


@query(
    "join_expr",
    """
    SELECT c_custkey, s_name FROM customer LEFT JOIN supplier
      ON CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE c_custkey END = s_suppkey
    """,
)
def join_expr(t: Tables) -> DataFrame:
    key = F.when(F.col("c_mktsegment") == "BUILDING", F.lit(1).cast("bigint")).otherwise(F.col("c_custkey"))
    return joins.join_expr(
        t.customer.select("c_custkey", "c_mktsegment"), t.supplier.select("s_suppkey", "s_name"), key, "s_suppkey"
    ).select("c_custkey", "s_name")


@query(
    "stuck_returns",
    """
    SELECT DISTINCT o_orderkey, c_name, n_name, 'return/' || o_orderstatus || '/' || CAST(o_orderkey AS VARCHAR) AS link
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal < 9000
    LEFT JOIN nation ON c_nationkey = n_nationkey
    WHERE left(o_orderpriority, 2) = '4-' AND right(o_orderpriority, 9) = 'SPECIFIED'
      AND (c_name IS NULL OR c_mktsegment = 'FURNITURE')
      AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
    """,
)
def stuck_returns(t: Tables) -> DataFrame:
    stuck = t.orders.where(
        F.col("o_orderpriority").startswith("4-") & F.col("o_orderpriority").endswith("SPECIFIED")
    )
    wide = joins.enrich(
        stuck,
        [
            Lookup(t.customer, {"o_custkey": "c_custkey"},
                   {"c_name": "c_name", "_n": "c_nationkey", "_s": "c_mktsegment"}, where=F.col("c_acctbal") < 9000),
            Lookup(t.nation, {"_n": "n_nationkey"}, {"n_name": "n_name"}),
        ],
    ).where(p.null_or(F.col("c_name"), F.col("_s") == "FURNITURE"))
    returned = t.lineitem.where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.not_in_ledger(wide, returned, ["o_orderkey"], basis=stuck).select(
        "o_orderkey", "c_name", "n_name",
        text.join_text("return/", F.col("o_orderstatus"), "/", F.col("o_orderkey").cast("string")).alias("link"),
    ).distinct()


@query(
    "attributes_pivot",
    """
    SELECT c_custkey, max(CASE WHEN event_type = 'purchase' THEN value END) AS top_purchase,
           max(CASE WHEN event_type = 'error' THEN value END) AS top_error
    FROM customer LEFT JOIN events ON c_custkey = user_id GROUP BY c_custkey
    """,
)
def attributes_pivot(t: Tables) -> DataFrame:
    attributes = t.events.select("user_id", F.col("event_type").alias("field_name"), "value")
    return joins.attach_attributes(
        t.customer.select("c_custkey"),
        attributes,
        {"c_custkey": "user_id"},
        {"top_purchase": ("purchase", "value"), "top_error": ("error", "value")},
    )


@query(
    "newest_120",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
    ORDER BY o_orderdate DESC, o_orderkey LIMIT 120
    """,
)
def newest_120(t: Tables) -> DataFrame:
    return rows.newest(t.orders, 120, [("o_orderdate", "desc"), "o_orderkey"]).select(
        "o_orderkey", day_text("o_orderdate").alias("day")
    )


@query(
    "unpivot_union",
    """
    SELECT DISTINCT o_orderkey, 'priority' AS field_name FROM orders
    WHERE o_orderpriority = '5-LOW' OR o_orderpriority IS NULL
    UNION SELECT DISTINCT o_orderkey, 'price' AS field_name FROM orders WHERE o_totalprice < 20000
    """,
)
def unpivot_union(t: Tables) -> DataFrame:
    low = t.orders.where(p.null_or(F.col("o_orderpriority"), F.col("o_orderpriority") == "5-LOW"))
    cheap = t.orders.where(F.col("o_totalprice") < 20000)
    return rows.union_tagged(
        {"priority": low.select("o_orderkey"), "price": cheap.select("o_orderkey")}, "field_name"
    )


@query(
    "recheck_keys",
    """
    WITH keys AS (SELECT c_custkey AS k FROM customer UNION SELECT o_custkey FROM orders
                  UNION SELECT user_id FROM events WHERE event_type <> 'view')
    SELECT DISTINCT k, o_orderstatus FROM keys LEFT JOIN orders ON k = o_custkey
    WHERE o_orderstatus NOT IN ('F', '') OR o_orderstatus IS NULL
       OR (o_orderdate >= TIMESTAMP '2001-07-25' AND o_orderstatus <> 'O')
    """,
)
def recheck_keys(t: Tables) -> DataFrame:
    keys = rows.union_keys(
        [
            (t.customer, "c_custkey"),
            (t.orders, "o_custkey"),
            (t.events.where(F.col("event_type") != "view"), "user_id"),
        ],
        "k",
    )
    wide = joins.enrich(
        keys, [Lookup(t.orders, {"k": "o_custkey"}, {"o_orderstatus": "o_orderstatus", "_d": "o_orderdate"})]
    )
    status = F.col("o_orderstatus")
    return (
        wide.where(
            p.null_or(status, ~status.isin("F", ""))
            | ((F.col("_d") >= F.lit(datetime(2001, 7, 25))) & (status != "O"))
        )
        .select("k", "o_orderstatus")
        .distinct()
    )


@query(
    "route_by_type",
    """
    SELECT 'w' AS branch, count(*) AS n FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'three' AS branch, count(*) AS n FROM orders WHERE o_orderstatus = 'O'
    """,
)
def route_by_type(t: Tables) -> DataFrame:
    branches = rows.route(
        t.orders, {"w": F.col("o_orderstatus") == "F", "three": F.col("o_orderstatus") == "O"}
    )
    return rows.concat_rows(
        *[
            df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("branch"), "n")
            for name, df in branches.items()
        ]
    )


@query(
    "sorted_distinct",
    "SELECT DISTINCT p_name FROM part WHERE p_name IS NOT NULL ORDER BY p_name",
)
def sorted_distinct(t: Tables) -> DataFrame:
    return rows.sorted_distinct(t.part, "p_name")


@query(
    "constants_and_keys",
    """
    SELECT o_orderkey, coalesce(nullif(o_orderkey % 7, 3), 99) AS line_nbr, 2 AS company_id,
           CAST(NULL AS VARCHAR) AS value_text, 'LINK' AS field_name FROM orders
    """,
)
def constants_and_keys(t: Tables) -> DataFrame:
    keyed = t.orders.select(
        "o_orderkey", F.nullif(F.col("o_orderkey") % 7, F.lit(3).cast("bigint")).alias("line_nbr")
    )
    return rows.with_constants(
        rows.fill_key(keyed, "line_nbr", 99),
        {"company_id": (2, "int"), "value_text": (None, "string"), "field_name": ("LINK", "string")},
    )


@query(
    "distinct_by_key",
    """
    SELECT o_custkey, o_orderkey FROM (
      SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn
      FROM orders) WHERE rn = 1
    """,
)
def distinct_by_key(t: Tables) -> DataFrame:
    return rows.distinct_by(
        t.orders, ["o_custkey"], [("o_orderdate", "desc"), "o_orderkey"]
    ).select("o_custkey", "o_orderkey")


@query(
    "freshness_and_blanks",
    """
    SELECT o_orderkey,
      CASE WHEN o_orderdate >= TIMESTAMP '2001-07-01' - INTERVAL 30 DAY THEN 1 ELSE 0 END AS fresh,
      CASE WHEN trim(replace(o_orderpriority, '5-LOW', ' ')) = '' THEN 1 ELSE 0 END AS blank,
      CASE WHEN o_orderpriority ILIKE '%high%' OR o_orderpriority ILIKE '%urgent%' THEN 1 ELSE 0 END AS pressing
    FROM orders
    """,
)
def freshness_and_blanks(t: Tables) -> DataFrame:
    blanked = F.replace(F.col("o_orderpriority"), F.lit("5-LOW"), F.lit(" "))
    return t.orders.select(
        "o_orderkey",
        flag(p.changed_since(F.col("o_orderdate"), datetime(2001, 7, 1), "30 DAYS")).alias("fresh"),
        flag(p.is_blank(blanked)).alias("blank"),
        flag(p.contains_any(F.col("o_orderpriority"), ["high", "urgent"])).alias("pressing"),
    )
