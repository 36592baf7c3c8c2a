"""Matching, windows and grouped reports."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from opsflow.catalog.base import LINE_KEY, Tables, cents, day_text, flag, query
from opsflow.functions import dates, predicates as p, text
from opsflow.operators import aggregates, joins, matching, windows
from opsflow.operators.joins import Lookup
from opsflow.operators.skew import group_pieces

AS_OF = datetime(2024, 1, 31)


@query(
    "conflicting_status",
    """
    SELECT l_orderkey, min(l_linestatus) AS status, max(l_linestatus) AS alternative,
           CASE min(l_linestatus) WHEN 'F' THEN 1 ELSE 2 END AS rank
    FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_linestatus) > 1
    """,
)
def conflicting_status(t: Tables) -> DataFrame:
    rank = p.first_match([(F.col("l_linestatus") == "F", 1)], 2)
    return joins.ranked_conflicts(t.lineitem, "l_orderkey", "l_linestatus", rank).withColumnRenamed(
        "l_linestatus", "status"
    )


@query(
    "conflicting_rows",
    """
    SELECT a.l_orderkey, a.l_linenumber, a.l_partkey, a.l_suppkey, a.l_returnflag FROM lineitem a
    WHERE EXISTS (SELECT 1 FROM lineitem b WHERE a.l_orderkey = b.l_orderkey AND a.l_returnflag <> b.l_returnflag)
    """,
)
def conflicting_rows(t: Tables) -> DataFrame:
    return joins.conflicting_rows(t.lineitem.select(*LINE_KEY, "l_returnflag"), "l_orderkey", "l_returnflag")


@query(
    "keys_having",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_orderkey IN
      (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING max(l_linenumber) <= 4)
    """,
)
def keys_having(t: Tables) -> DataFrame:
    return joins.where_group(
        t.lineitem.select(*LINE_KEY), ["l_orderkey"], F.max("l_linenumber"), "value <= 4"
    )


@query(
    "attach_agg",
    """
    SELECT o_orderkey, (SELECT sum(CAST(trunc(l_quantity) AS BIGINT)) FROM lineitem WHERE l_orderkey = o_orderkey) AS qty,
           (SELECT count(DISTINCT l_suppkey) FROM lineitem WHERE l_orderkey = o_orderkey) AS carriers
    FROM orders
    """,
)
def attach_agg(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity", "l_suppkey")
    counted = joins.attach_agg(
        t.orders.select("o_orderkey"),
        lines,
        ["o_orderkey"],
        [F.sum(F.col("l_quantity").cast("bigint")).alias("qty"), F.count_distinct("l_suppkey").alias("carriers")],
    )
    return counted.fillna(0, subset=["carriers"])


@query(
    "ready_to_confirm",
    """
    WITH packed AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                           CASE WHEN l_discount > 0.09 THEN l_quantity - 1 ELSE l_quantity END AS packed,
                           'T' || CAST(l_suppkey AS VARCHAR) AS tracking
                    FROM lineitem WHERE l_tax < 0.08),
    top AS (
      SELECT l.l_orderkey, count(*) AS lines, CAST(sum(l_quantity) AS BIGINT) AS line_qty,
             CAST(sum(packed) AS BIGINT) AS package_qty, count(DISTINCT tracking) AS packages
      FROM lineitem l JOIN packed p USING (l_orderkey, l_linenumber, l_partkey, l_suppkey)
      GROUP BY l.l_orderkey)
    SELECT top.*, s.shipped_qty, k.packed_qty FROM top
    JOIN (SELECT l_orderkey, CAST(sum(l_quantity) AS BIGINT) AS shipped_qty FROM lineitem GROUP BY 1) s USING (l_orderkey)
    JOIN (SELECT l_orderkey, CAST(sum(packed) AS BIGINT) AS packed_qty FROM packed GROUP BY 1) k USING (l_orderkey)
    WHERE line_qty = package_qty AND shipped_qty = packed_qty
    """,
)
def ready_to_confirm(t: Tables) -> DataFrame:
    packed = t.lineitem.where(F.col("l_tax") < 0.08).select(
        *LINE_KEY,
        F.when(F.col("l_discount") > 0.09, F.col("l_quantity") - 1).otherwise(F.col("l_quantity")).alias("packed"),
        text.join_text("T", F.col("l_suppkey").cast("string")).alias("tracking"),
    )
    return aggregates.ready_to_confirm(
        t.lineitem.select(*LINE_KEY, "l_quantity"), packed, "l_orderkey", LINE_KEY[1:],
        "l_quantity", "packed", "tracking",
    )


@query(
    "completion_label",
    """
    WITH item AS (SELECT l_orderkey, l_linenumber, sum(l_quantity) AS total FROM lineitem GROUP BY ALL),
    waiting AS (SELECT l_orderkey, count(*) AS rows_, count(l_linestatus) AS known FROM lineitem
                WHERE l_returnflag IS NULL OR l_returnflag = 'N' GROUP BY ALL),
    alike AS (SELECT l_orderkey, l_linestatus, count(*) AS same FROM lineitem WHERE l_returnflag IS NULL OR l_returnflag = 'N' GROUP BY ALL)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CASE WHEN l_quantity <> total THEN 'Not'
           WHEN rows_ > known OR (l_linestatus IS NOT NULL AND known > coalesce(same, 0)) THEN 'Partially Complete' ELSE 'Complete' END AS complete
    FROM lineitem JOIN item USING (l_orderkey, l_linenumber) LEFT JOIN waiting USING (l_orderkey) LEFT JOIN alike USING (l_orderkey, l_linestatus)
    """,
)
def completion_label(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        *LINE_KEY,
        "l_quantity",
        "l_linestatus",
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("pending"),
    )
    return windows.completion_label(
        lines, "l_orderkey", "l_linenumber", "l_quantity", "l_quantity", "l_linestatus", "pending"
    ).select(*LINE_KEY, "complete")


@query(
    "exists_other",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CASE WHEN EXISTS (SELECT 1 FROM lineitem f WHERE f.l_orderkey = r.l_orderkey AND f.l_quantity > 25
                        AND (f.l_returnflag IS NULL OR f.l_returnflag <> r.l_returnflag)) THEN 1 ELSE 0 END AS other
    FROM lineitem r
    """,
)
def exists_other(t: Tables) -> DataFrame:
    lines = t.lineitem.select(*LINE_KEY, "l_quantity", "l_returnflag")
    return joins.exists_other(
        lines, ["l_orderkey"], "l_returnflag", F.col("l_quantity") > 25, "other"
    ).select(*LINE_KEY, flag(F.col("other")).alias("other"))


@query(
    "package_numbers",
    """
    WITH r AS (
      SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus,
        row_number() OVER (PARTITION BY l_orderkey, l_linestatus ORDER BY l_linenumber, l_partkey, l_suppkey, l_linestatus) AS num,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_linestatus) AS package_num
      FROM lineitem)
    SELECT r.*, max(num) OVER (PARTITION BY l_orderkey, l_linestatus) AS items_on_package,
           max(package_num) OVER (PARTITION BY l_orderkey) AS max_package_num FROM r
    """,
)
def package_numbers(t: Tables) -> DataFrame:
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_linestatus"]
    lines = t.lineitem.select(*LINE_KEY, "l_linestatus")
    package, shipment = ["l_orderkey", "l_linestatus"], ["l_orderkey"]
    hot = group_pieces(lines, shipment)
    hot_package = None if hot is None else group_pieces(lines, package)
    count = F.count(F.lit(1))
    result = windows.with_sequence(windows.dealt(lines, shipment, t.lineitem, hot), package, order, "num", hot=hot_package)
    result = windows.with_group_total(result, package, {"items_on_package": count}, basis=lines, hot=hot_package)
    result = windows.with_sequence(result, shipment, order, "package_num", basis=lines, hot=hot)
    return windows.with_group_total(result, shipment, {"max_package_num": count}, basis=lines, hot=hot)


@query(
    "differs_from_first",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem r
    WHERE l_linenumber = 1 OR l_returnflag <>
      (SELECT max(l_returnflag) FROM lineitem h WHERE h.l_orderkey = r.l_orderkey AND h.l_linenumber = 1)
    """,
)
def differs_from_first(t: Tables) -> DataFrame:
    return windows_first(t).select(*LINE_KEY)


def windows_first(t: Tables) -> DataFrame:
    return joins.differs_from_first(
        t.lineitem.select(*LINE_KEY, "l_returnflag"), ["l_orderkey"], "l_linenumber", "l_returnflag"
    )


@query(
    "match_first",
    """
    WITH r AS (SELECT replace(replace(replace('R' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(1 + l_linenumber % 3 AS VARCHAR),
                      '-1', ''), '-2', ''), '-3', '') AS ref, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem),
    f AS (SELECT *, row_number() OVER (PARTITION BY ref ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn FROM r)
    SELECT o_orderkey, l_partkey AS part_3pl, CAST(l_quantity AS BIGINT) AS qty_3pl
    FROM orders JOIN f ON 'R' || CAST(o_orderkey AS VARCHAR) = ref AND rn = 1
    """,
)
def match_first(t: Tables) -> DataFrame:
    suffix = (1 + F.col("l_linenumber") % 3).cast("string")
    reports = t.lineitem.select(
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        text.normalize_ref(text.join_text("R", F.col("l_orderkey").cast("string"), "-", suffix)).alias("ref"),
    )
    wanted = t.orders.select("o_orderkey", text.join_text("R", F.col("o_orderkey").cast("string")).alias("ref"))
    return matching.match_first(wanted, reports, ["ref"], ["l_linenumber", "l_partkey", "l_suppkey"]).select(
        "o_orderkey", F.col("l_partkey").alias("part_3pl"), F.col("l_quantity").cast("bigint").alias("qty_3pl")
    )


@query(
    "match_precedence",
    """
    WITH s1 AS (SELECT * FROM lineitem WHERE l_returnflag = 'R'),
         s2 AS (SELECT * FROM lineitem WHERE l_returnflag = 'A'),
         s3 AS (SELECT * FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus = 'F')
    SELECT o_orderkey, 'events' AS source, l_linenumber, l_partkey, l_suppkey FROM orders JOIN s1 ON o_orderkey = s1.l_orderkey
    UNION ALL
    SELECT o_orderkey, 'list' AS source, l_linenumber, l_partkey, l_suppkey FROM orders JOIN s2 ON o_orderkey = s2.l_orderkey
      WHERE o_orderkey NOT IN (SELECT l_orderkey FROM s1)
    UNION ALL
    SELECT o_orderkey, 'other' AS source, l_linenumber, l_partkey, l_suppkey FROM orders JOIN s3 ON o_orderkey = s3.l_orderkey
    """,
)
def match_precedence(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"
    )

    def source(condition):
        return lines.where(condition).drop("l_returnflag", "l_linestatus")

    flag_is = F.col("l_returnflag")
    return matching.match_precedence(
        t.orders.select("o_orderkey"),
        [("events", source(flag_is == "R"), ["o_orderkey"]), ("list", source(flag_is == "A"), ["o_orderkey"])],
        [("other", source((flag_is == "N") & (F.col("l_linestatus") == "F")), ["o_orderkey"])],
    )


@query(
    "match_first_duplicate",
    """
    WITH s AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity) AS rn FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS BIGINT) AS qty FROM s
    JOIN orders ON l_orderkey = o_orderkey WHERE rn = 1 AND o_orderstatus = 'O'
    """,
)
def match_first_duplicate(t: Tables) -> DataFrame:
    base = t.lineitem.select("l_orderkey", "l_linenumber").distinct()
    open_orders = t.orders.where(F.col("o_orderstatus") == "O").select(F.col("o_orderkey").alias("l_orderkey"))
    base = joins.restrict_to(base, open_orders, ["l_orderkey"])
    reports = t.lineitem.select(*LINE_KEY, F.col("l_quantity").cast("bigint").alias("qty"))
    return matching.match_first(base, reports, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "qty"]).drop("l_suppkey")


TODATE = """
    WITH w AS (SELECT * FROM (VALUES
        ('week', TIMESTAMP '2024-01-29', '2024-02-04'), ('month', TIMESTAMP '2024-01-01', '2024-01-31'),
        ('year', TIMESTAMP '2024-01-01', '2024-12-31')) v("window", s, e)),
    reps AS (SELECT s_suppkey AS rep FROM supplier UNION SELECT user_id FROM events)
"""


@query(
    "todate_counts",
    TODATE
    + """
    SELECT rep, "window", strftime(s, '%Y-%m-%d') AS window_start, e AS window_end,
           (SELECT count(*) FROM events WHERE user_id = rep AND ts >= s) AS n
    FROM w CROSS JOIN reps
    """,
)
def todate_counts(t: Tables) -> DataFrame:
    known = t.supplier.select(F.col("s_suppkey").alias("user_id"))
    return window_days(aggregates.todate_counts(t.events, "user_id", "ts", AS_OF, known))


def window_days(df: DataFrame) -> DataFrame:
    return df.withColumns({c: day_text(c) for c in ("window_start", "window_end")})


@query(
    "activity_wide",
    TODATE
    + """
    , c AS (SELECT "window", s, e, user_id AS rep, event_type, count(*) AS n
            FROM events JOIN w ON ts >= s GROUP BY ALL)
    SELECT k."window", strftime(k.s, '%Y-%m-%d') AS window_start, k.e AS window_end, k.rep,
           coalesce(sum(CASE WHEN event_type = 'click' THEN n END), 0) AS click,
           coalesce(sum(CASE WHEN event_type = 'purchase' THEN n END), 0) AS purchase,
           coalesce(max(c_mktsegment), 'unknown') AS team
    FROM (SELECT * FROM w CROSS JOIN (SELECT DISTINCT user_id AS rep FROM events WHERE event_type IN ('click', 'purchase'))) k
    LEFT JOIN c ON c."window" = k."window" AND c.rep = k.rep
    LEFT JOIN customer ON k.rep = c_custkey AND c_acctbal > 2000
    GROUP BY k."window", k.s, k.e, k.rep
    """,
)
def activity_wide(t: Tables) -> DataFrame:
    counts = {
        kind: aggregates.todate_counts(t.events.where(F.col("event_type") == kind), "user_id", "ts", AS_OF)
        for kind in ("click", "purchase")
    }
    teams = t.customer.where(F.col("c_acctbal") > 2000).select(
        F.col("c_custkey").alias("rep"), F.col("c_mktsegment").alias("team")
    )
    return window_days(aggregates.merge_activity_counts(counts, teams))


@query(
    "reconcile_quantities",
    """
    WITH a AS (SELECT l_orderkey, l_partkey, sum(CAST(l_quantity AS BIGINT)) AS q FROM lineitem GROUP BY ALL),
    b AS (SELECT l_orderkey, l_partkey, sum(CAST(l_quantity AS BIGINT) + CASE WHEN l_discount = 0.1 THEN 1 ELSE 0 END) AS q
          FROM lineitem WHERE l_tax < 0.07 GROUP BY ALL)
    SELECT a.l_orderkey, count(*) AS items,
           CAST(bool_and(coalesce(a.q = b.q, false)) AS INT) AS full_match,
           CAST(bool_or(coalesce(a.q = b.q, false)) AS INT) AS line_match
    FROM a LEFT JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_partkey = b.l_partkey GROUP BY a.l_orderkey
    UNION ALL SELECT o_orderkey, 0, 1, 0 FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    """,
)
def reconcile_quantities(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_partkey", F.col("l_quantity").cast("bigint").alias("qty"))
    packed = t.lineitem.where(F.col("l_tax") < 0.07).select(
        "l_orderkey", "l_partkey",
        (F.col("l_quantity").cast("bigint") + F.when(F.col("l_discount") == 0.1, 1).otherwise(0)).alias("packed"),
    )
    checked = aggregates.reconcile_quantities(lines, packed, "l_orderkey", "l_partkey", "qty", "packed")
    keys = t.orders.select(F.col("o_orderkey").alias("l_orderkey"))
    return aggregates.reconcile_keys(keys, checked, "l_orderkey").withColumns(
        {c: F.col(c).cast("int") for c in ("full_match", "line_match")}
    )


@query(
    "timeseries_report",
    """
    WITH m AS (SELECT event_type, CAST(ts AS DATE) AS day, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n
               FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-02-05'
               GROUP BY ALL HAVING count(*) > 65)
    SELECT k.event_type, strftime(d.day, '%Y-%m-%d') AS day, coalesce(total, 0) AS total, coalesce(n, 0) AS n
    FROM (SELECT DISTINCT event_type FROM m) k
    CROSS JOIN (SELECT CAST(range AS DATE) AS day FROM range(DATE '2024-01-05', DATE '2024-02-06', INTERVAL 1 DAY)) d
    LEFT JOIN m ON m.event_type = k.event_type AND m.day = d.day
    """,
)
def timeseries_report(t: Tables) -> DataFrame:
    report = aggregates.timeseries_report(
        t.events,
        ["event_type"],
        F.col("ts"),
        {"total": F.sum(cents(F.col("value"))).cast("double"), "n": F.count(F.lit(1))},
        date(2024, 1, 5),
        date(2024, 2, 5),
        "n > 65",
    )
    return report.withColumn("day", day_text("day"))


@query(
    "profile",
    """
    SELECT 'o_orderstatus' AS "column", count(*) AS height, count(DISTINCT o_orderstatus) AS n_unique,
           min(o_orderstatus) AS lowest, max(o_orderstatus) AS highest FROM orders
    UNION ALL SELECT 'o_orderpriority', count(*), count(DISTINCT o_orderpriority), min(o_orderpriority), max(o_orderpriority) FROM orders
    UNION ALL SELECT 'o_custkey', count(*), count(DISTINCT o_custkey), CAST(min(o_custkey) AS VARCHAR), CAST(max(o_custkey) AS VARCHAR) FROM orders
    """,
)
def profile(t: Tables) -> DataFrame:
    return aggregates.profile(t.orders, ["o_orderstatus", "o_orderpriority", "o_custkey"])


@query(
    "bucket_counts",
    "SELECT o_orderstatus, count(*) AS n, count(DISTINCT o_custkey) AS n_keys FROM orders GROUP BY o_orderstatus",
)
def bucket_counts(t: Tables) -> DataFrame:
    return aggregates.bucket_counts(t.orders, "o_orderstatus", "o_custkey")


@query(
    "grouped_counts",
    """
    SELECT o_custkey, count(*) AS orders, count(nullif(o_orderstatus, 'O')) AS closed,
           count(DISTINCT o_orderpriority) AS priorities,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY o_custkey
    """,
)
def grouped_counts(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count(F.nullif(F.col("o_orderstatus"), F.lit("O"))).alias("closed"),
        F.count_distinct("o_orderpriority").alias("priorities"),
        F.sum(cents(F.col("o_totalprice"))).cast("double").alias("total"),
    )


@query(
    "age_days",
    """
    SELECT o_orderkey, CAST(floor(epoch(TIMESTAMP '2001-08-01 12:00:00' - o_orderdate) / 86400) AS BIGINT) AS days
    FROM orders
    """,
)
def age_days(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", dates.age_days(F.col("o_orderdate"), datetime(2001, 8, 1, 12)).alias("days")
    )


@query(
    "top1_status",
    """
    SELECT o_custkey, o_orderkey, o_orderstatus FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey
        ORDER BY CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN 2 ELSE 6 END, o_orderkey) AS rn FROM orders)
    WHERE rn = 1
    """,
)
def top1_status(t: Tables) -> DataFrame:
    ranked = t.orders.select(
        "o_custkey", "o_orderkey", "o_orderstatus",
        p.decode(F.col("o_orderstatus"), {"F": 1, "P": 2}, 6).alias("_rank"),
    )
    return windows.top1(ranked, ["o_custkey"], ["_rank", "o_orderkey"]).drop("_rank")


@query(
    "last_unless_default",
    """
    WITH n AS (SELECT l_orderkey, l_returnflag,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS rn,
        lead(l_returnflag) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS prev
      FROM lineitem)
    SELECT l_orderkey, CASE WHEN l_returnflag = 'N' THEN coalesce(prev, l_returnflag) ELSE l_returnflag END AS chosen
    FROM n WHERE rn = 1
    """,
)
def last_unless_default(t: Tables) -> DataFrame:
    lines = t.lineitem.select(*LINE_KEY, "l_returnflag")
    return windows.last_unless_default(
        lines, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], "l_returnflag", "N"
    )


@query(
    "lines_per_ref",
    """
    WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        replace(replace('R' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(1 + l_linenumber % 2 AS VARCHAR), '-1', ''), '-2', '') AS ref
      FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ref, count(ref) OVER (PARTITION BY ref) AS lines FROM r
    """,
)
def lines_per_ref(t: Tables) -> DataFrame:
    suffix = (1 + F.col("l_linenumber") % 2).cast("string")
    ref = text.normalize_ref(text.join_text("R", F.col("l_orderkey").cast("string"), "-", suffix))
    return windows.with_group_total(
        t.lineitem.select(*LINE_KEY, ref.alias("ref")), ["ref"], {"lines": F.count("ref")}
    )


@query(
    "wide_lookup_two_roles",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, c.n_name AS ship_to, s.n_name AS bill_to
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation c ON c_nationkey = c.n_nationkey JOIN nation s ON s_nationkey = s.n_nationkey
    """,
)
def wide_lookup_two_roles(t: Tables) -> DataFrame:
    return joins.enrich(
        t.lineitem.select(*LINE_KEY),
        [
            Lookup(t.orders, {"l_orderkey": "o_orderkey"}, {"_c": "o_custkey"}, "inner"),
            Lookup(t.customer, {"_c": "c_custkey"}, {"_cn": "c_nationkey"}, "inner"),
            Lookup(t.supplier, {"l_suppkey": "s_suppkey"}, {"_sn": "s_nationkey"}, "inner"),
            Lookup(t.nation, {"_cn": "n_nationkey"}, {"ship_to": "n_name"}, "inner"),
            Lookup(t.nation, {"_sn": "n_nationkey"}, {"bill_to": "n_name"}, "inner"),
        ],
    ).select(*LINE_KEY, "ship_to", "bill_to")
