"""Column functions over whole tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from opsflow.catalog.base import Tables, day_text, query, time_text
from opsflow.functions import dates, nested as nf, numbers, text
from opsflow.functions.fixed import US_STATES
from opsflow.operators.joins import Lookup, enrich


@query(
    "strings_refs",
    """
    SELECT o_orderkey,
      replace(replace(replace(CAST(o_orderkey AS VARCHAR) || '-' || CAST(o_custkey AS VARCHAR), '-1', ''), '-2', ''), '-3', '') AS anywhere,
      regexp_replace(CAST(o_orderkey AS VARCHAR) || '-' || CAST(o_custkey % 5 AS VARCHAR), '(-1|-2|-3)$', '') AS at_end,
      CASE WHEN regexp_matches(t, '^[^0-9]') AND length(t) > 0 THEN substr(t, 2) ELSE t END AS tracking,
      upper(rtrim(o_orderpriority || '  ')) AS code, length(rtrim(o_orderpriority || '  ')) AS len,
      left(o_orderpriority, 3) AS l3, right(o_orderpriority, 3) AS r3
    FROM (SELECT *, trim(replace(CASE WHEN o_orderkey % 2 = 0 THEN 'PRO ' ELSE 'x' END || CAST(o_orderkey AS VARCHAR) || ' ', 'PRO ', '')) AS t FROM orders)
    """,
)
def strings_refs(t: Tables) -> DataFrame:
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey")
    prefix = F.when(F.col("o_orderkey") % 2 == 0, "PRO ").otherwise("x")
    padded = F.concat(F.col("o_orderpriority"), F.lit("  "))
    return t.orders.select(
        "o_orderkey",
        text.normalize_ref(text.join_text(key, "-", cust.cast("string"))).alias("anywhere"),
        text.normalize_ref(text.join_text(key, "-", (cust % 5).cast("string")), suffix_only=True).alias("at_end"),
        text.clean_tracking(F.concat(prefix, key, F.lit(" ")), ["PRO "]).alias("tracking"),
        text.key_text(padded).alias("code"),
        text.text_length(padded).alias("len"),
        F.left("o_orderpriority", F.lit(3)).alias("l3"),
        F.right("o_orderpriority", F.lit(3)).alias("r3"),
    )


@query(
    "strings_names",
    """
    SELECT p_partkey, split_part(p_name, ' ', 1) AS first_name,
      CASE WHEN position(' ' IN p_name) > 0 THEN substr(p_name, position(' ' IN p_name) + 1) END AS last_name,
      CASE WHEN position(' ' IN p_type) > 0 THEN 'x' ELSE '' END AS strict_first, p_type AS strict_last,
      CASE WHEN p_size % 5 = 0 THEN p_name ELSE p_name || ' ' || p_brand END AS lines,
      CASE WHEN p_size % 2 = 0 THEN '+1' || p_brand ELSE p_brand END AS phone,
      replace('+1' || p_brand, '+', '') AS plain, p_name AS first_mail,
      CASE WHEN p_size = 1 THEN 'USA' ELSE 'CA' END AS iso3,
      CASE WHEN p_size = 1 THEN 'United States' ELSE 'CA' END AS country,
      p_name AS stripped, p_partkey AS parsed_id, nullif(p_type, 'SMALL') AS not_small,
      coalesce(nullif(p_type, 'SMALL'), '') AS or_blank, p_brand AS login,
      left(p_name || ' & <b>', 12) AS cut
    FROM part
    """,
)
def strings_names(t: Tables) -> DataFrame:
    name, size, brand = F.col("p_name"), F.col("p_size"), F.col("p_brand")
    country = F.when(size == 1, "US").otherwise("CA")
    with_id = F.concat(name, F.lit(" ("), F.col("p_partkey").cast("string"), F.lit(") "))
    not_small = F.nullif(F.col("p_type"), F.lit("SMALL"))
    return t.part.select(
        "p_partkey",
        text.first_name(name).alias("first_name"),
        text.last_name(name).alias("last_name"),
        text.first_name_strict(F.concat(F.lit(" "), F.col("p_type"))).alias("strict_first"),
        text.last_name_strict(F.concat(F.lit(" "), F.col("p_type"))).alias("strict_last"),
        text.join_lines(name, F.when(size % 5 != 0, brand)).alias("lines"),
        text.phone_with_prefix(brand, F.when(size % 2 == 0, "US").otherwise("DE")).alias("phone"),
        text.plain_phone(F.concat(F.lit("+1"), brand)).alias("plain"),
        text.first_of_list(F.concat(name, F.lit(";"), brand)).alias("first_mail"),
        text.country_iso3(country).alias("iso3"),
        text.country_name(country).alias("country"),
        text.strip_trailing_id(with_id).alias("stripped"),
        text.trailing_id(with_id).alias("parsed_id"),
        not_small.alias("not_small"),
        text.null_to_blank(not_small).alias("or_blank"),
        text.user_name(F.concat(F.lit("corp\\"), brand), "corp").alias("login"),
        F.left(F.concat(name, F.lit(" & <b>")), F.lit(12)).alias("cut"),
    )


@query(
    "strings_markup",
    """
    SELECT page_id, replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS escaped,
           length(html) AS n, CASE WHEN url ILIKE '%/FR/%' THEN 1 ELSE 0 END AS french
    FROM pages
    """,
)
def strings_markup(t: Tables) -> DataFrame:
    return t.pages.select(
        "page_id",
        text.markup_text(F.col("html")).alias("escaped"),
        F.length("html").alias("n"),
        F.when(F.col("url").ilike("%/FR/%"), 1).otherwise(0).alias("french"),
    )


@query(
    "dates_parsed",
    """
    SELECT event_id,
      CASE WHEN event_id % 3 = 2 THEN NULL ELSE strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') END AS parsed,
      strftime(date_trunc('second', ts) + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS in_utc,
      strftime(date_trunc('second', ts) - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS new_york
    FROM events
    """,
)
def dates_parsed(t: Tables) -> DataFrame:
    kind = F.col("event_id") % 3
    body = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    iso = F.when(kind == 0, F.concat(body, F.lit("Z"))).when(kind == 1, F.concat(body, F.lit(".000Z"))).otherwise(F.lit(" "))
    return t.events.select(
        "event_id",
        time_text(dates.parse_first(iso)).alias("parsed"),
        time_text(dates.wall_clock(F.concat(body, F.lit("-05:00")), "UTC")).alias("in_utc"),
        time_text(dates.shift_zone(F.col("ts"), "UTC", "America/New_York")).alias("new_york"),
    )


@query(
    "dates_windows",
    """
    SELECT o_orderkey, strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') AS week,
      strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month,
      strftime(last_day(o_orderdate), '%Y-%m-%d') AS month_end,
      strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS year,
      strftime(o_orderdate + INTERVAL 4 HOUR, '%m/%d/%Y %H:%M:%S') AS shown,
      CASE WHEN o_orderdate >= TIMESTAMP '2001-12-15' - INTERVAL 200 DAY THEN 1 ELSE 0 END AS recent
    FROM orders
    """,
)
def dates_windows(t: Tables) -> DataFrame:
    day = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        day_text(F.date_trunc("week", day)).alias("week"),
        day_text(F.date_trunc("month", day)).alias("month"),
        day_text(F.last_day(day)).alias("month_end"),
        day_text(F.date_trunc("year", day)).alias("year"),
        F.date_format(day + F.expr("INTERVAL 4 HOURS"), "MM/dd/yyyy HH:mm:ss").alias("shown"),
        F.when(day >= dates.before(datetime(2001, 12, 15), "200 DAYS"), 1).otherwise(0).alias("recent"),
    )


@query(
    "json_values",
    """
    SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(json_extract_string(props, '$.k') AS INT) AS k_int,
      'none' AS missing, event_type AS wrapped,
      CASE event_type WHEN 'click' THEN 'Click' WHEN 'view' THEN 'View' ELSE 'other' END AS label
    FROM events
    """,
)
def json_values(t: Tables) -> DataFrame:
    bag = F.from_json("props", "map<string,string>")
    boxed = nf.wrap(kind=F.col("event_type"))
    return t.events.select(
        "event_id",
        nf.json_value(F.col("props"), "$.k").alias("k"),
        numbers.text_to_int(nf.property_or(bag, "k")).alias("k_int"),
        nf.property_or(bag, "absent", "none").alias("missing"),
        nf.unwrap(boxed["kind"]).alias("wrapped"),
        nf.lookup(F.col("event_type"), {"click": "Click", "view": "View"}, "other").alias("label"),
    )


@query(
    "json_arrays",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN 0 ELSE o_orderkey % 4 + 1 END AS n,
      CASE o_orderkey % 4 WHEN 3 THEN NULL WHEN 0 THEN 0 ELSE 1 END AS second_or_only,
      '["' || CASE WHEN o_orderpriority < o_orderstatus THEN o_orderpriority || '","' || o_orderstatus
                  ELSE o_orderstatus || '","' || o_orderpriority END || '"]' AS tags
    FROM orders
    """,
)
def json_arrays(t: Tables) -> DataFrame:
    size = (F.col("o_orderkey") % 4).cast("int")
    numbers_json = F.when(size == 3, F.lit("{broken")).otherwise(F.to_json(F.sequence(F.lit(0), size)))
    parsed = nf.parse_or_empty(numbers_json, "array<int>")
    return t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", parsed.alias("_a")).select(
        "o_orderkey",
        F.size("_a").alias("n"),
        nf.one_or_nth(F.col("_a"), F.lit(1)).alias("second_or_only"),
        F.to_json(nf.sorted_tags(F.col("o_orderstatus"), F.col("o_orderpriority"), F.lit(None).cast("string"))).alias("tags"),
    )


@query(
    "rows_to_json",
    """
    SELECT l_orderkey, '[' || string_agg('{"LineNbr":' || CAST(l_linenumber AS VARCHAR) || ',"Qty":' ||
             CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '}', ',' ORDER BY l_linenumber, l_partkey, l_suppkey) || ']' AS line_items
    FROM lineitem GROUP BY l_orderkey
    """,
)
def rows_to_json(t: Tables) -> DataFrame:
    from opsflow.operators.nested import collect_parts

    docs = collect_parts(
        t.lineitem, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"],
        F.struct(F.col("l_linenumber").alias("LineNbr"), F.col("l_quantity").cast("bigint").alias("Qty")), "rows",
    )
    return docs.select("l_orderkey", F.to_json("rows").alias("line_items"))


@query(
    "casts_and_prices",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(trunc(l_quantity / 3) AS INT) AS whole,
      CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS as_text,
      CAST(CAST(l_extendedprice AS DECIMAL(18,2)) + CAST(l_tax AS DECIMAL(18,2)) AS DOUBLE) AS price,
      CASE WHEN l_returnflag = 'N' THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS lenient,
      CAST(coalesce(l_discount, 0) AS DOUBLE) AS rounded
    FROM lineitem
    """,
)
def casts_and_prices(t: Tables) -> DataFrame:
    qty = F.col("l_quantity").cast("bigint").cast("string")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        numbers.whole(F.col("l_quantity") / 3).alias("whole"),
        qty.alias("as_text"),
        (numbers.money(F.col("l_extendedprice")) + numbers.money(F.col("l_tax"))).cast("double").alias("price"),
        numbers.lenient(F.when(F.col("l_returnflag") == "N", "n/a").otherwise(qty), "bigint", 0).alias("lenient"),
        numbers.lenient(F.col("l_discount"), "double", 0.0, 4).alias("rounded"),
    )


@query(
    "nested_compare",
    """
    SELECT c_custkey, CASE WHEN lower(c_mktsegment) = lower(n_name) THEN 0 ELSE 1 END AS differs, 'New York' AS state
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    """,
)
def nested_compare(t: Tables) -> DataFrame:
    wide = enrich(t.customer, [Lookup(t.nation, {"c_nationkey": "n_nationkey"}, {"_n": "n_name"}, "inner")])
    a = text.comparable(F.struct(F.array("c_mktsegment").alias("x")))
    b = text.comparable(F.struct(F.array("_n").alias("x")))
    return wide.select(
        "c_custkey", F.when(a == b, 0).otherwise(1).alias("differs"), nf.lookup(F.lit("NY"), US_STATES).alias("state")
    )
