"""URL filters by temporal list join, in DataFrame expressions only.

Block lists come as dated entries: from a day on, an entry (a host, a domain, or a
host with a path prefix) is on a list or off it again. Consecutive entries become
validity intervals ``[valid_from, valid_to)``, and every capture is judged against
the intervals that hold at its own fetch time (an as-of join).

A capture is looked up under a few candidate keys (its host, the host's parent
domains, its host with leading path segments, as many as the URL has), each by equality. Intervals are cut
into bins of ``bin_days`` and joined on (key, bin), so a host that holds a third of
all captures, or an entry that changes every day, is spread over its bins; the join
is an ordinary one that AQE can split further. Captures that agree in URL and time
are judged once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from opsflow.llm.base import query, table

OPEN_END = "9999-12-31"


def host_of(url: Column) -> Column:
    """Lower-case host: no scheme, user, port or trailing dot. Empty if there is none."""
    rest = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://([^/?#\s]*)", 1)
    return F.regexp_replace(F.regexp_replace(rest, r"^.*@", ""), r"(\.?:[0-9]*|\.)$", "")


def path_of(url: Column) -> Column:
    """The path without query and fragment."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\s]*([^?#\s]*)", 1)


#: Hosts that are addresses of version 4 or 6.
ADDRESS = r"^([0-9]+\.[0-9]+\.[0-9]+\.[0-9]+|\[.*)$"


def candidates(host: Column, path: Column) -> Column:
    """Keys under which a capture may be listed: host, its domains down to the last label, host with every path prefix.

    An address in place of a name (``10.0.0.1``, ``[::1]``) is in no domain.
    """
    labels = F.split(host, r"\.")
    count = F.size(labels)
    domains = F.transform(
        F.sequence(F.lit(1), count),
        lambda i: F.array_join(F.slice(labels, i, count), "."),
    )
    domains = F.when(host.rlike(ADDRESS), F.array(host)).otherwise(domains)
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    paths = F.transform(
        segments, lambda _, i: F.concat(host, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i + 1), "/"))
    )
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(domains, paths)))


def listed_key(key: Column) -> Column:
    """A list's key with its host in lower case; paths keep their case, as in URLs."""
    host = F.substring_index(key, "/", 1)
    return F.concat(F.lower(host), F.substr(key, F.length(host) + 1))


def intervals(entries: DataFrame) -> DataFrame:
    """Validity intervals ``list, key, valid_from, valid_to`` of dated entries.

    ``entries``: ``list, key, day, listed``. An entry holds until the next one of the
    same list and key; repeats of the same state are merged; of several on one day,
    ``listed`` wins. Entries without list, key, day or state are ignored. Hosts compare
    without case, paths with it.
    """
    daily = (
        entries.where("list IS NOT NULL AND key IS NOT NULL AND day IS NOT NULL AND listed IS NOT NULL")
        .groupBy("list", listed_key(F.col("key")).alias("key"), F.col("day").cast("date").alias("day"))
        .agg(F.max("listed").alias("listed"))
    )
    along = Window.partitionBy("list", "key").orderBy("day")
    return (
        daily.withColumn("_was", F.lag("listed").over(along))
        .where(F.col("_was").isNull() | (F.col("_was") != F.col("listed")))
        .withColumn("valid_to", F.coalesce(F.lead("day").over(along), F.lit(OPEN_END).cast("date")))
        .where("listed")
        .select("list", "key", F.col("day").alias("valid_from"), "valid_to")
    )


def judge(captures: DataFrame, entries: DataFrame, bin_days: int = 32) -> DataFrame:
    """One row per distinct capture: ``page_id, url, fetched_on, n_active, blocked, ...``.

    ``captures``: ``page_id, url, fetched_on`` (a date). ``n_active`` counts the list
    entries that hold for it at that time, ``lists`` names them, ``rule`` is the
    longest matching key and ``rule_from`` the day it came into force. A null or
    malformed URL has no host and is never blocked; a null fetch time matches
    nothing. Repeated captures give one row with their number in ``copies``. Empty
    lists block nothing; other columns of either table are ignored.
    """
    each = captures.groupBy("page_id", "url", F.col("fetched_on").cast("date").alias("fetched_on")).agg(
        F.count(F.lit(1)).alias("copies")
    )
    looked = each.withColumn("host", F.coalesce(host_of(F.col("url")), F.lit(""))).withColumn(
        "_keys", candidates(F.col("host"), F.coalesce(path_of(F.col("url")), F.lit("")))
    )
    day = lambda c: F.unix_date(F.col(c))
    span = looked.agg(
        F.floor(F.min(day("fetched_on")) / bin_days).alias("_low"), F.floor(F.max(day("fetched_on")) / bin_days).alias("_high")
    )
    binned = (
        intervals(entries)
        .join(F.broadcast(span))  # one row
        .withColumn("_low", F.greatest(F.col("_low"), F.floor(day("valid_from") / bin_days)))
        .withColumn("_high", F.least(F.col("_high"), F.floor((day("valid_to") - 1) / bin_days)))
        .where("_low <= _high")
        .select("list", "key", "valid_from", "valid_to", F.explode(F.sequence("_low", "_high")).alias("_bin"))
    )
    asked = looked.select(
        "page_id", "url", "fetched_on", "copies", "host",
        F.explode_outer("_keys").alias("key"), F.floor(day("fetched_on") / bin_days).alias("_bin"),
    )
    holds = (F.col("valid_from") <= F.col("fetched_on")) & (F.col("fetched_on") < F.col("valid_to"))
    joined = asked.alias("a").join(
        binned.alias("b"),
        (F.col("a.key") == F.col("b.key")) & (F.col("a._bin") == F.col("b._bin")) & holds,
        "left",
    )
    hit = F.when(F.col("b.key").isNotNull(), F.struct(F.length("a.key").alias("n"), F.col("a.key").alias("key"), F.col("valid_from").alias("since")))
    return (
        joined.groupBy("page_id", "url", "fetched_on", "copies", "host")
        .agg(
            F.count("b.key").alias("n_active"),
            F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"),
            F.max(hit).alias("_rule"),
        )
        .select(
            "page_id", "url", "fetched_on", "copies", "host", "n_active", (F.col("n_active") > 0).alias("blocked"), "lists",
            F.col("_rule.key").alias("rule"), F.col("_rule.since").alias("rule_from"),
        )
    )


def _hex(col: Column, start: int) -> Column:
    return F.conv(F.substring(F.md5(col), start, 4), 16, 10).cast("int")


def dated_lists(pages: DataFrame) -> DataFrame:
    """Dated list entries over the hosts and paths that ``pages`` holds.

    The tables hold no lists, so days and states are drawn from the key's digest:
    about a quarter of the hosts, an eighth of the parent domains and a quarter of
    the path prefixes are listed during 2024, half of them are taken off again, and
    some of these return.
    """
    host, path = F.coalesce(host_of(F.col("url")), F.lit("")), F.coalesce(path_of(F.col("url")), F.lit(""))
    keys = pages.select(host.alias("host"), path.alias("path")).where("host <> ''").select(
        F.explode(
            F.array(
                F.struct(F.lit("hosts").alias("list"), F.col("host").alias("key")),
                F.struct(F.lit("domains").alias("list"), F.regexp_replace("host", r"^[^.]*\.", "").alias("key")),
                F.struct(
                    F.lit("paths").alias("list"),
                    F.concat_ws("/", "host", F.get(F.filter(F.split("path", "/"), lambda s: s != ""), F.lit(0))).alias("key"),
                ),
            )
        ).alias("e")
    ).select("e.list", "e.key").distinct()
    keyed = keys.withColumn("_of", F.concat_ws("|", "list", "key"))
    start = F.lit("2024-01-01").cast("date")
    first, length, back = _hex(F.col("_of"), 1) % 366, _hex(F.col("_of"), 5) % 120 + 1, _hex(F.col("_of"), 9) % 60 + 1
    pick = _hex(F.col("_of"), 13) % 8
    chosen = keyed.where(F.when(F.col("list") == "domains", pick == 0).otherwise(pick < 2))
    events = F.array(
        F.struct(F.date_add(start, first).alias("day"), F.lit(True).alias("listed")),
        F.when(_hex(F.col("_of"), 17) % 2 == 0, F.struct(F.date_add(start, first + length).alias("day"), F.lit(False).alias("listed"))),
        F.when(
            (_hex(F.col("_of"), 17) % 4 == 0),
            F.struct(F.date_add(start, first + length + back).alias("day"), F.lit(True).alias("listed")),
        ),
    )
    return chosen.select("list", "key", F.explode(F.filter(events, lambda e: e.isNotNull())).alias("e")).select(
        "list", "key", "e.day", "e.listed"
    )


SQL = r"""
WITH c AS (
  SELECT page_id, url,
         DATE '2024-01-01' + (('0x' || substr(md5(url), 1, 4))::INT % 366)::INT AS fetched_on,
         regexp_replace(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://([^/?#\s]*)', 1), '^.*@', ''),
                        '(\.?:[0-9]*|\.)$', '') AS host,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\s]*([^?#\s]*)', 1), '/'),
                     lambda x: x <> '') AS seg
  FROM pages),
u AS (SELECT page_id, url, fetched_on, host, any_value(seg) AS seg, count(*) AS copies FROM c GROUP BY 1, 2, 3, 4),
k AS (
  SELECT 'hosts' AS list, host AS key FROM c WHERE host <> '' UNION
  SELECT 'domains', regexp_replace(host, '^[^.]*\.', '') FROM c WHERE host <> '' UNION
  SELECT 'paths', CASE WHEN len(seg) > 0 THEN host || '/' || seg[1] ELSE host END FROM c WHERE host <> ''),
h AS (SELECT list, key, md5(list || '|' || key) AS m FROM k),
x AS (
  SELECT list, key, ('0x' || substr(m, 1, 4))::INT % 366 AS a, ('0x' || substr(m, 5, 4))::INT % 120 + 1 AS b,
         ('0x' || substr(m, 9, 4))::INT % 60 + 1 AS r, ('0x' || substr(m, 13, 4))::INT % 8 AS pick,
         ('0x' || substr(m, 17, 4))::INT AS q FROM h),
l AS (SELECT *, DATE '2024-01-01' AS d0 FROM x WHERE CASE WHEN list = 'domains' THEN pick = 0 ELSE pick < 2 END),
i AS (
  SELECT list, key, d0 + a::INT AS f, CASE WHEN q % 2 = 0 THEN d0 + (a + b)::INT ELSE DATE '9999-12-31' END AS t FROM l
  UNION ALL SELECT list, key, d0 + (a + b + r)::INT, DATE '9999-12-31' FROM l WHERE q % 4 = 0),
p AS (
  SELECT page_id, url, fetched_on, host, copies, seg, string_split(host, '.') AS lab FROM u),
a AS (
  SELECT DISTINCT page_id, url, fetched_on, array_to_string(lab[n:], '.') AS key
  FROM (SELECT *, unnest(range(1, len(lab) + 1)) AS n FROM p)
  WHERE host <> '' AND (n = 1 OR NOT regexp_matches(host, '^([0-9]+\.[0-9]+\.[0-9]+\.[0-9]+|\[.*)$'))
  UNION SELECT page_id, url, fetched_on, host || '/' || array_to_string(seg[:n], '/')
  FROM (SELECT *, unnest(range(1, len(seg) + 1)) AS n FROM p) WHERE host <> ''),
m AS (SELECT a.*, i.list, i.f FROM a JOIN i ON a.key = i.key AND i.f <= a.fetched_on AND a.fetched_on < i.t),
g AS (
  SELECT page_id, url, fetched_on, count(*) AS n, array_to_string(list_sort(list(DISTINCT list)), ',') AS lists,
         max({'n': length(key), 'key': key, 'since': f}) AS top
  FROM m GROUP BY 1, 2, 3)
SELECT u.page_id, u.url, u.fetched_on, u.copies, u.host, coalesce(g.n, 0) AS n_active, coalesce(g.n, 0) > 0 AS blocked,
       coalesce(g.lists, '') AS lists, g.top.key AS rule, g.top.since AS rule_from
FROM u LEFT JOIN g ON u.page_id = g.page_id AND u.url = g.url AND u.fetched_on = g.fetched_on
"""


@query("op7_url_filters", SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    # the tables hold no fetch times: a day of 2024 from the URL's digest
    captures = pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), _hex(F.col("url"), 1) % 366).alias("fetched_on"))
    return judge(captures, dated_lists(pages))
