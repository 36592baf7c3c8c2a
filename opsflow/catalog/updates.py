"""Change detection, keyed writes, sources and sinks, streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from opsflow import sources
from opsflow.catalog.base import LINE_KEY, Tables, cents, day_text, flag, query, time_text
from opsflow.functions import predicates as p, text
from opsflow.operators import changes, joins, tables
from opsflow.operators.joins import Lookup
from opsflow.operators.tables import TableSpec
from opsflow.session import scratch
from opsflow.streaming import (
    activity_windows,
    compact,
    current_state,
    dedupe_stream,
    file_stream,
    fold_windows,
    session_counts,
    sync_stream,
    unseen,
    window_state,
)

AS_OF = datetime(2024, 1, 31)


# -- change detection ------------------------------------------------------

DIFF = """
    WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price, o_orderdate AS ts FROM orders WHERE o_orderkey % 11 <> 0),
    n AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey,
             CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS price,
             o_orderdate + INTERVAL 1 DAY AS ts FROM orders WHERE o_orderkey % 13 <> 0)
"""


def old_new(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Orders before and after a sync: some are new, some gone, some changed."""
    key = F.col("o_orderkey")
    price = cents(F.col("o_totalprice"))
    old = t.orders.where(key % 11 != 0).select(
        "o_orderkey", "o_custkey", price.alias("price"), F.col("o_orderdate").alias("ts")
    )
    new = t.orders.where(key % 13 != 0).select(
        "o_orderkey",
        F.when(key % 5 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")).alias("o_custkey"),
        (price + F.when(key % 7 == 0, 1).otherwise(0)).cast("decimal(18,2)").alias("price"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("ts"),
    )
    return old, new


DIFF_LOG_SQL = (
    DIFF
    + """
    SELECT n.o_orderkey, strftime(o.ts, '%Y-%m-%d') AS last_ts, strftime(n.ts, '%Y-%m-%d') AS current_ts,
      o.o_custkey AS o_custkey_last, n.o_custkey AS o_custkey_current,
      CAST(o.price AS DOUBLE) AS price_last, CAST(n.price AS DOUBLE) AS price_current,
      CASE WHEN o.o_custkey <> n.o_custkey OR o.price <> n.price THEN 1 ELSE 0 END AS diff
    FROM o JOIN n USING (o_orderkey)
    """
)


@query("metric_diff_log", DIFF_LOG_SQL)
def metric_diff_log(t: Tables) -> DataFrame:
    return shown_log(changes.metric_diff(*old_new(t), ["o_orderkey"], ["o_custkey", "price"], "ts")[0])


@query("metric_diff_tagged", DIFF_LOG_SQL)
def metric_diff_tagged(t: Tables) -> DataFrame:
    """The same log by a tagged union and one aggregate per key."""
    return shown_log(changes.metric_diff(*old_new(t), ["o_orderkey"], ["o_custkey", "price"], "ts", changes.tagged_diff)[0])


def shown_log(log: DataFrame) -> DataFrame:
    return log.withColumns(
        {
            "last_ts": day_text("last_ts"),
            "current_ts": day_text("current_ts"),
            "price_last": F.col("price_last").cast("double"),
            "price_current": F.col("price_current").cast("double"),
            "diff": flag(F.col("diff")),
        }
    )


@query(
    "metric_diff_writes",
    DIFF
    + """
    SELECT n.o_orderkey, n.o_custkey, CAST(n.price AS DOUBLE) AS price FROM n LEFT JOIN o USING (o_orderkey)
    WHERE o.o_orderkey IS NULL OR o.o_custkey <> n.o_custkey OR o.price <> n.price
    """,
)
def metric_diff_writes(t: Tables) -> DataFrame:
    _, writes = changes.metric_diff(*old_new(t), ["o_orderkey"], ["o_custkey", "price"], "ts")
    return writes.select("o_orderkey", "o_custkey", F.col("price").cast("double").alias("price"))


@query(
    "changed_blocks",
    """
    SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name || 'x' END AS name,
           CASE WHEN c_custkey % 4 = 0 THEN 'tag' END AS tag FROM customer
    WHERE c_custkey % 3 = 0 OR c_custkey % 4 = 0
    """,
)
def changed_blocks(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    old = t.customer.select(
        "c_custkey", F.array(F.struct(F.col("c_name").alias("name"))).alias("customers"), F.array("c_mktsegment").alias("tags")
    )
    name = F.when(key % 3 == 0, F.concat("c_name", F.lit("x"))).otherwise(F.lower("c_name"))
    tags = F.when(key % 4 == 0, F.array(F.lit("tag"))).when(key % 4 == 1, F.array(F.lower("c_mktsegment")))
    new = t.customer.select("c_custkey", F.array(F.struct(name.alias("name"))).alias("customers"), tags.alias("tags"))
    changed = changes.changed_blocks(old, new, ["c_custkey"], ["customers", "tags"])
    return changed.select(
        "c_custkey",
        F.get("customers", F.lit(0))["name"].alias("name"),
        F.get("tags", F.lit(0)).alias("tag"),
    )


@query(
    "changed_payloads",
    """
    SELECT doc_id, CASE WHEN EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) THEN 1 ELSE 0 END AS known
    FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
       OR EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 0)
    """,
)
def changed_payloads(t: Tables) -> DataFrame:
    documents = t.documents.select("doc_id", "text")
    good = F.col("quality") == 1
    ledger = documents.join(t.labels, "doc_id").select(
        "doc_id", F.when(good, F.col("text")).otherwise(F.concat("text", F.lit("!"))).alias("text")
    )
    sent = changes.changed_payloads(documents, ledger, ["doc_id"], "text").select("doc_id")
    return joins.enrich(sent, [Lookup(t.labels, {"doc_id": "doc_id"}, {"_q": "quality"})]).select(
        "doc_id", F.when(F.col("_q").isNotNull(), 1).otherwise(0).alias("known")
    )


@query(
    "resolve_status_conflicts",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_linestatus) > 1)
      AND l_linestatus <> o_orderstatus
    """,
)
def resolve_status_conflicts(t: Tables) -> DataFrame:
    copy = t.lineitem.select(*LINE_KEY, "l_linestatus")
    rank = p.first_match([(F.col("l_linestatus") == "F", 1)], 6)
    conflicts = joins.ranked_conflicts(copy, "l_orderkey", "l_linestatus", rank)
    truth = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("l_linestatus"))
    return changes.resolve_status_conflicts(copy, conflicts, truth, "l_orderkey", "l_linestatus")


@query(
    "capture_deletes",
    """
    SELECT o_orderkey, c_name AS deleted_by, '2024-01-31' AS deleted_at FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    WHERE o_orderkey % 9 = 0 AND o_orderstatus <> 'P'
    """,
)
def capture_deletes(t: Tables) -> DataFrame:
    previous = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    current = previous.where(F.col("o_orderkey") % 9 != 0)
    gone = changes.capture_deletes(
        previous, current, ["o_orderkey"], F.col("o_orderstatus") != "P",
        Lookup(t.customer, {"o_custkey": "c_custkey"}, {"deleted_by": "c_name"}), F.lit(AS_OF),
    )
    return gone.select("o_orderkey", "deleted_by", day_text("deleted_at").alias("deleted_at"))


@query(
    "delete_by_keys",
    """
    SELECT CASE WHEN o_orderkey IS NULL THEN 'stays' ELSE 'goes' END AS fate, l_linenumber, count(*) AS n, sum(l_partkey) AS parts
    FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '5-LOW') ON l_orderkey = o_orderkey
      AND l_linenumber = 1 + o_orderkey % 3
    GROUP BY ALL
    """,
)
def delete_by_keys(t: Tables) -> DataFrame:
    tombstones = t.orders.where(F.col("o_orderpriority") == "5-LOW").select(
        F.col("o_orderkey").alias("l_orderkey"), (1 + F.col("o_orderkey") % 3).cast("int").alias("l_linenumber")
    )
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    stays, goes = changes.delete_by_keys(lines, tombstones, ["l_orderkey", "l_linenumber"])
    both = stays.withColumn("fate", F.lit("stays")).unionByName(goes.withColumn("fate", F.lit("goes")))
    return both.groupBy("fate", "l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_partkey").alias("parts")
    )


@query(
    "delete_where",
    "SELECT o_orderkey FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')",
)
def delete_where(t: Tables) -> DataFrame:
    doomed = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    return changes.delete_where(t.orders, doomed).select("o_orderkey")


@query(
    "field_changes",
    """
    WITH c AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE upper(c_name) END AS n2,
                 c_mktsegment AS s1, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS s2 FROM customer)
    SELECT c_custkey, 'name' AS field, c_name AS old, n2 AS new FROM c WHERE c_name <> n2
    UNION ALL SELECT c_custkey, 'segment', s1, s2 FROM c WHERE s2 IS NULL
    """,
)
def field_changes(t: Tables) -> DataFrame:
    key, name = F.col("c_custkey"), F.col("c_name")
    fields = {
        "name": (name, F.when(key % 2 == 0, name).otherwise(F.upper(name))),
        "segment": (F.col("c_mktsegment"), F.when(key % 3 != 0, F.col("c_mktsegment"))),
    }
    return changes.field_changes(t.customer, fields).select("c_custkey", "field", "old", "new")


@query(
    "attribute_updates",
    """
    SELECT s_suppkey, field_name, CASE field_name WHEN 'LINK' THEN 'rma/' || CAST(c_custkey AS VARCHAR) ELSE CAST(c_custkey AS VARCHAR) END AS value_string
    FROM (SELECT s_suppkey, 'LINK' AS field_name FROM supplier UNION ALL SELECT s_suppkey, 'ID' FROM supplier WHERE s_acctbal > 5000)
    JOIN customer ON s_suppkey = c_custkey
    """,
)
def attribute_updates(t: Tables) -> DataFrame:
    wanted = t.supplier.select("s_suppkey", F.lit("LINK").alias("field_name")).unionByName(
        t.supplier.where(F.col("s_acctbal") > 5000).select("s_suppkey", F.lit("ID").alias("field_name"))
    )
    number = F.col("c_custkey").cast("string")
    updates = changes.attribute_updates(
        wanted, t.customer.select("c_custkey"), {"s_suppkey": "c_custkey"},
        {"LINK": text.join_text("rma/", number), "ID": number},
    )
    return updates.select("s_suppkey", "field_name", "value_string")


# -- keyed tables ----------------------------------------------------------

CUSTOMER_ORDERS = TableSpec(
    "customer_orders",
    "custkey BIGINT, status STRING, price DOUBLE, first_order BIGINT",
    keys=("custkey",),
    insert_only=("first_order",),
)
UPSERT_SQL = """
    WITH u AS (SELECT o_custkey AS custkey, o_orderstatus AS status, o_totalprice AS price, o_orderkey AS first_order,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS up,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS down
      FROM orders WHERE o_orderstatus <> 'P'),
    l AS (SELECT a.custkey, a.status, a.price, b.first_order FROM u a JOIN u b ON a.custkey = b.custkey AND a.down = 1 AND b.up = 1),
    t AS (SELECT c_custkey AS custkey, 'new' AS status, c_acctbal AS price, -c_custkey AS first_order FROM customer WHERE c_custkey % 2 = 0)
    SELECT coalesce(l.custkey, t.custkey) AS custkey, coalesce(l.status, t.status) AS status,
           coalesce(l.price, t.price) AS price, coalesce(t.first_order, l.first_order) AS first_order
    FROM t FULL JOIN l ON t.custkey = l.custkey
"""


def target_and_updates(t: Tables) -> tuple[DataFrame, DataFrame]:
    target = t.customer.where(F.col("c_custkey") % 2 == 0).select(
        F.col("c_custkey").alias("custkey"), F.lit("new").alias("status"),
        F.col("c_acctbal").alias("price"), (-F.col("c_custkey")).alias("first_order"),
    )
    updates = t.orders.where(F.col("o_orderstatus") != "P").select(
        F.col("o_custkey").alias("custkey"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"),
        F.col("o_orderkey").alias("first_order"), "o_orderdate", "o_orderkey",
    )
    return target, updates


@query("upsert", UPSERT_SQL)
def upsert(t: Tables) -> DataFrame:
    return tables.upsert(*target_and_updates(t), CUSTOMER_ORDERS, ["o_orderdate", "o_orderkey"])


@query("upsert_by_fold", UPSERT_SQL)
def upsert_by_fold(t: Tables) -> DataFrame:
    target, updates = target_and_updates(t)
    start = target.withColumns(
        {"o_orderdate": F.lit(datetime(1900, 1, 1)).cast("timestamp_ntz"), "o_orderkey": F.lit(-1).cast("bigint")}
    )
    return tables.fold(start.unionByName(updates), CUSTOMER_ORDERS, ["o_orderdate", "o_orderkey"])


@query("conform", "SELECT c_custkey AS custkey, 'x' AS status, c_acctbal AS price, NULL::BIGINT AS first_order FROM customer")
def conform(t: Tables) -> DataFrame:
    loose = t.customer.select(
        F.lit("ignored").alias("extra"), F.col("c_acctbal").cast("string").alias("price"),
        F.col("c_custkey").cast("int").alias("custkey"), F.lit("x").alias("status"), F.lit(None).alias("first_order"),
    )
    return tables.conform(loose, CUSTOMER_ORDERS)


@query(
    "ledger_round_trip",
    """
    SELECT doc_id, lang FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND NOT (lang = 'en')
    """,
)
def ledger_round_trip(t: Tables) -> DataFrame:
    """Send what the ledger lacks, write the ledger, then find what is left."""
    path = scratch(t.spark, "ledger")
    documents = t.documents.select("doc_id", "lang")
    t.labels.select("doc_id").write.parquet(path)
    first = joins.not_in_ledger(documents, t.spark.read.parquet(path), ["doc_id"])
    sources.append(first.where(F.col("lang") == "en").select("doc_id"), path)
    return joins.not_in_ledger(documents, t.spark.read.schema("doc_id BIGINT").parquet(path), ["doc_id"])


SNAPSHOT = TableSpec("tracking", "rep BIGINT, n BIGINT, snapshot_at TIMESTAMP_NTZ", keys=("rep",))


@query(
    "snapshot_and_state",
    """
    WITH w1 AS (SELECT user_id AS rep, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-15' AND user_id % 2 = 0 GROUP BY 1),
    w2 AS (SELECT user_id AS rep, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND user_id % 3 = 0 GROUP BY 1)
    SELECT 'history' AS kind, rep, n FROM w1 UNION ALL SELECT 'history', rep, n FROM w2
    UNION ALL SELECT 'state', coalesce(w2.rep, w1.rep), coalesce(w2.n, w1.n) FROM w1 FULL JOIN w2 ON w1.rep = w2.rep
    """,
)
def snapshot_and_state(t: Tables) -> DataFrame:
    """Two snapshots: both stay in the history, the state keeps the newer one."""
    history = scratch(t.spark, "history")
    cut = F.lit(datetime(2024, 1, 15)).cast("timestamp_ntz")
    state = t.spark.createDataFrame([], SNAPSHOT.schema)
    parts = [
        ((F.col("ts") < cut) & (F.col("user_id") % 2 == 0), datetime(2024, 1, 15)),
        ((F.col("ts") >= cut) & (F.col("user_id") % 3 == 0), datetime(2024, 1, 31)),
    ]
    for condition, at in parts:
        shot = t.events.where(condition).groupBy(F.col("user_id").alias("rep")).agg(
            F.count(F.lit(1)).alias("n")
        )
        state = tables.write_snapshot(shot, at, history, state, SNAPSHOT, ["snapshot_at"])
    kept = t.spark.read.schema(SNAPSHOT.schema).parquet(history)
    return kept.select(F.lit("history").alias("kind"), "rep", "n").unionByName(
        state.select(F.lit("state").alias("kind"), "rep", "n")
    )


# -- sources and sinks -----------------------------------------------------

REPORT_SQL = """
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS report_date, 'Camp ' || o_orderstatus AS campaign_name, o_orderkey AS campaign_id,
           CASE WHEN o_orderkey % 10 = 1 THEN 0 ELSE o_custkey END AS clicks,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS cost
    FROM orders WHERE o_orderkey % 10 <> 0
"""


@query("report_scan", REPORT_SQL)
def report_scan(t: Tables) -> DataFrame:
    """Orders written as a ';' report with rollup rows and odd values, read back."""
    path = scratch(t.spark, "report")
    key = F.col("o_orderkey")
    t.orders.select(
        F.when(key % 10 == 0, " ").otherwise(day_text("o_orderdate")).alias("Day"),
        F.concat(F.lit("Camp "), "o_orderstatus", F.lit(" ("), key.cast("string"), F.lit(")")).alias("Campaign"),
        F.when(key % 10 == 1, "n/a").otherwise(F.col("o_custkey").cast("string")).alias("Clicks"),
        cents(F.col("o_totalprice")).cast("string").alias("AdvertiserCost"),
    ).write.option("sep", ";").option("header", True).csv(path)
    report = sources.scan_report(t.spark, path)
    named = sources.canonicalize(
        report,
        {
            "report_date": ["Day", "day", "date"],
            "campaign_raw": ["campaign", "Campaign", "campaignname"],
            "clicks": ["clicks", "Clicks"],
            "cost": ["advertisercost", "AdvertiserCost", "Cost"],
        },
        ["report_date", "campaign_raw", "clicks", "cost"],
    )
    cleaned = sources.safe_cast(
        sources.drop_rollups(named, "report_date"), {"clicks": ("bigint", 0, None), "cost": ("double", 0.0, 4)}
    )
    raw = F.col("campaign_raw")
    return cleaned.select(
        "report_date", text.strip_trailing_id(raw).alias("campaign_name"),
        text.trailing_id(raw).alias("campaign_id"), "clicks", "cost",
    )


@query("scan_pushdown", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 400000")
def scan_pushdown(t: Tables) -> DataFrame:
    return sources.scan(
        t.spark, f"{t.folder}/orders.parquet", ["o_orderkey", "o_totalprice"], F.col("o_totalprice") > 400000
    )


NAMED = sources.NamedQueries(
    {
        "orders_of_status": """
            SELECT o_orderkey, c_name FROM {orders} JOIN {customers} ON o_custkey = c_custkey
            WHERE o_orderstatus = :status AND o_totalprice >= :price
        """
    }
)


@query(
    "run_named",
    """
    SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderstatus = 'P' AND o_totalprice >= 250000
    """,
)
def run_named(t: Tables) -> DataFrame:
    return NAMED.run(
        t.spark, "orders_of_status", {"orders": t.orders, "customers": t.customer}, {"status": "P", "price": 250000}
    )


@query("json_round_trip", "SELECT conv_id, count(*) AS n, sum(length(role)) AS chars FROM conversations GROUP BY conv_id")
def json_round_trip(t: Tables) -> DataFrame:
    from opsflow.operators.nested import collect_parts

    path = scratch(t.spark, "landing")
    docs = collect_parts(t.conversations, ["conv_id"], ["turn", "role", "text"], F.struct("turn", "role"), "lines")
    docs.select("conv_id", "lines").write.json(path)
    landed = sources.scan_json(t.spark, path, "conv_id BIGINT, lines ARRAY<STRUCT<turn: BIGINT, role: STRING>>")
    return landed.select("conv_id", F.explode("lines").alias("l")).groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("l.role")).cast("bigint").alias("chars")
    )


@query("append_twice", "SELECT o_orderstatus, 2 * count(*) AS n FROM orders GROUP BY 1")
def append_twice(t: Tables) -> DataFrame:
    path = scratch(t.spark, "log")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    sources.append(rows, path)
    sources.append(rows, path)
    return t.spark.read.schema(rows.schema).parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


# -- streams ---------------------------------------------------------------

LAST_EVENT = TableSpec(
    "last_event",
    "user_id BIGINT, event_type STRING, value DOUBLE, first_event BIGINT",
    keys=("user_id",),
    insert_only=("first_event",),
)
LAST_EVENT_SQL = """
    SELECT user_id, max_by(event_type, (ts, event_id)) AS event_type, max_by(value, (ts, event_id)) AS value,
           min_by(event_id, (ts, event_id)) AS first_event
    FROM events GROUP BY user_id
"""


def event_stream(t: Tables) -> DataFrame:
    files = t.events.inputFiles()
    if all(f.endswith("/events.parquet") for f in files):  # the table is one file, not a folder of files
        stream = file_stream(t.spark, t.folder, t.events.schema, "events.parquet")
    else:
        stream = file_stream(t.spark, f"{t.folder}/events.parquet", t.events.schema)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def synced(t: Tables) -> tuple[str, DataFrame]:
    path = scratch(t.spark, "changes")
    stream = event_stream(t).withColumn("first_event", F.col("event_id"))
    sync_stream(
        stream, LAST_EVENT, ["ts", "event_id"], path, scratch(t.spark, "checkpoint")
    ).awaitTermination()
    return path, current_state(t.spark, LAST_EVENT, path)


@query("sync_stream", LAST_EVENT_SQL)
def sync_stream_state(t: Tables) -> DataFrame:
    return synced(t)[1]


@query("compact_changes", LAST_EVENT_SQL)
def compact_changes(t: Tables) -> DataFrame:
    path, _ = synced(t)
    target = scratch(t.spark, "compacted")
    compact(t.spark, LAST_EVENT, path, target)
    return current_state(t.spark, LAST_EVENT, target)


def drained(t: Tables, stream: DataFrame, mode: str, name: str) -> DataFrame:
    """Run a stream over all present files into a folder and read that."""
    path = scratch(t.spark, name)
    (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", scratch(t.spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return t.spark.read.schema(stream.schema).parquet(path)


@query(
    "dedupe_stream",
    "SELECT user_id, event_type, count(DISTINCT event_id) AS n FROM events GROUP BY ALL",
)
def dedupe_stream_events(t: Tables) -> DataFrame:
    once = event_stream(t)
    twice = once.unionByName(once)
    seen = drained(t, dedupe_stream(twice, ["event_id"], "ts", "40 days"), "append", "deduped")
    return seen.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "unseen_events",
    "SELECT event_id, user_id FROM events WHERE event_type <> 'click'",
)
def unseen_events(t: Tables) -> DataFrame:
    batch = t.events.unionByName(t.events)
    ledger = t.events.where(F.col("event_type") == "click").select("event_id")
    return unseen(batch, ledger, ["event_id"]).select("event_id", "user_id")


TUMBLING_SQL = """
    SELECT event_type, strftime(time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01'), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n
    FROM events GROUP BY ALL
"""


def folded(t: Tables, stream: DataFrame) -> DataFrame:
    path = scratch(t.spark, "windows")
    fold_windows(
        stream, ["event_type"], "ts", "tumbling", "6 hours", path, scratch(t.spark, "checkpoint")
    ).awaitTermination()
    return window_state(t.spark, ["event_type"], path).select(
        "event_type", time_text("window_start").alias("window_start"), "n"
    )


@query("activity_windows_tumbling", TUMBLING_SQL)
def activity_windows_tumbling(t: Tables) -> DataFrame:
    """As a stream, all windows."""
    return folded(t, event_stream(t))


@query("late_events", TUMBLING_SQL)
def late_events(t: Tables) -> DataFrame:
    """Events in four files out of order, one file per micro-batch: no row is lost."""
    path = scratch(t.spark, "shuffled-events")
    events = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartition(4, F.xxhash64("event_id")).write.parquet(path)
    return folded(t, file_stream(t.spark, path, events.schema, max_files=1))


@query(
    "activity_windows_sliding",
    """
    SELECT event_type, strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n
    FROM (SELECT event_type, unnest([time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01'),
                                     time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01') - INTERVAL 6 HOUR]) AS s FROM events)
    GROUP BY ALL
    """,
)
def activity_windows_sliding(t: Tables) -> DataFrame:
    events = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    windows = activity_windows(events, ["event_type"], "ts", "sliding", "12 hours", "6 hours")
    return windows.select("event_type", time_text("window_start").alias("window_start"), "n")


SESSION_SQL = """
    WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM g)
    SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS window_start,
           strftime(max(ts) + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end, count(*) AS n
    FROM s GROUP BY user_id, session
"""


def shown_sessions(df: DataFrame) -> DataFrame:
    return df.select(
        "user_id", time_text("window_start").alias("window_start"), time_text("window_end").alias("window_end"), "n"
    )


@query("activity_windows_session", SESSION_SQL)
def activity_windows_session(t: Tables) -> DataFrame:
    events = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    return shown_sessions(activity_windows(events, ["user_id"], "ts", "session", "2 hours"))


@query("session_counts", SESSION_SQL)
def session_counts_events(t: Tables) -> DataFrame:
    events = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    return shown_sessions(session_counts(events, ["user_id"], "ts", 7200))
