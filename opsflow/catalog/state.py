"""Keyed state: tables in buckets, deletes on a stream, compaction, rejects, ids seen, late sessions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from opsflow.catalog.base import Tables, query
from opsflow.catalog.updates import CUSTOMER_ORDERS, LAST_EVENT, SESSION_SQL, UPSERT_SQL, shown_sessions, target_and_updates
from opsflow.operators.buckets import BucketTable
from opsflow.operators.tables import TableSpec
from opsflow.session import scratch
from opsflow.streaming import (
    ChangeLog, file_stream, first_seen, fold_sessions, load_checked, rejected, session_state, sync_buckets,
)
from opsflow.streaming.state import each_batch


@query("upsert_buckets", UPSERT_SQL)
def upsert_buckets(t: Tables) -> DataFrame:
    """The keyed upsert, on a table that is rewritten bucket by bucket."""
    target, updates = target_and_updates(t)
    held = BucketTable(scratch(t.spark, "customer-orders"), CUSTOMER_ORDERS)
    held.upsert(target, ["custkey"])
    held.upsert(updates, ["o_orderdate", "o_orderkey"])
    return held.read(t.spark)


@query(
    "buckets_having",
    "SELECT o_custkey AS custkey, max(o_orderkey) AS first_order FROM orders WHERE o_orderstatus = 'P' GROUP BY 1",
)
def buckets_having(t: Tables) -> DataFrame:
    """Rows of given keys, read from their buckets only."""
    orders = t.orders.select(
        F.col("o_custkey").alias("custkey"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderkey")).alias("first_order"), "o_orderkey",
    )
    spec = TableSpec("newest", CUSTOMER_ORDERS.ddl, ("custkey",))
    held = BucketTable(scratch(t.spark, "newest"), spec)
    pending = orders.where("first_order IS NOT NULL")
    held.upsert(pending, ["o_orderkey"])
    return held.having(pending).select("custkey", "first_order")


DELETES_SQL = """
    WITH d AS (SELECT user_id, max((ts, event_id)) AS at FROM events WHERE event_type = 'error' GROUP BY user_id),
    l AS (SELECT e.* FROM events e LEFT JOIN d USING (user_id)
          WHERE event_type <> 'error' AND (d.at IS NULL OR (e.ts, e.event_id) > d.at))
    SELECT user_id, max_by(event_type, (ts, event_id)) AS event_type, max_by(value, (ts, event_id)) AS value,
           min_by(event_id, (ts, event_id)) AS first_event
    FROM l GROUP BY user_id
"""


def gone() -> Column:
    return F.col("event_type") == "error"


def in_turns(t: Tables, run: Callable[[DataFrame, int], None], turns: int = 4) -> None:
    """Land the events in ``turns`` parts, oldest first, and run over the stream after each."""
    events = t.events.withColumns({"ts": F.col("ts").cast("timestamp"), "first_event": F.col("event_id")})
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    path = scratch(t.spark, "landed-events")
    part = F.least(F.floor((F.col("ts").cast("double") - low.timestamp()) / (high.timestamp() - low.timestamp()) * turns), F.lit(turns - 1))
    for turn in range(turns):
        events.where(part == turn).write.mode("append").parquet(path)
        run(file_stream(t.spark, path, events.schema), turn)


@query("sync_stream_deletes", DELETES_SQL)
def sync_stream_deletes(t: Tables) -> DataFrame:
    """Errors delete their user: keyed state from a stream with deletes and re-inserts."""
    log = ChangeLog(scratch(t.spark, "log"), LAST_EVENT)
    checkpoint = scratch(t.spark, "checkpoint")
    in_turns(t, lambda stream, _: log.sync(stream, ["ts", "event_id"], checkpoint, gone()).awaitTermination())
    return log.state(t.spark)


@query("compact_beside_stream", DELETES_SQL)
def compact_beside_stream(t: Tables) -> DataFrame:
    """As ``sync_stream_deletes``, with compactions between its batches."""
    log = ChangeLog(scratch(t.spark, "log"), LAST_EVENT)
    checkpoint = scratch(t.spark, "checkpoint")

    def run(stream: DataFrame, turn: int) -> None:
        log.sync(stream, ["ts", "event_id"], checkpoint, gone()).awaitTermination()
        if turn in (0, 2):
            log.compact(t.spark)

    in_turns(t, run)
    return log.state(t.spark)


@query("sync_buckets_deletes", DELETES_SQL)
def sync_buckets_deletes(t: Tables) -> DataFrame:
    """The same stream into a table in buckets."""
    held = BucketTable(scratch(t.spark, "last-events"), LAST_EVENT, buckets=16)
    checkpoint = scratch(t.spark, "checkpoint")
    in_turns(t, lambda stream, _: sync_buckets(stream, held, ["ts", "event_id"], checkpoint, gone()).awaitTermination())
    return held.read(t.spark)


PRICES = TableSpec("prices", "orderkey BIGINT, price DECIMAL(12,2) NOT NULL, day DATE", keys=("orderkey",))


@query(
    "load_checked",
    """
    WITH r AS (SELECT CASE WHEN o_orderstatus = 'P' THEN 'price is no decimal(12,2)'
                           WHEN o_orderpriority LIKE '1%' THEN 'null in key orderkey'
                           WHEN o_orderpriority LIKE '2%' THEN 'null in column price, day is no date' END AS errors, o_totalprice FROM orders)
    SELECT coalesce(errors, 'loaded') AS errors, count(*) AS n,
           CAST(round(sum(CASE WHEN errors IS NULL THEN CAST(o_totalprice AS DECIMAL(12,2)) ELSE 0 END), 2) AS DOUBLE) AS total
    FROM r GROUP BY 1
    """,
)
def load_checked_orders(t: Tables) -> DataFrame:
    """A batch with bad rows loads the others and names what is wrong with each."""
    status, priority = F.col("o_orderstatus"), F.left("o_orderpriority", F.lit(1))
    fine = status != "P"
    loose = t.orders.select(
        F.when(fine & (priority == "1"), None).otherwise(F.col("o_orderkey").cast("string")).alias("orderkey"),
        F.when(status == "P", "n/a").when(priority != "2", F.col("o_totalprice").cast("string")).alias("price"),
        F.when(fine & (priority == "2"), "someday").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
    )
    rejects, target = scratch(t.spark, "rejects"), BucketTable(scratch(t.spark, "prices"), PRICES)
    for _ in range(2):  # the batch runs again
        load_checked(loose, 0, PRICES, rejects, lambda rows, number: target.upsert(rows, ["day", "price"], batch=number))
    bad = rejected(t.spark, rejects).groupBy(F.array_join("errors", ", ").alias("errors")).agg(
        F.count(F.lit(1)).alias("n"), F.lit(0.0).alias("total")
    )
    good = target.read(t.spark).agg(F.count(F.lit(1)).alias("n"), F.sum("price").cast("double").alias("total"))
    return bad.unionByName(good.select(F.lit("loaded").alias("errors"), "n", "total"))


@query("first_seen_events", "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL")
def first_seen_events(t: Tables) -> DataFrame:
    """Every event arrives twice in a batch and again with the next one; each counts once."""
    spec = TableSpec("seen", "event_id BIGINT, batch BIGINT", keys=("event_id",), insert_only=("batch",))
    ledger, out = BucketTable(scratch(t.spark, "seen"), spec), scratch(t.spark, "first")

    def run(batch: DataFrame, number: int) -> None:
        again = t.events.withColumns({"ts": F.col("ts").cast("timestamp"), "first_event": F.col("event_id")})
        earlier = again.join(batch.select(F.max("ts").alias("_last")), F.col("ts") <= F.col("_last")).drop("_last")
        rows = batch.unionByName(batch).unionByName(earlier)
        first_seen(rows, number, ledger, ["ts"]).write.mode("overwrite").parquet(f"{out}/batch={number}")

    checkpoint = scratch(t.spark, "checkpoint")
    in_turns(t, lambda stream, _: each_batch(stream, run, checkpoint).awaitTermination(), turns=2)
    return t.spark.read.parquet(out).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("late_sessions", SESSION_SQL)
def late_sessions(t: Tables) -> DataFrame:
    """Sessions of a stream whose files are out of order, one per micro-batch: no row is lost."""
    path, slots = scratch(t.spark, "shuffled-events"), scratch(t.spark, "slots")
    events = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartition(4, F.xxhash64("event_id")).write.parquet(path)
    stream = file_stream(t.spark, path, events.schema, max_files=1)
    fold_sessions(stream, ["user_id"], "ts", 7200, slots, scratch(t.spark, "checkpoint")).awaitTermination()
    return shown_sessions(session_state(t.spark, ["user_id"], 7200, slots))
