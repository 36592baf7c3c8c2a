"""Incremental forms of the batch operators as Structured Streaming jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructType

from opsflow.operators.skew import Order
from opsflow.operators.tables import TableSpec, conform, fold


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    glob: str = "*.parquet",
    max_files: int | None = None,
) -> DataFrame:
    """New parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def write_changes(
    batch: DataFrame, batch_id: int, spec: TableSpec, order_by: Sequence[Order], path: str
) -> None:
    """Fold one micro-batch per key and write it as its own ``batch`` partition.

    The write replaces only that partition, so a batch that runs again leaves
    the same rows. Insert-only columns of a batch are its first values.
    """
    (
        conform(fold(batch, spec, order_by), spec)
        .withColumn("batch", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch")
        .parquet(path)
    )


def sync_stream(
    stream: DataFrame, spec: TableSpec, order_by: Sequence[Order], path: str, checkpoint: str
) -> StreamingQuery:
    """Keyed upsert of a stream: append-only changes, no rewrite of the table.

    Read the state with ``current_state``. An error stops the query; no rows are
    skipped. Rows later than any watermark take the same way.
    """
    return (
        stream.writeStream.foreachBatch(
            lambda batch, batch_id: write_changes(batch, batch_id, spec, order_by, path)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_state(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """The table behind a folder of changes: later batches win."""
    schema = spec.schema.add("batch", LongType())
    return fold(spark.read.schema(schema).parquet(path), spec, ["batch"])


def compact(spark: SparkSession, spec: TableSpec, path: str, to_path: str) -> None:
    """Rewrite the state as the only batch of a new folder."""
    state = current_state(spark, spec, path).withColumn("batch", F.lit(-1).cast("bigint"))
    state.write.mode("overwrite").partitionBy("batch").parquet(to_path)


def dedupe_stream(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """First row per key, as far apart as ``delay``; state is dropped after it."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def unseen(batch: DataFrame, ledger: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For ``foreachBatch``: rows of a batch that the ledger lacks, one per key.

    The aggregation collapses copies before the shuffle.
    """
    row = F.struct(*[c for c in batch.columns if c not in keys])
    once = batch.groupBy(*keys).agg(F.min(row).alias("_row")).select(*keys, "_row.*")
    return once.join(ledger.select(*keys), list(keys), "left_anti")


def activity_windows(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    kind: str,
    size: str,
    slide: str | None = None,
    delay: str | None = None,
    aggregates: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Counts per key in tumbling, sliding or session windows.

    Works on batch frames and on streams. A stream needs ``delay``, the lookback
    within which late rows still count; it gives windows once they are closed. Where
    no row may be left out, use ``fold_windows``.
    """
    if stream.isStreaming and delay is None:
        raise ValueError("a stream needs the delay within which late rows still count")
    timed = stream.withWatermark(ts, delay) if stream.isStreaming else stream
    if kind == "session":
        window = F.session_window(ts, size)
    elif kind == "sliding":
        window = F.window(ts, size, slide)
    elif kind == "tumbling":
        window = F.window(ts, size)
    else:
        raise ValueError(f"unknown window kind {kind!r}")
    measures = aggregates or {"n": F.count(F.lit(1))}
    return (
        timed.groupBy(window.alias("w"), *keys)
        .agg(*[c.alias(n) for n, c in measures.items()])
        .select(
            *keys,
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            *measures,
        )
    )


def _window_changes(
    batch: DataFrame, batch_id: int, keys: Sequence[str], ts: str, kind: str, size: str, slide: str | None, path: str
) -> None:
    counted = activity_windows(batch, keys, ts, kind, size, slide).withColumn("batch", F.lit(batch_id).cast("bigint"))
    (
        counted.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch")
        .parquet(path)
    )


def fold_windows(
    stream: DataFrame, keys: Sequence[str], ts: str, kind: str, size: str, path: str, checkpoint: str, slide: str | None = None
) -> StreamingQuery:
    """Tumbling or sliding counts of a stream, however late its rows are.

    Each micro-batch adds its own counts as a partition and replaces only that when it
    runs again. Read the sums with ``window_state``: open windows are in it as well.
    """
    if kind == "session":
        raise ValueError("sessions cannot be summed; use fold_sessions")
    return (
        stream.writeStream.foreachBatch(
            lambda batch, batch_id: _window_changes(batch, batch_id, keys, ts, kind, size, slide, path)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def window_state(spark: SparkSession, keys: Sequence[str], path: str) -> DataFrame:
    """Counts per key and window over all batches that ``fold_windows`` wrote."""
    return spark.read.parquet(path).groupBy(*keys, "window_start", "window_end").agg(F.sum("n").alias("n"))


def session_counts(
    df: DataFrame, keys: Sequence[str], ts: str, gap_seconds: int
) -> DataFrame:
    """Session windows of a batch frame, safe for hot keys.

    Rows less than the gap apart share a session, so all rows of one slot half a
    gap wide do. Rows are therefore reduced to slots on the map side, and only
    slots (at most two per gap of time) are put in order per key.
    """
    slot_width = max(1, gap_seconds // 2)
    micros = F.unix_micros(F.col(ts))
    slots = (
        df.withColumn("_slot", F.floor(micros / (slot_width * 1_000_000)))
        .groupBy(*keys, "_slot")
        .agg(
            F.min(micros).alias("_from"),
            F.max(micros).alias("_to"),
            F.count(F.lit(1)).alias("_rows"),
        )
    )
    return sessions_of_slots(slots, keys, gap_seconds)


def sessions_of_slots(slots: DataFrame, keys: Sequence[str], gap_seconds: int) -> DataFrame:
    """Sessions from ``_slot, _from, _to, _rows`` per key: slots less than a gap apart belong together."""
    gap = F.lit(gap_seconds * 1_000_000)
    along = Window.partitionBy(*keys).orderBy("_slot")
    starts = (F.col("_from") - F.lag("_to").over(along)) > gap
    numbered = slots.withColumn(
        "_new", F.when(F.coalesce(starts, F.lit(True)), 1).otherwise(0)
    ).withColumn("_session", F.sum("_new").over(along))
    return numbered.groupBy(*keys, "_session").agg(
        F.timestamp_micros(F.min("_from")).alias("window_start"),
        F.timestamp_micros(F.max("_to") + gap).alias("window_end"),
        F.sum("_rows").alias("n"),
    ).drop("_session")
