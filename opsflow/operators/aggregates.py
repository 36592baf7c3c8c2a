"""Grouped reports and checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import NumericType

from opsflow.functions.dates import calendar, todate_windows
from opsflow.session import settle


def ready_to_confirm(
    lines: DataFrame,
    packed: DataFrame,
    key: str,
    line: Sequence[str],
    shipped_qty: str,
    packed_qty: str,
    tracking: str,
) -> DataFrame:
    """Keys whose shipped and packed quantities agree, twice: over the lines that
    are in a tracked package, then over all lines and all packed rows."""
    on = [key, *line]
    both = lines.join(packed, on).where(F.col(tracking).isNotNull())
    top = (
        both.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum(shipped_qty).cast("bigint").alias("line_qty"),
            F.sum(packed_qty).cast("bigint").alias("package_qty"),
            F.count_distinct(tracking).alias("packages"),
        )
        .where(F.col("line_qty") == F.col("package_qty"))
    )
    shipped = lines.groupBy(key).agg(F.sum(shipped_qty).cast("bigint").alias("shipped_qty"))
    packs = packed.groupBy(key).agg(F.sum(packed_qty).cast("bigint").alias("packed_qty"))
    return top.join(shipped, key).join(packs, key).where(
        F.col("shipped_qty") == F.col("packed_qty")
    )


def reconcile_quantities(
    lines: DataFrame, packed: DataFrame, key: str, item: str, qty: str, packed_qty: str
) -> DataFrame:
    """Per key: do the packed quantities equal the line quantities of all items
    (``full_match``), of at least one (``line_match``)? Items that only packages
    hold do not count."""
    wanted = lines.groupBy(key, item).agg(F.sum(qty).alias("_wanted"))
    found = packed.groupBy(key, item).agg(F.sum(packed_qty).alias("_found"))
    equal = F.coalesce(F.col("_wanted") == F.col("_found"), F.lit(False))
    return (
        wanted.join(found, [key, item], "left")
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("items"),
            F.bool_and(equal).alias("full_match"),
            F.bool_or(equal).alias("line_match"),
        )
    )


def reconcile_keys(keys: DataFrame, checked: DataFrame, key: str) -> DataFrame:
    """Checks for a given list of keys; a key without lines matches in full."""
    return keys.select(key).distinct().join(checked, key, "left").fillna(
        {"items": 0, "full_match": True, "line_match": False}
    )


def todate_counts(
    events: DataFrame, rep: str, ts: str, as_of: datetime, reps: DataFrame | None = None
) -> DataFrame:
    """Events per rep since the start of the week, month and year of ``as_of``.

    The windows overlap, yet one pass counts them all: a conditional count per
    window, then one row per window. Known ``reps`` without events count 0.
    """
    windows = todate_windows(as_of)
    counts = (
        events.where(F.col(ts).isNotNull() & F.col(rep).isNotNull())
        .groupBy(F.col(rep).alias("rep"))
        .agg(*[F.count_if(F.col(ts) >= F.lit(start)).alias(name)
               for name, (start, _) in windows.items()])
    )
    if reps is not None:
        known = reps.select(F.col(rep).alias("rep")).distinct()
        counts = known.join(counts, "rep", "full_outer").fillna(0)
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("window"),
            F.lit(start).cast("timestamp_ntz").alias("window_start"),
            F.lit(end).cast("timestamp_ntz").alias("window_end"),
            F.col(name).alias("n"),
        )
        for name, (start, end) in windows.items()
    ])
    return counts.select("rep", F.explode(rows).alias("w")).select("rep", "w.*")


def merge_activity_counts(
    sources: Mapping[str, DataFrame], teams: DataFrame | None = None
) -> DataFrame:
    """Counts of several activity kinds side by side, one row per window and rep."""
    tagged = [
        counts.withColumn("_kind", F.lit(name)) for name, counts in sources.items()
    ]
    wide = (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("window", "window_start", "window_end", "rep")
        .pivot("_kind", list(sources))
        .agg(F.sum("n"))
        .fillna(0, subset=list(sources))
    )
    if teams is None:
        return wide
    return wide.join(teams, "rep", "left").fillna("unknown", subset=["team"])


def profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: rows, distinct values, lowest and highest (as text)."""
    aggregates = [F.count(F.lit(1)).alias("_rows")]
    for i, name in enumerate(cols):
        aggregates += [
            F.count_distinct(F.col(name)).alias(f"_d{i}"),
            F.min(name).cast("string").alias(f"_l{i}"),
            F.max(name).cast("string").alias(f"_h{i}"),
        ]
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("column"),
            F.col("_rows").alias("height"),
            F.col(f"_d{i}").alias("n_unique"),
            F.col(f"_l{i}").alias("lowest"),
            F.col(f"_h{i}").alias("highest"),
        )
        for i, name in enumerate(cols)
    ])
    return df.agg(*aggregates).select(F.inline(rows))


def column_values(df: DataFrame, cols: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``column, place, value, n``: the distinct values of each column, numbered in ascending order.

    Numbers go by size, all else by text; nulls are left out. A row becomes one row per
    column that collapses on the map side; the distinct values are then cut into ranges
    of equal size, numbered within their range, and moved on by what the ranges before
    hold. So a column of any number of values is never in one task.
    """
    numeric = {f.name for f in df.schema if isinstance(f.dataType, NumericType)}
    pairs = [
        F.struct(
            F.lit(c).alias("column"), F.col(c).cast("string").alias("value"),
            (F.col(c).cast("decimal(38,9)") if c in numeric else F.lit(None).cast("decimal(38,9)")).alias("_number"),
        )
        for c in cols
    ]
    counted = df.select(F.inline(F.array(*pairs))).where("value IS NOT NULL").groupBy("column", "_number", "value").agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    ranges = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["column", "_number", "value"]
    sorted_ = counted.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    placed = settle(sorted_.withColumn("_at", F.monotonically_increasing_id()), "column-values")
    part = F.shiftright("_at", 33).alias("_part")
    before = Window.partitionBy("column").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("column", part).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")).select(
        "column", "_part", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    # at most one row per range and one more per column
    joined = placed.withColumn("_part", F.shiftright("_at", 33)).join(F.broadcast(starts), ["column", "_part"])
    return joined.select("column", (F.col("_at") - F.col("_first") + F.col("_before") + 1).alias("place"), "value", "n")


def profile_of_values(values: DataFrame) -> DataFrame:
    """``column, n_values, n_unique, lowest, highest`` from ``column_values``."""
    return values.groupBy("column").agg(
        F.sum("n").alias("n_values"), F.count(F.lit(1)).alias("n_unique"),
        F.min_by("value", "place").alias("lowest"), F.max_by("value", "place").alias("highest"),
    )


def timeseries_report(
    df: DataFrame,
    dims: Sequence[str],
    day: Column,
    measures: Mapping[str, Column],
    since: date,
    until: date,
    having: str | None = None,
) -> DataFrame:
    """Measures per dimension and day, with every day of the period present.

    ``having`` applies to the measured days; days without rows hold zeros.
    """
    measured = (
        df.withColumn("day", day.cast("date"))
        .where(F.col("day").between(F.lit(since), F.lit(until)))
        .groupBy(*dims, "day")
        .agg(*[measure.alias(name) for name, measure in measures.items()])
    )
    if having is not None:
        measured = measured.where(having)
    days = (
        measured.select(*dims)
        .distinct()
        .withColumn("day", F.explode(calendar(since, until)))
    )
    return days.join(measured, [*dims, "day"], "left").fillna(0, subset=list(measures))


def bucket_counts(df: DataFrame, bucket: str, key: str) -> DataFrame:
    """Rows and distinct keys per bucket; empty buckets do not appear."""
    return df.groupBy(bucket).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("n_keys")
    )
