"""Keyed tables: contracts, upserts, snapshots.

Plain parquet has no MERGE. ``upsert`` returns the merged rows for a new folder;
``fold`` reads an append-only table of changes as its current state, so that a
micro-batch writes only its own rows and nothing rewrites the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from opsflow.operators.skew import Order
from opsflow.operators.nested import sort_key


@dataclass(frozen=True)
class TableSpec:
    """Contract of a target table. Columns outside ``insert_only`` and the keys
    are updated when a key is written again."""

    name: str
    ddl: str
    keys: tuple[str, ...]
    insert_only: tuple[str, ...] = ()

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def update_columns(self) -> list[str]:
        return [c for c in self.columns if c not in self.keys and c not in self.insert_only]


def conform(df: DataFrame, spec: TableSpec, extra: Sequence[str] = ()) -> DataFrame:
    """Only the contracted columns, in contract order and type, and ``extra`` ones as they are.

    A missing column is an error; a null key fails the job when it runs. Where bad rows
    are to be set aside instead, see ``checked``.
    """
    missing = [c for c in spec.columns if c not in df.columns]
    if missing:
        raise ValueError(f"{spec.name}: missing columns {missing}")
    cast = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema], *extra)
    checked = {
        key: F.when(
            F.col(key).isNull(), F.raise_error(F.lit(f"{spec.name}: null in key {key}"))
        ).otherwise(F.col(key))
        for key in spec.keys
    }
    return cast.withColumns(checked)


def checked(df: DataFrame, spec: TableSpec, extra: Sequence[str] = ()) -> DataFrame:
    """``conform`` without failing: contracted columns, ``extra``, ``_errors`` and ``_raw``.

    ``_errors`` names what is wrong with a row (empty for a good one): a null key, a null
    in a column that is NOT NULL, a value that is not of the column's type. ``_raw`` is
    the row as it came, as JSON, for bad rows only.
    """
    missing = [c for c in spec.columns if c not in df.columns]
    if missing:
        raise ValueError(f"{spec.name}: missing columns {missing}")
    found = []
    for f in spec.schema:
        value, cast = F.col(f.name), F.col(f.name).try_cast(f.dataType)
        if f.name in spec.keys or not f.nullable:
            kind = "key" if f.name in spec.keys else "column"
            found.append(F.when(value.isNull(), F.lit(f"null in {kind} {f.name}")))
        found.append(F.when(value.isNotNull() & cast.isNull(), F.lit(f"{f.name} is no {f.dataType.simpleString()}")))
    errors = F.filter(F.array(*found), lambda e: e.isNotNull())
    raw = F.when(F.size("_errors") > 0, F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in df.columns])))
    marked = df.withColumn("_errors", errors).withColumn("_raw", raw)
    return marked.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in spec.schema], *extra, "_errors", "_raw")


def create_table(spark: SparkSession, spec: TableSpec, path: str) -> None:
    """Create the (external, parquet) table unless it exists."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{spec.name}` ({spec.ddl}) USING parquet LOCATION '{path}'"
    )


def fold(rows: DataFrame, spec: TableSpec, order_by: Sequence[Order]) -> DataFrame:
    """One row per key from rows applied in ascending ``order_by``: the last
    value of updated columns, the first of insert-only ones.

    A plain aggregation, so repeats of a hot key collapse before the shuffle.
    """
    order = F.struct(*sort_key(order_by))
    updated, kept = spec.update_columns, list(spec.insert_only)
    aggregates = []
    if updated:
        aggregates.append(F.max_by(F.struct(*updated), order).alias("_last"))
    if kept:
        aggregates.append(F.min_by(F.struct(*kept), order).alias("_first"))
    if not aggregates:
        return rows.select(*spec.keys).distinct()
    folded = rows.groupBy(*spec.keys).agg(*aggregates)
    source = {c: "_last" for c in updated} | {c: "_first" for c in kept}
    return folded.select(
        *[F.col(f"{source[c]}.{c}").alias(c) if c in source else F.col(c) for c in spec.columns]
    )


def upsert(
    target: DataFrame, updates: DataFrame, spec: TableSpec, order_by: Sequence[Order]
) -> DataFrame:
    """The target with the updates applied, one row per key.

    New key: all columns. Known key: the updated columns only. Both sides are
    unique per key at the join. Write the result to another folder than the
    one ``target`` is read from.
    """
    latest = fold(updates, spec, order_by)
    old = target.select(*spec.keys, F.struct(*spec.columns).alias("_old"))
    new = latest.select(*spec.keys, F.struct(*spec.columns).alias("_new"))
    joined = old.join(new, list(spec.keys), "full_outer")
    known, changed = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    columns = []
    for column in spec.columns:
        if column in spec.keys:
            columns.append(F.col(column))
        elif column in spec.insert_only:
            columns.append(F.when(known, F.col(f"_old.{column}")).otherwise(F.col(f"_new.{column}")).alias(column))
        else:
            columns.append(F.when(changed, F.col(f"_new.{column}")).otherwise(F.col(f"_old.{column}")).alias(column))
    return joined.select(*columns)


def write_snapshot(
    df: DataFrame,
    at: datetime,
    history_path: str,
    current: DataFrame,
    spec: TableSpec,
    order_by: Sequence[Order],
) -> DataFrame:
    """Add a snapshot to its history and return the new current state.

    The snapshot gets its time ``at``, is written once as that time's partition, and
    is read back for the second use, so it is not computed twice. A snapshot that
    runs again replaces its own partition only.
    """
    stamp = F.lit(at).cast("timestamp_ntz")
    stamped = df.withColumn("snapshot_at", stamp)
    (
        stamped.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_at")
        .parquet(history_path)
    )
    written = df.sparkSession.read.schema(stamped.schema).parquet(history_path).where(
        F.col("snapshot_at") == stamp
    )
    return upsert(current, conform(written, spec), spec, order_by)
