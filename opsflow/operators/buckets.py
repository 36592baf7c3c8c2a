"""Keyed tables in hash buckets: an upsert reads and rewrites only the buckets it touches.

A table is a folder: ``data/generation=<n>/bucket=<b>`` holds the rows of a bucket as
some upsert left it, ``manifest/generation=<n>`` says for every bucket which generation
is current. A manifest is one small file, written last, so a reader sees a whole upsert or
nothing of it, and keeps what it began to read. A table has one writer at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opsflow.operators.nested import sort_key
from opsflow.operators.skew import Order
from opsflow.operators.tables import TableSpec, conform, fold
from opsflow.session import settle

MANIFEST = "bucket int, at bigint, batch bigint"


def fold_changes(rows: DataFrame, spec: TableSpec, order_by: Sequence[Order], deleted: Column | None = None) -> DataFrame:
    """One row per key from rows and tombstones applied in ascending ``order_by``.

    Columns of ``spec``, ``_reset`` (some row deleted the key) and ``_deleted`` (nothing came
    after that). What follows a delete is a new row: its insert-only values are those of the
    first row after the last delete. ``order_by`` must tell the rows of a key apart.
    Tombstones are reduced to one per key first, so repeats of a hot key collapse
    before both shuffles.
    """
    if deleted is None:
        return fold(rows, spec, order_by).withColumns({"_reset": F.lit(False), "_deleted": F.lit(False)})
    keys, order = list(spec.keys), F.struct(*sort_key(order_by))
    marked = rows.withColumns({"_gone": F.coalesce(deleted, F.lit(False)), "_order": order})
    last = marked.where("_gone").groupBy(*keys).agg(F.max("_order").alias("_at"))
    after = marked.where(~F.col("_gone")).join(last, keys, "left").where("_at IS NULL OR _order > _at")
    live = fold(after.drop("_gone", "_order", "_at"), spec, order_by)
    told = last.select(*keys, F.lit(True).alias("_reset"))
    joined = live.withColumn("_live", F.lit(True)).join(told, keys, "full_outer")
    return joined.select(
        *spec.columns, F.coalesce("_reset", F.lit(False)).alias("_reset"), F.col("_live").isNull().alias("_deleted")
    )


@dataclass(frozen=True)
class BucketTable:
    """A keyed table below ``path``. ``buckets`` is fixed once rows are in it.

    Choose so many that a bucket is some tens of MB: an upsert of few keys rewrites one
    bucket per key at worst.
    """

    path: str
    spec: TableSpec
    buckets: int = 64

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.spec.keys), F.lit(self.buckets)).cast("int")

    def manifest(self, spark: SparkSession) -> tuple[int, int | None, dict[int, int]]:
        """The current generation, the batch it came from, and the generation of every bucket with rows."""
        try:
            files = spark.read.schema(f"{MANIFEST}, generation bigint").parquet(f"{self.path}/manifest")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
                raise
            return -1, None, {}
        newest = files.agg(F.max("generation")).first()[0]
        if newest is None:  # a first writer that stopped before its manifest
            return -1, None, {}
        rows = files.where(F.col("generation") == newest).collect()  # a row per bucket
        return newest, rows[0]["batch"], {r["bucket"]: r["at"] for r in rows if r["bucket"] is not None}

    def _paths(self, current: dict[int, int], buckets: Iterable[int] | None) -> list[str]:
        chosen = current if buckets is None else [b for b in buckets if b in current]
        return [f"{self.path}/data/generation={current[b]}/bucket={b}" for b in sorted(chosen)]

    def _rows(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        if not paths:
            return spark.createDataFrame([], self.spec.schema)
        return spark.read.schema(self.spec.schema).parquet(*paths)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._rows(spark, self._paths(self.manifest(spark)[2], None))

    def having(self, keys: DataFrame) -> DataFrame:
        """Rows whose key is in ``keys``: only the buckets of these keys are read."""
        spark = keys.sparkSession
        wanted = settle(self._cast(keys).select(*self.spec.keys).distinct().withColumn("bucket", self.bucket()), "wanted-keys")
        hit = [r["bucket"] for r in wanted.select("bucket").distinct().collect()]
        rows = self._rows(spark, self._paths(self.manifest(spark)[2], hit))
        return rows.join(wanted.drop("bucket"), list(self.spec.keys), "left_semi")

    def _cast(self, df: DataFrame) -> DataFrame:
        return df.withColumns({k: F.col(k).cast(self.spec.schema[k].dataType) for k in self.spec.keys})

    def upsert(
        self, updates: DataFrame, order_by: Sequence[Order], deleted: Column | None = None, batch: int | None = None
    ) -> list[int]:
        """Apply rows in ascending ``order_by``; the buckets that were rewritten.

        New key: all columns. Known key: the updated columns only. ``deleted`` marks
        tombstones; a key that comes back after one is new. A ``batch`` number that is
        not above the last one applied changes nothing, so a batch can run again.

        The batch is folded and shuffled; rows of the touched buckets are streamed past
        it where it is small enough for Spark to broadcast, and shuffled where it is not.
        All other buckets are neither read nor written.
        """
        spark, keys = updates.sparkSession, list(self.spec.keys)
        newest, applied, current = self.manifest(spark)
        if batch is not None and applied is not None and batch <= applied:
            return []
        folded = fold_changes(updates, self.spec, order_by, deleted)
        checked = conform(folded, self.spec, extra=["_reset", "_deleted"]).withColumn("bucket", self.bucket())
        changes = settle(checked, "bucket-changes")
        touched = sorted(r["bucket"] for r in changes.select("bucket").distinct().collect())
        known = [b for b in touched if b in current]
        old = self._rows(spark, self._paths(current, known))
        hit = settle(old.join(changes.select(*keys), keys, "left_semi").select(*keys), "known-keys") if known else None

        new = changes.where(~F.col("_deleted"))
        fresh = new if hit is None else new.join(hit, keys, "left_anti")
        out = fresh.select(*self.spec.columns, "bucket").repartition("bucket")
        if known:
            now = changes.select(*keys, F.struct(*self.spec.columns, "_reset", "_deleted").alias("_new"))
            joined = old.join(now, keys, "left").where("_new IS NULL OR NOT _new._deleted")
            columns = []
            for c in self.spec.columns:
                keep = F.col("_new").isNull() if c not in self.spec.insert_only else F.col("_new").isNull() | ~F.col("_new._reset")
                columns.append(F.when(keep, F.col(c)).otherwise(F.col(f"_new.{c}")).alias(c))
            out = joined.select(*columns).withColumn("bucket", self.bucket()).unionByName(out)
        number = newest + 1
        folder = f"{self.path}/data/generation={number}"
        out.write.mode("overwrite").partitionBy("bucket").parquet(folder)
        written = {r["bucket"] for r in spark.read.schema("bucket int").parquet(folder).select("bucket").distinct().collect()}
        after = {b: g for b, g in current.items() if b not in touched} | {b: number for b in written}
        self._publish(spark, number, after, applied if batch is None else batch)
        return touched

    def _publish(self, spark: SparkSession, number: int, current: dict[int, int], batch: int | None) -> None:
        rows = [(b, g, batch) for b, g in sorted(current.items())] or [(None, None, batch)]
        entry = spark.createDataFrame(rows, MANIFEST).coalesce(1)
        entry.write.mode("overwrite").parquet(f"{self.path}/manifest/generation={number}")

    def optimize(self, spark: SparkSession) -> None:
        """Write every bucket anew as one file; many upserts leave a bucket in small ones."""
        newest, batch, current = self.manifest(spark)
        rows = self._rows(spark, self._paths(current, None)).withColumn("bucket", self.bucket())
        folder = f"{self.path}/data/generation={newest + 1}"
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
        self._publish(spark, newest + 1, dict.fromkeys(current, newest + 1), batch)
