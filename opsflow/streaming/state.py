"""State kept behind a stream: deletes, compaction beside it, bad rows set aside, ids seen.

Everything here is written per micro-batch, under the batch's number, and a batch that
runs again replaces or repeats exactly what it wrote before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StructType

from opsflow.operators.buckets import BucketTable, fold_changes
from opsflow.operators.skew import Order
from opsflow.operators.tables import TableSpec, checked, conform, fold
from opsflow.session import settle


def each_batch(stream: DataFrame, apply: Callable[[DataFrame, int], object], checkpoint: str) -> StreamingQuery:
    """Run ``apply(batch, batch_id)`` for all that is new, then stop."""
    return (
        stream.writeStream.foreachBatch(lambda batch, number: (apply(batch, number), None)[1])
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _read(spark: SparkSession, schema: StructType | str, path: str) -> DataFrame | None:
    """A folder that may not be there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
        return None


@dataclass(frozen=True)
class ChangeLog:
    """A keyed table as an append-only log of folded batches, with deletes.

    ``changes/batch=<n>`` holds a batch's last state per key; ``done/batch=<n>`` says that
    it is whole. ``compact`` may run beside the stream: it folds all whole batches into
    ``base/generation=<g>`` and then publishes ``pointer/generation=<g>`` (one small
    file), which names the last batch that is in it. Readers take the newest pointer and
    the batches after it; a reader in between sees the former base, which stays.
    """

    path: str
    spec: TableSpec

    def write(self, batch: DataFrame, number: int, order_by: Sequence[Order], deleted: Column | None = None) -> None:
        """Fold a batch per key and write it as its own partition."""
        spark = batch.sparkSession
        folded = conform(fold_changes(batch, self.spec, order_by, deleted), self.spec, extra=["_reset", "_deleted"])
        folded.write.mode("overwrite").parquet(f"{self.path}/changes/batch={number}")
        done = spark.createDataFrame([(True,)], "ok boolean").coalesce(1)
        done.write.mode("overwrite").parquet(f"{self.path}/done/batch={number}")

    def sync(
        self, stream: DataFrame, order_by: Sequence[Order], checkpoint: str, deleted: Column | None = None
    ) -> StreamingQuery:
        return each_batch(stream, lambda batch, number: self.write(batch, number, order_by, deleted), checkpoint)

    def _pointer(self, spark: SparkSession) -> tuple[int, int]:
        """The newest generation of the base and the last batch in it; -1 for none."""
        rows = _read(spark, "upto bigint, generation bigint", f"{self.path}/pointer")
        newest = None if rows is None else rows.agg(F.max(F.struct("generation", "upto"))).first()[0]
        return (-1, -1) if newest is None else (newest["generation"], newest["upto"])

    def _upto(self, spark: SparkSession) -> int:
        rows = _read(spark, "ok boolean, batch bigint", f"{self.path}/done")
        last = None if rows is None else rows.agg(F.max("batch")).first()[0]
        return -1 if last is None else last

    def _fold(self, spark: SparkSession, generation: int, after: int, upto: int) -> DataFrame:
        schema = self.spec.schema.add("_reset", BooleanType()).add("_deleted", BooleanType()).add("batch", LongType())
        log = _read(spark, schema, f"{self.path}/changes")
        rows = spark.createDataFrame([], schema) if log is None else log
        rows = rows.where((F.col("batch") > after) & (F.col("batch") <= upto))  # whole folders are pruned
        if generation >= 0:
            base = spark.read.schema(self.spec.schema).parquet(f"{self.path}/base/generation={generation}")
            no = F.lit(False)
            rows = rows.unionByName(base.withColumns({"_reset": no, "_deleted": no, "batch": F.lit(after).cast("bigint")}))
        # a batch that deletes a key holds only what came after the delete
        keys = list(self.spec.keys)
        last = rows.where("_reset").groupBy(*keys).agg(F.max("batch").alias("_at"))
        live = rows.join(last, keys, "left").where("_at IS NULL OR batch > _at OR (batch = _at AND NOT _deleted)")
        return fold(live, self.spec, ["batch"])

    def state(self, spark: SparkSession) -> DataFrame:
        """All whole batches applied in order."""
        generation, after = self._pointer(spark)
        return self._fold(spark, generation, after, self._upto(spark))

    def compact(self, spark: SparkSession) -> int:
        """A new base of all whole batches; the batch it reaches to. The stream may go on meanwhile."""
        generation, after = self._pointer(spark)
        upto = self._upto(spark)
        if upto > after:
            folded = self._fold(spark, generation, after, upto)
            folded.write.mode("overwrite").parquet(f"{self.path}/base/generation={generation + 1}")
            entry = spark.createDataFrame([(upto,)], "upto bigint").coalesce(1)
            entry.write.mode("overwrite").parquet(f"{self.path}/pointer/generation={generation + 1}")
        return max(upto, after)


def sync_buckets(
    stream: DataFrame, target: BucketTable, order_by: Sequence[Order], checkpoint: str, deleted: Column | None = None
) -> StreamingQuery:
    """Keyed upsert of a stream into a table in buckets; every batch rewrites what it touches."""
    return each_batch(stream, lambda batch, number: target.upsert(batch, order_by, deleted, number), checkpoint)


def load_checked(batch: DataFrame, number: int, spec: TableSpec, rejects: str, load: Callable[[DataFrame, int], object], extra: Sequence[str] = ()) -> None:
    """Load the good rows of a batch and set the bad ones aside.

    The batch is checked in one pass and written once; good rows (contracted and
    ``extra`` columns) go to ``load(rows, number)``, bad ones with their errors to
    ``rejects/batch=<number>``. A batch without bad rows leaves an empty folder there.
    """
    rows = settle(checked(batch, spec, extra), "checked-batch")
    bad = rows.where(F.size("_errors") > 0).select(F.col("_errors").alias("errors"), F.col("_raw").alias("raw"))
    bad.write.mode("overwrite").parquet(f"{rejects}/batch={number}")
    load(rows.where(F.size("_errors") == 0).drop("_errors", "_raw"), number)


def rejected(spark: SparkSession, rejects: str) -> DataFrame:
    """``batch, errors, raw`` of all rows set aside."""
    rows = _read(spark, "errors array<string>, raw string, batch bigint", rejects)
    return spark.createDataFrame([], "batch bigint, errors array<string>, raw string") if rows is None else rows.select("batch", "errors", "raw")


def first_seen(batch: DataFrame, number: int, ledger: BucketTable, order_by: Sequence[Order]) -> DataFrame:
    """For ``foreachBatch``: the first row of every key that no earlier batch had.

    ``ledger`` has the keys and a column ``batch``, insert-only. Copies collapse on the map
    side; of the ledger only the buckets of the batch's keys are read. The keys are
    put into the ledger under the batch's number, so a batch that runs again gets the
    same rows.
    """
    keys = list(ledger.spec.keys)
    rest = [c for c in batch.columns if c not in keys]
    once = batch.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order_by)).alias("_row")).select(*keys, "_row.*")
    once = settle(once.withColumn("_batch", F.lit(number).cast("bigint")), "once")
    ledger.upsert(once.select(*keys, F.col("_batch").alias("batch")), ["batch"], batch=number)
    mine = ledger.having(once).where(F.col("batch") == number).select(*keys)
    return once.drop("_batch").join(mine, keys, "left_semi")


def session_slots(batch: DataFrame, number: int, keys: Sequence[str], ts: str, gap_seconds: int, path: str) -> None:
    """A batch's rows as slots half a gap wide: first and last time and count, as a partition."""
    width = max(1, gap_seconds // 2) * 1_000_000
    micros = F.unix_micros(F.col(ts))
    slots = batch.groupBy(*keys, F.floor(micros / width).alias("slot")).agg(
        F.min(micros).alias("first"), F.max(micros).alias("last"), F.count(F.lit(1)).alias("n")
    )
    slots.write.mode("overwrite").parquet(f"{path}/batch={number}")


def fold_sessions(
    stream: DataFrame, keys: Sequence[str], ts: str, gap_seconds: int, path: str, checkpoint: str
) -> StreamingQuery:
    """Sessions of a stream, however late its rows are: read them with ``session_state``.

    Rows closer than the gap are in one session, so all rows of a slot are; slots of
    several batches are merged when they are read, and a late row may join two sessions.
    """
    return each_batch(stream, lambda batch, number: session_slots(batch, number, keys, ts, gap_seconds, path), checkpoint)


def session_state(spark: SparkSession, keys: Sequence[str], gap_seconds: int, path: str) -> DataFrame:
    """``keys, window_start, window_end, n`` of the sessions in all batches so far.

    Slots are merged before they are put in order, so the order is over at most two
    rows per key and gap of time.
    """
    from opsflow.streaming.jobs import sessions_of_slots

    slots = spark.read.parquet(path).groupBy(*keys, "slot").agg(
        F.min("first").alias("_from"), F.max("last").alias("_to"), F.sum("n").alias("_rows")
    )
    return sessions_of_slots(slots.withColumnRenamed("slot", "_slot"), keys, gap_seconds)
