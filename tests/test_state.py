"""Tables in buckets, logs with deletes and compaction, rejects, seen ids, late sessions."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opsflow.operators import tables
from opsflow.operators.buckets import BucketTable, fold_changes
from opsflow.operators.tables import TableSpec
from opsflow.session import scratch
from opsflow.streaming import ChangeLog, first_seen, fold_sessions, file_stream, load_checked, rejected, session_counts, session_state
from tests.conftest import rows

SPEC = TableSpec("s", "k STRING, v INT, first INT", keys=("k",), insert_only=("first",))
ROW = "k string, v int, first int, n long, gone boolean"


def plain(batches):
    """The state after applying all rows in order, batch by batch."""
    state = {}
    for batch in batches:
        for k, v, first, _, gone in sorted(batch, key=lambda r: r[3]):
            if gone:
                state.pop(k, None)
            else:
                state[k] = (k, v, state[k][2] if k in state else first)
    return sorted(state.values(), key=repr)


def batches(seed, count=5, hot=False):
    rng, n, out = random.Random(seed), 0, []
    for _ in range(count):
        batch = []
        for _ in range(60):
            n += 1
            key = "k0" if hot and rng.random() < 0.5 else f"k{rng.randrange(25)}"
            batch.append((key, rng.randrange(100), n, n, rng.random() < 0.25))
        out.append(batch)
    return out


@pytest.mark.parametrize("seed, hot", [(1, False), (2, True)])
def test_deletes_and_reinserts(spark, seed, hot):
    parts = batches(seed, hot=hot)
    log, held = ChangeLog(scratch(spark, "log"), SPEC), BucketTable(scratch(spark, "held"), SPEC, buckets=8)
    assert rows(log.state(spark)) == rows(held.read(spark)) == []
    for number, part in enumerate(parts):
        frame = spark.createDataFrame(part, ROW)
        for _ in range(2):  # every batch runs twice
            log.write(frame, number, ["n"], F.col("gone"))
            held.upsert(frame, ["n"], F.col("gone"), batch=number)
        if number in (1, 2):
            assert log.compact(spark) == number
            log.write(frame, number, ["n"], F.col("gone"))  # and once more after it is in the base
        assert rows(log.state(spark)) == rows(held.read(spark)) == plain(parts[: number + 1])
    assert rows(fold_changes(spark.createDataFrame(sum(parts, []), ROW), SPEC, ["n"], F.col("gone")).where("NOT _deleted").select(*SPEC.columns)) == plain(parts)
    held.optimize(spark)
    assert rows(held.read(spark)) == plain(parts)


def test_a_batch_that_is_not_whole_is_not_read(spark):
    log = ChangeLog(scratch(spark, "log"), SPEC)
    log.write(spark.createDataFrame([("a", 1, 1, 1, False)], ROW), 0, ["n"])
    half = fold_changes(spark.createDataFrame([("b", 1, 1, 1, False)], ROW), SPEC, ["n"])
    half.write.parquet(f"{log.path}/changes/batch=1")
    assert rows(log.state(spark)) == [("a", 1, 1)]
    assert log.compact(spark) == 0
    log.write(spark.createDataFrame([("b", 2, 2, 1, False)], ROW), 1, ["n"])
    assert rows(log.state(spark)) == [("a", 1, 1), ("b", 2, 2)]


def test_upsert_rewrites_the_touched_buckets_only(spark):
    held = BucketTable(scratch(spark, "held"), SPEC, buckets=16)
    start = spark.range(400).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").cast("int").alias("v"), F.lit(0).alias("first"))
    held.upsert(start.withColumn("n", F.lit(0)), ["n"])
    files = lambda: {f for f in held.read(spark).inputFiles()}
    before = files()
    updates = spark.createDataFrame([("k7", -1, 9, 1, False), ("new", -2, 9, 1, False), ("k7", -3, 9, 2, False)], ROW)
    touched = held.upsert(updates, ["n"])
    assert 1 <= len(touched) <= 2
    kept = {f for f in before if not any(f"/bucket={b}/" in f for b in touched)}
    assert kept and kept <= files() and not (before - kept) & files()
    want = tables.upsert(start, updates, SPEC, ["n"])
    assert rows(held.read(spark)) == rows(want)
    assert rows(held.having(spark.createDataFrame([("new",), ("k7",), ("none",)], "k string"))) == [("k7", -3, 0), ("new", -2, 9)]
    held.upsert(spark.createDataFrame([], ROW), ["n"])
    assert rows(held.read(spark)) == rows(want)


def test_an_upsert_that_stops_before_its_manifest_is_not_seen(spark):
    held = BucketTable(scratch(spark, "held"), SPEC, buckets=2)
    held.upsert(spark.createDataFrame([("a", 1, 1, 1, False)], ROW), ["n"])
    lost = spark.createDataFrame([("a", 5, 5)], SPEC.schema).withColumn("bucket", held.bucket())
    lost.write.partitionBy("bucket").parquet(f"{held.path}/data/generation=1")
    assert rows(held.read(spark)) == [("a", 1, 1)]
    held.upsert(spark.createDataFrame([("b", 2, 2, 2, False)], ROW), ["n"])
    assert rows(held.read(spark)) == [("a", 1, 1), ("b", 2, 2)]


def test_bad_rows_are_set_aside_and_the_rest_is_loaded(spark):
    spec = TableSpec("p", "k BIGINT, price DOUBLE NOT NULL, day DATE", keys=("k",))
    loose = spark.createDataFrame(
        [("1", "2.5", "2026-01-01"), (None, "1", None), ("x", "1", None), ("2", None, "soon"), ("3", "4", None)], "k string, price string, day string"
    )
    loaded, rejects = {}, scratch(spark, "rejects")
    assert rejected(spark, rejects).collect() == []
    for _ in range(2):
        load_checked(loose, 4, spec, rejects, lambda good, number: loaded.update({number: rows(good.select("k", "price"))}))
    load_checked(loose.where("k = '3'"), 5, spec, rejects, lambda good, number: loaded.update({number: rows(good.select("k", "price"))}))
    assert loaded == {4: [(1, 2.5), (3, 4.0)], 5: [(3, 4.0)]}
    found = sorted((r.batch, r.errors, r.raw) for r in rejected(spark, rejects).collect())
    assert [(b, e) for b, e, _ in found] == [(4, ["k is no bigint"]), (4, ["null in column price", "day is no date"]), (4, ["null in key k"])]
    assert found[1][2] == '{"k":"2","day":"soon"}'
    with pytest.raises(ValueError, match="missing columns"):
        tables.checked(loose.drop("day"), spec)


def test_first_seen_reads_the_buckets_of_its_keys(spark):
    spec = TableSpec("seen", "id BIGINT, batch BIGINT", keys=("id",), insert_only=("batch",))
    ledger = BucketTable(scratch(spark, "seen"), spec, buckets=32)
    hot = [(7, i, "x") for i in range(500)]  # one id, many copies
    first = spark.createDataFrame([(1, 5, "a"), (1, 3, "b"), (2, 1, "c"), *hot], "id long, at long, what string")
    second = spark.createDataFrame([(2, 9, "d"), (3, 1, "e"), (7, 0, "y")], "id long, at long, what string")
    assert rows(first_seen(first, 0, ledger, ["at"])) == [(1, 3, "b"), (2, 1, "c"), (7, 0, "x")]
    for _ in range(2):
        assert rows(first_seen(second, 1, ledger, ["at"])) == [(3, 1, "e")]
    read = {f.split("/bucket=")[1].split("/")[0] for f in ledger.having(spark.createDataFrame([(3,)], "id long")).inputFiles() if "/bucket=" in f}
    assert len(read) == 1


def test_late_rows_join_sessions(spark):
    start, rng = datetime(2026, 1, 1), random.Random(3)
    data = [(u, start + timedelta(minutes=rng.randrange(3000))) for u in (1, 2) for _ in range(150)]
    rng.shuffle(data)
    path, slots = scratch(spark, "landed"), scratch(spark, "slots")
    for i in range(0, 300, 100):
        spark.createDataFrame(data[i : i + 100], "u int, ts timestamp").coalesce(1).write.mode("append").parquet(path)
    stream = file_stream(spark, path, spark.read.parquet(path).schema, max_files=1)
    fold_sessions(stream, ["u"], "ts", 1200, slots, scratch(spark, "checkpoint")).awaitTermination()
    want = session_counts(spark.createDataFrame(data, "u int, ts timestamp"), ["u"], "ts", 1200)
    assert rows(session_state(spark, ["u"], 1200, slots)) == rows(want)
    assert want.count() > 5
