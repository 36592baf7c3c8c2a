from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opsflow.operators import tables
from opsflow.operators.tables import TableSpec
from opsflow.session import scratch
from opsflow.streaming import (
    activity_windows, compact, current_state, dedupe_stream, file_stream, fold_windows, session_counts, sync_stream, unseen, window_state,
)
from opsflow.streaming.jobs import write_changes
from tests.conftest import rows

SPEC = TableSpec("s", "k STRING, v INT, first INT", keys=("k",), insert_only=("first",))
START = datetime(2026, 1, 1)


@pytest.fixture(scope="module")
def landed(spark):
    """Three files, written one after the other."""
    path = scratch(spark, "landed")
    for batch in range(3):
        data = [(f"k{i % 4}", batch * 10 + i, batch * 100 + i, START + timedelta(minutes=batch * 60 + i)) for i in range(6)]
        spark.createDataFrame(data, "k string, v int, first int, ts timestamp").coalesce(1).write.mode("append").parquet(path)
    return path


def test_sync_stream_equals_batch(spark, landed):
    schema = spark.read.parquet(landed).schema
    path, checkpoint = scratch(spark, "changes"), scratch(spark, "checkpoint")
    for _ in range(2):  # the second run finds nothing new
        sync_stream(file_stream(spark, landed, schema, max_files=1), SPEC, ["ts"], path, checkpoint).awaitTermination()
    batch = tables.fold(spark.read.parquet(landed), SPEC, ["ts"])
    assert rows(current_state(spark, SPEC, path)) == rows(batch)
    assert spark.read.parquet(path).select("batch").distinct().count() == 3
    target = scratch(spark, "compacted")
    compact(spark, SPEC, path, target)
    assert rows(current_state(spark, SPEC, target)) == rows(batch)


def test_replayed_batch_replaces_itself(spark):
    path = scratch(spark, "replay")
    frame = spark.createDataFrame([("a", 1, 1, 1), ("a", 2, 2, 2), ("b", 1, 1, 1)], "k string, v int, first int, n int")
    for batch in (0, 1, 1, 0):
        write_changes(frame, batch, SPEC, ["n"], path)
    assert spark.read.parquet(path).count() == 4
    assert rows(current_state(spark, SPEC, path)) == [("a", 2, 1), ("b", 1, 1)]


def drain(spark, stream, mode):
    path = scratch(spark, "out")
    (
        stream.writeStream.format("parquet").outputMode(mode).option("path", path)
        .option("checkpointLocation", scratch(spark, "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    )
    return spark.read.schema(stream.schema).parquet(path)


def test_dedupe_stream(spark, landed):
    schema = spark.read.parquet(landed).schema
    stream = file_stream(spark, landed, schema)
    got = drain(spark, dedupe_stream(stream, ["k"], "ts", "1 day"), "append")
    assert rows(got, "k") == [("k0",), ("k1",), ("k2",), ("k3",)]


def test_unseen(spark):
    batch = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, v int")
    ledger = spark.createDataFrame([("b",)], "k string")
    assert rows(unseen(batch, ledger, ["k"])) == [("a", 1)]


def test_windows_stream_equals_batch(spark, landed):
    frame = spark.read.parquet(landed)
    stream = file_stream(spark, landed, frame.schema)
    got = drain(spark, activity_windows(stream, ["k"], "ts", "tumbling", "30 minutes", delay="0 seconds"), "append")
    want = activity_windows(frame, ["k"], "ts", "tumbling", "30 minutes").where(F.col("window_end") <= F.lit(START + timedelta(minutes=125)))
    assert rows(got) == rows(want)
    with pytest.raises(ValueError):
        activity_windows(frame, ["k"], "ts", "hopping", "1 hour")
    with pytest.raises(ValueError):
        activity_windows(stream, ["k"], "ts", "tumbling", "30 minutes")


def test_fold_windows_keeps_late_rows(spark, landed):
    frame = spark.read.parquet(landed)
    # latest rows first, one file per micro-batch
    path = scratch(spark, "late")
    for part in (F.col("ts") >= F.lit(START + timedelta(minutes=60)), F.col("ts") < F.lit(START + timedelta(minutes=60))):
        frame.where(part).coalesce(1).write.mode("append").parquet(path)
    stream = file_stream(spark, path, frame.schema, max_files=1)
    out, checkpoint = scratch(spark, "folded"), scratch(spark, "checkpoint")
    for _ in range(2):  # the second run has nothing to add
        fold_windows(stream, ["k"], "ts", "sliding", "1 hour", out, checkpoint, slide="30 minutes").awaitTermination()
    want = activity_windows(frame, ["k"], "ts", "sliding", "1 hour", "30 minutes")
    assert rows(window_state(spark, ["k"], out)) == rows(want)


def test_session_counts_equal_session_windows(spark):
    gaps = [0, 1, 59, 60, 61, 120, 30, 29, 31, 60, 0, 0, 200]
    data, at = [], START
    for i, gap in enumerate(gaps * 3):
        at += timedelta(seconds=gap)
        data.append(("hot" if i % 3 else f"u{i % 2}", at))
    frame = spark.createDataFrame(data, "u string, ts timestamp")
    plain = activity_windows(frame, ["u"], "ts", "session", "60 seconds")
    assert rows(session_counts(frame, ["u"], "ts", 60)) == rows(plain)
