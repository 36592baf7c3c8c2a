from datetime import datetime

import pytest
from pyspark.sql import functions as F

from opsflow import sources
from opsflow.operators import changes, tables
from opsflow.operators.tables import TableSpec
from opsflow.plans import contracts
from opsflow.session import scratch
from tests.conftest import rows

SPEC = TableSpec("t", "k STRING, v INT, first INT", keys=("k",), insert_only=("first",))


def updates(spark):
    return spark.createDataFrame(
        [("a", 5, 50, 1), ("a", None, 60, 2), ("new", 7, 70, 1), ("new", 8, 80, 2)], "k string, v int, first int, n int"
    )


def test_upsert_last_wins_and_insert_only_stays(spark):
    target = spark.createDataFrame([("a", 1, 10), ("keep", 2, 20)], SPEC.schema)
    merged = tables.upsert(target, updates(spark), SPEC, ["n"])
    assert rows(merged) == [("a", None, 10), ("keep", 2, 20), ("new", 8, 70)]


def test_upsert_twice_is_once(spark):
    target = spark.createDataFrame([("a", 1, 10)], SPEC.schema)
    once = tables.upsert(target, updates(spark), SPEC, ["n"])
    assert rows(tables.upsert(once, updates(spark), SPEC, ["n"])) == rows(once)


def test_fold_equals_upsert(spark):
    target = spark.createDataFrame([("a", 1, 10), ("keep", 2, 20)], SPEC.schema)
    together = target.withColumn("n", F.lit(0)).unionByName(updates(spark))
    assert rows(tables.fold(together, SPEC, ["n"])) == rows(tables.upsert(target, updates(spark), SPEC, ["n"]))


def test_conform(spark):
    loose = spark.createDataFrame([("x", "1", 2, "drop")], "k string, v string, first int, extra string")
    assert tables.conform(loose, SPEC).columns == ["k", "v", "first"]
    with pytest.raises(ValueError, match="first"):
        tables.conform(loose.drop("first"), SPEC)
    with pytest.raises(Exception, match="null in key k"):
        tables.conform(loose.withColumn("k", F.lit(None).cast("string")), SPEC).collect()


def test_contracts_are_sound():
    assert len(contracts.TABLES) == 26
    for spec in contracts.TABLES.values():
        assert set(spec.keys) <= set(spec.columns)
        assert set(spec.insert_only) <= set(spec.columns) - set(spec.keys)
    assert contracts.TABLES["sales_orders"].insert_only == ("disc_amt", "line_cost")


def test_create_table(spark):
    path = scratch(spark, "table")
    spec = TableSpec("made_here", "a INT", keys=("a",))
    tables.create_table(spark, spec, path)
    tables.create_table(spark, spec, path)
    assert spark.table("made_here").columns == ["a"]
    spark.sql("DROP TABLE made_here")


def test_write_snapshot(spark):
    spec = TableSpec("s", "k STRING, snapshot_at TIMESTAMP_NTZ", keys=("k",))
    history = scratch(spark, "history")
    first = spark.createDataFrame([], spec.schema)
    shots = [spark.createDataFrame([(k,) for k in keys], "k string") for keys in ("ab", "bc")]
    before = tables.write_snapshot(shots[0], datetime(2026, 1, 1), history, first, spec, ["snapshot_at"])
    for _ in range(2):  # the second snapshot runs again
        state = tables.write_snapshot(shots[1], datetime(2026, 1, 2), history, before, spec, ["snapshot_at"])
    assert [(k, at.day) for k, at in rows(state)] == [("a", 1), ("b", 2), ("c", 2)]
    assert spark.read.parquet(history).count() == 4


def test_metric_diff(spark):
    old = spark.createDataFrame([(1, 5, 1.0, "t0"), (2, 5, None, "t0"), (3, 1, 1.0, "t0")], "k int, m int, c double, ts string")
    new = spark.createDataFrame([(1, 5, 1.0, "t1"), (2, 6, None, "t1"), (4, 1, 1.0, "t1"), (None, 9, 9.0, "t1")], "k int, m int, c double, ts string")
    log, writes = changes.metric_diff(old, new, ["k"], ["m", "c"], "ts")
    assert rows(log, "k", "m_last", "m_current", "diff") == [(1, 5, 5, False), (2, 5, 6, True)]
    assert rows(writes, "k", "m") == [(2, 6), (4, 1), (None, 9)]
    _, nothing = changes.metric_diff(old, old, ["k"], ["m", "c"], "ts")
    assert nothing.count() == 0


def test_changed_blocks_ignores_case(spark):
    kind = "k int, who array<struct<name: string>>, tags array<string>"
    old = spark.createDataFrame([(1, [("Ann",)], ["a"]), (2, [("Ann",)], ["a"]), (3, None, ["a"])], kind)
    new = spark.createDataFrame([(1, [("ANN",)], ["A"]), (2, [("Bo",)], None), (3, [("Cy",)], ["b"])], kind)
    got = changes.changed_blocks(old, new, ["k"], ["who", "tags"])
    assert rows(got, "k", F.col("who.name"), "tags") == [(2, ["Bo"], None), (3, ["Cy"], ["b"])]


def test_changed_payloads(spark):
    frame = spark.createDataFrame([("new", "p"), ("same", "p"), ("other", "q"), ("mixed", "p")], "k string, p string")
    ledger = spark.createDataFrame([("same", "p"), ("other", "p"), ("mixed", "p"), ("mixed", "old")], "k string, p string")
    assert rows(changes.changed_payloads(frame, ledger, ["k"], "p"), "k") == [("mixed",), ("new",), ("other",)]
    assert changes.changed_payloads(frame, ledger.limit(0), ["k"], "p").count() == 4


def test_deletes_split_the_table(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1)], "k string, n int")
    stays, goes = changes.delete_by_keys(frame, spark.createDataFrame([("a",), ("a",), (None,)], "k string"), ["k"])
    assert rows(stays) == [("b", 1), (None, 1)] and rows(goes) == [("a", 1), ("a", 2)]
    assert rows(stays.unionByName(goes)) == rows(frame)
    assert rows(changes.delete_where(frame, F.col("k") == "a"), "k") == [("b",), (None,)]


def test_field_changes(spark):
    frame = spark.createDataFrame([(1, "a", "a", None, None), (2, "a", "b", None, "x")], "i int, a string, a2 string, b string, b2 string")
    got = changes.field_changes(frame, {"a": (F.col("a"), F.col("a2")), "b": (F.col("b"), F.col("b2"))})
    assert rows(got, "i", "field", "old", "new") == [(2, "a", "a", "b"), (2, "b", None, "x")]


def test_report_scan_with_bom(spark):
    path = scratch(spark, "bom")
    spark.createDataFrame([("﻿Day;Clicks",), ("2026-01-01;3",)], "value string").coalesce(1).write.text(path)
    report = sources.scan_report(spark, path)
    assert report.columns == ["Day", "Clicks"] and rows(report) == [("2026-01-01", "3")]
    with pytest.raises(ValueError, match="cost"):
        sources.canonicalize(report, {"day": ["Day"]}, ["day", "cost"])


def test_named_queries(spark):
    named = sources.NamedQueries({"big": "SELECT * FROM {t} WHERE n > :n"})
    frame = spark.createDataFrame([(1,), (5,)], "n int")
    assert rows(named.run(spark, "big", {"t": frame}, {"n": 3})) == [(5,)]
    with pytest.raises(KeyError):
        named.run(spark, "nope", {})


def test_json_scan_and_jdbc_free_scan(spark):
    path = scratch(spark, "json")
    spark.createDataFrame([(1, [("x",)])], "id int, lines array<struct<a: string>>").write.json(path)
    landed = sources.scan_json(spark, path, "id INT, lines ARRAY<STRUCT<a: STRING>>, missing STRING")
    assert landed.select("lines.a", "missing").first()[:] == (["x"], None)
