from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from opsflow.operators import aggregates, joins, matching, nested, rows as row_ops, windows
from opsflow.operators.joins import Lookup
from tests.conftest import rows


def test_enrich_roles_and_missing(spark):
    fact = spark.createDataFrame([(1, 10, 11), (2, 10, None), (3, 99, 10)], "id int, a int, b int")
    dim = spark.createDataFrame([(10, "x"), (11, "y"), (None, "never")], "k int, name string")
    wide = joins.enrich(fact, [Lookup(dim, {"a": "k"}, {"an": "name"}), Lookup(dim, {"b": "k"}, {"bn": "name"})])
    assert rows(wide, "id", "an", "bn") == [(1, "x", "y"), (2, "x", None), (3, None, "x")]
    inner = joins.enrich(fact, [Lookup(dim, {"b": "k"}, {}, "inner")])
    assert rows(inner, "id") == [(1,), (3,)]


def test_attach_attributes_is_one_join(spark):
    fact = spark.createDataFrame([("r1",), ("r2",)], "note string")
    kv = spark.createDataFrame([("r1", "A", 1.0, None), ("r1", "B", None, "t"), ("r1", "C", 9.0, None)], "record_id string, field_name string, n double, s string")
    wide = joins.attach_attributes(fact, kv, {"note": "record_id"}, {"a": ("A", "n"), "b": ("B", "s")})
    assert rows(wide) == [("r1", 1.0, "t"), ("r2", None, None)]
    assert wide._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_ranked_conflicts(spark):
    frame = spark.createDataFrame([("o1", "Open"), ("o1", "Done"), ("o1", "Open"), ("o2", "Open"), ("o3", None), (None, "Open"), (None, "Done")], "o string, s string")
    rank = F.when(F.col("s") == "Done", 1).otherwise(6)
    assert rows(joins.ranked_conflicts(frame, "o", "s", rank)) == [("o1", "Done", "Open", 1)]


def test_differs_from_first_drops_rows_without_first(spark):
    frame = spark.createDataFrame([("s", 1, "a"), ("s", 2, "a"), ("s", 3, "b"), ("t", 2, "x"), ("u", 1, None), ("u", 2, "x")], "k string, n int, v string")
    assert rows(joins.differs_from_first(frame, ["k"], "n", "v"), "k", "n") == [("s", 1), ("s", 3), ("u", 1)]


def test_last_unless_default(spark):
    frame = spark.createDataFrame(
        [("a", 1, "X"), ("a", 2, "D"), ("b", 1, "D"), ("c", 1, "D"), ("c", 2, "D"), ("d", 1, "D"), ("d", 2, "Y")], "k string, n int, v string"
    )
    assert rows(windows.last_unless_default(frame, ["k"], ["n"], "v", "D")) == [("a", "X"), ("b", "D"), ("c", "D"), ("d", "Y")]


def test_match_first_and_precedence(spark):
    base = spark.createDataFrame([("s1", 1), ("s2", 1), ("s3", 1)], "k string, n int")
    one = spark.createDataFrame([("s1", "t1"), ("s1", "t2")], "k string, t string")
    two = spark.createDataFrame([("s1", "no"), ("s2", "u")], "k string, t string")
    three = spark.createDataFrame([("s1", "z")], "k string, t string")
    assert rows(matching.match_first(base, one, ["k"], ["t"]), "k", "t") == [("s1", "t1")]
    got = matching.match_precedence(base, [("one", one, ["k"]), ("two", two, ["k"])], [("three", three, ["k"])])
    assert rows(got, "k", "t", "source") == [("s1", "t1", "one"), ("s1", "t2", "one"), ("s1", "z", "three"), ("s2", "u", "two")]


def test_reconcile_quantities(spark):
    lines = spark.createDataFrame([("s1", "a", 1), ("s1", "a", 2), ("s1", "b", 1), ("s2", "a", 5), ("s3", "a", 1)], "s string, i string, q int")
    packed = spark.createDataFrame([("s1", "a", 3), ("s1", "b", 9), ("s1", "only", 4), ("s2", "a", 5)], "s string, i string, q int")
    checked = aggregates.reconcile_quantities(lines, packed, "s", "i", "q", "q")
    assert rows(checked) == [("s1", 2, False, True), ("s2", 1, True, True), ("s3", 1, False, False)]
    keys = spark.createDataFrame([("s2",), ("none",)], "s string")
    assert rows(aggregates.reconcile_keys(keys, checked, "s")) == [("none", 0, True, False), ("s2", 1, True, True)]


def test_todate_counts_zero_fill(spark):
    events = spark.createDataFrame([("a", datetime(2026, 12, 30)), ("a", datetime(2026, 1, 5)), ("a", None), (None, datetime(2026, 12, 30))], "rep_name string, ts timestamp_ntz")
    known = spark.createDataFrame([("b",)], "rep_name string")
    got = aggregates.todate_counts(events, "rep_name", "ts", datetime(2026, 12, 31), known)
    assert rows(got, "rep", "window", "n") == [
        ("a", "month", 1), ("a", "week", 1), ("a", "year", 2), ("b", "month", 0), ("b", "week", 0), ("b", "year", 0)
    ]


def test_timeseries_fills_days(spark):
    frame = spark.createDataFrame([("x", date(2026, 1, 2), 5), ("y", date(2025, 1, 1), 5)], "d string, day date, v int")
    report = aggregates.timeseries_report(frame, ["d"], F.col("day"), {"s": F.sum("v")}, date(2026, 1, 1), date(2026, 1, 3))
    assert rows(report) == [("x", date(2026, 1, 1), 0), ("x", date(2026, 1, 2), 5), ("x", date(2026, 1, 3), 0)]


def test_empty_inputs(spark):
    frame = spark.createDataFrame([], "k string, n int, v string")
    assert windows.with_sequence(frame, ["k"], ["n"]).count() == 0
    assert windows.top1(frame, ["k"], ["n"]).count() == 0
    assert nested.collect_parts(frame, ["k"], ["n"], F.col("v"), "vs").count() == 0
    assert joins.conflicting_rows(frame, "k", "v").count() == 0
    assert row_ops.sorted_distinct(frame, "v").count() == 0


def test_flatten_lines_and_variant(spark):
    frame = spark.createDataFrame(
        [("r1", "W", [("a", "b")]), ("r2", "3", [("a", "b"), ("c", "d")]), ("r3", "Z", [("a", "b")]), ("r4", "W", []), ("r5", "W", None)],
        "id string, kind string, lines array<struct<rp: string, df: string>>",
    )
    assert rows(nested.flatten_lines(frame, "lines", {"id": F.col("id")}, {"x": "rp"})) == [("r1", "a"), ("r2", "a"), ("r2", "c"), ("r3", "a")]
    got = nested.flatten_variant(
        frame, "lines", "kind", {"id": F.col("id")}, {}, {"item": {"W": "rp", "3": "df"}}, {"only_w": ("W", F.lit("y"))}
    )
    assert rows(got) == [("r1", "a", "y"), ("r2", "b", None), ("r2", "d", None), ("r3", None, None)]


def test_expand_packed_events_edges(spark):
    def event(topic, packages):
        import json

        return (json.dumps({"topic": topic, "message": {"order_unique_id": "S1", "packages": packages}}),)

    items = [{"sku": "a", "quantity": 1, "order_item_qty": 2}, {"sku": "b", "quantity": 3, "order_item_qty": 4}]
    feed = [
        event("shipment:packed", [{"manifest_courier": "c", "items": items, "tracking_numbers": ["t1", "t2"]}]),
        event("shipment:packed", [{"manifest_courier": "c", "items": items, "tracking_numbers": ["t"]}]),
        event("shipment:packed", [{"manifest_courier": "c", "items": items, "tracking_numbers": []}]),
        event("other", [{"manifest_courier": "c", "items": items, "tracking_numbers": ["t"]}]),
        event(
            "shipment:packed",
            [{"manifest_courier": "c1", "items": items[:1], "tracking_numbers": ["p"]}, {"manifest_courier": "c2", "items": items[1:], "tracking_numbers": ["q"]}],
        ),
        ("{broken",),
        (None,),
    ]
    got = nested.expand_packed_events(spark.createDataFrame(feed, "j string"), "j")
    assert rows(got, "inventory_cd", "tracking", "courier") == [
        ("a", "p", "c1"), ("a", "t", "c"), ("a", "t1", "c"), ("b", "q", "c2"), ("b", "t", "c"), ("b", "t2", "c")
    ]


def test_order_documents_merge_rule(spark):
    lines = spark.createDataFrame(
        [("s1", "a", 1, "L1", "RT", "ref", 1), ("s1", "a", 2, "L2", "RT", "ref", 2), ("s2", "a", 1, "L1", "SO", "ref", 1),
         ("s2", "b", 1, "D", "SO", "ref", 2), ("s3", "a", 1, "D", "SO", None, 1), ("s3", "a", 1, "D", "SO", None, 2), ("s3", "a", 1, "D", "SO", None, 3)],
        "shipment_nbr string, item string, qty int, level string, order_type string, customer_ref string, n int",
    )
    docs = nested.order_documents(lines, ["n"], "D", "RT")
    got = {r["shipment_nbr"]: r for r in docs.collect()}
    assert [(l["sku"], l["qty"], l["shipVia"]) for l in got["s1"]["lines"]] == [("a", 3, "L1")]
    assert got["s1"]["reference"] == "ref" and got["s2"]["reference"] is None
    assert [l["shipVia"] for l in got["s2"]["lines"]] == ["L1", "L1"]
    assert len(got["s3"]["lines"]) == 3 and got["s3"]["shipping_method"] == "D"


def test_current_shipment(spark):
    frame = spark.createDataFrame(
        [("one", [("s1", datetime(2020, 1, 1))]), ("two", [("s1", datetime(2020, 1, 1)), ("s2", datetime(2026, 1, 1))]),
         ("old", [("s1", datetime(2020, 1, 1)), ("s2", datetime(2020, 1, 1))]), ("none", [])],
        "order_nbr string, shipments array<struct<shipment_nbr: string, modified_at: timestamp_ntz>>",
    ).withColumns({c: F.lit("x") for c in ("order_type", "customer_id", "description", "ext_ref")})
    got = nested.current_shipment(frame, F.lit(datetime(2025, 1, 1)).cast("timestamp_ntz"))
    assert rows(got, "order_nbr", "shipment_nbr", "customer_id") == [("none", None, None), ("old", None, None), ("one", "s1", "x"), ("two", "s2", "x")]


def test_classify_replies(spark):
    bodies = [
        (200, "<a><CreateNewResult><Message>OK</Message><RMANumber>7</RMANumber></CreateNewResult></a>"),
        (200, "<a><CreateNewResult><Message>RMA already exists</Message></CreateNewResult></a>"),
        (500, "gone"),
        (500, None),
    ]
    got = nested.classify_replies(spark.createDataFrame(bodies, "status_code int, body string"))
    assert [(r["reply"], r["failed"]) for r in got.collect()] == [
        ("200 OK: 7 posted successfully!", False),
        ("200 ERROR: RMA already exists", False),
        ("500 ERROR: Error parsing response", True),
        ("500 ERROR: Error parsing response", True),
    ]


def test_unknown_order_direction(spark):
    frame = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        windows.top1(frame, [], [("a", "down")])
