"""Distinct values in order, factorised matches, packed events."""

import json
import random

import pytest
from pyspark.sql import functions as F

from opsflow.operators import changes, matching, nested
from opsflow.operators.aggregates import column_values, profile_of_values
from tests.conftest import rows


@pytest.mark.parametrize("ranges", [1, 2, 9])
def test_values_are_numbered_in_order(spark, ranges):
    rng = random.Random(1)
    data = [(rng.choice(["b", "a", "ä", "", None]), rng.choice([10, 9, -1, None]), i % 137, rng.choice([2.5, 10.0, None])) for i in range(600)]
    df = spark.createDataFrame(data, "s string, n int, many long, d double").repartition(3)
    found = column_values(df, ["s", "n", "many", "d"], ranges)
    for at, name in enumerate(("s", "n", "many", "d")):
        values = sorted({r[at] for r in data} - {None})
        want = [(i, str(v), sum(r[at] == v for r in data)) for i, v in enumerate(values, 1)]
        got = sorted((r.place, r.value, r.n) for r in found.where(F.col("column") == name).collect())
        assert got == want
    plan = found._jdf.queryExecution().toString()
    assert "Expand" not in plan
    profile = {r["column"]: r for r in profile_of_values(found).collect()}
    assert (profile["many"].n_unique, profile["many"].lowest, profile["many"].highest) == (137, "0", "136")
    assert profile["n"].n_values == sum(r[1] is not None for r in data)


def test_values_of_nothing(spark):
    empty = spark.createDataFrame([], "s string, n int")
    assert column_values(empty, ["s", "n"]).collect() == []
    nulls = spark.createDataFrame([(None, None)], "s string, n int")
    assert column_values(nulls, ["s", "n"]).collect() == []


def test_a_key_hot_on_both_sides_is_not_multiplied(spark):
    side = lambda name: spark.range(10_050).select(
        F.when(F.col("id") < 10_000, F.lit("hot")).when(F.col("id") < 10_040, F.concat(F.lit(name), "id")).otherwise(F.concat(F.lit("k"), "id")).alias("k"),
        F.col("id").alias(name),
    )
    found = matching.match_groups(side("l"), side("r"), ["k"])
    assert rows(found.groups.where("k = 'hot'")) == [("hot", 10_000, 10_000, 10**8)]
    assert found.left.count() == found.right.count() == 10_010
    assert found.groups.agg(F.sum("n_pairs")).first()[0] == 10**8 + 10
    assert rows(found.one_to_one()) == rows(side("l").where("k like 'k%'").join(side("r"), "k"))
    few = found.pairs(F.col("n_pairs") < 100)
    assert few.count() == 10


def test_pairs_are_those_of_match_all(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), ("c", 5)], "k string, l int")
    right = spark.createDataFrame([("a", 1), ("a", 9), ("b", 8), (None, 7), ("d", 6)], "k string, r int")
    assert rows(matching.match_groups(left, right, ["k"]).pairs()) == rows(matching.match_all(left, right, ["k"]))


def test_precedence_by_groups_counts_the_pairs(spark):
    base = spark.createDataFrame([(i, i % 5, i % 7) for i in range(40)] + [(99, None, 1)], "id int, x int, y int")
    one = spark.createDataFrame([(0, "p"), (0, "q"), (1, "r"), (None, "n")], "x int, v string")
    two = spark.createDataFrame([(1, "s"), (2, "t"), (2, "u")], "y int, v string")
    three = spark.createDataFrame([(3, "w"), (4, "z")], "x int, v string")
    ranked, extra = [("one", one, ["x"]), ("two", two, ["y"])], [("three", three, ["x"])]
    pairs = matching.match_precedence(base, ranked, extra)
    want = rows(pairs.groupBy("id", "source").agg(F.count(F.lit(1)).alias("n")))
    assert rows(matching.precedence_groups(base, ranked, extra), "id", "source", "n") == want


def test_packed_events_with_odd_json(spark):
    package = {"items": [{"sku": "a", "quantity": 1, "order_item_qty": 2}], "tracking_numbers": ["T"], "manifest_courier": "ups"}
    event = lambda topic, **message: json.dumps({"topic": topic, "message": message})
    texts = [
        event("shipment:packed", order_unique_id="S1", packages=[package]),
        event("shipment:packed", order_unique_id="S2", packages=[package]).replace("shipment:packed", "shipment\\u003apacked"),
        event("other", order_unique_id="S3", packages=[package]),
        event("shipment:packed", order_unique_id="S4", packages="broken"),
        event("shipment:packed", order_unique_id="S5"), event("shipment:packed", order_unique_id="S6", packages=[{**package, "tracking_numbers": []}]),
        "{broken", "", None,
    ]
    found = nested.expand_packed_events(spark.createDataFrame([(t,) for t in texts], "j string"), "j")
    assert rows(found, "shipment_nbr", "inventory_cd", "tracking", "courier") == [("S1", "a", "T", "ups"), ("S2", "a", "T", "ups")]


def test_tagged_diff_equals_the_full_outer_join(spark):
    """Duplicate keys on either side and both, null keys, a hot key, keys of one state only."""
    rng = random.Random(5)
    side = lambda n: [(rng.choice([None, *range(12)]), rng.choice(["p", "q", None]), rng.randrange(3), i) for i in range(n)]
    hot = [(50, "h", 1, i) for i in range(300)]
    old = spark.createDataFrame([*side(12), *hot, (70, "o", 1, 1), (71, "o", 1, 1), (71, "o", 1, 2)], "k int, j string, m int, ts int")
    new = spark.createDataFrame([*side(12), (50, "h", 2, 9), (80, "n", 1, 1), (81, "n", 1, 1), (81, "n", 1, 2)], "k int, j string, m int, ts int")
    for keys in (["k"], ["k", "j"]):
        assert rows(changes.tagged_diff(old, new, keys)) == rows(changes.full_diff_join(old, new, keys))
        got = changes.metric_diff(old, new, keys, ["m"], "ts", changes.tagged_diff)
        want = changes.metric_diff(old, new, keys, ["m"], "ts")
        assert [rows(df) for df in got] == [rows(df) for df in want]
    empty = old.where("false")
    assert rows(changes.tagged_diff(empty, empty, ["k"])) == []
