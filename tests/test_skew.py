"""Hot groups: a third of all rows in one key, nulls as a group, exact results."""

import random

import pytest
from pyspark.sql import Window, functions as F

from opsflow.operators import joins, nested, windows
from opsflow.operators.skew import Skew, group_pieces, join_in_place, range_pieces, sort_columns, spread_join
from tests.conftest import rows

SKEW = Skew(pieces=12, min_rows=20)


@pytest.fixture(scope="module")
def skewed(spark):
    """600 rows: key 'hot' holds a third, null a fifth, the rest are small groups."""
    rng = random.Random(7)
    data = []
    for i in range(600):
        key = "hot" if i % 3 == 0 else None if i % 5 == 1 else f"k{i % 90}"
        data.append((key, rng.choice([None, 1, 2, 3]), i, float(rng.randint(1, 9)), "x" if i % 4 else None))
    return spark.createDataFrame(data, "k string, a int, id bigint, v double, s string").repartition(5)


ORDER = [("a", "desc"), "id"]


def test_group_pieces_is_bounded(skewed):
    pieces = {r["k"]: (r["_rows"], r["_pieces"]) for r in group_pieces(skewed, ["k"], SKEW).collect()}
    assert set(pieces) == {"hot", None}
    assert pieces["hot"][0] == 200
    assert sum(p for _, p in pieces.values()) <= 2 * SKEW.pieces


def test_search_without_hot_groups_never_counts_single_keys(spark, monkeypatch):
    from opsflow.operators import skew

    written, settle = [], skew.settle
    monkeypatch.setattr(skew, "settle", lambda df, name: (written.append(df.columns), settle(df, name))[1])
    assert group_pieces(spark.range(5000).withColumnRenamed("id", "k"), ["k"], SKEW) is None
    assert written == [["_bucket", "_filled"]]


def test_no_hot_groups_means_plain_plan(skewed):
    assert group_pieces(skewed, ["k"]) is None
    assert range_pieces(skewed, ["k"], ORDER)[1] is None
    plan = windows.with_sequence(skewed, ["k"], ORDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window ") == 1 and "Join" not in plan


def test_range_pieces_split_the_hot_group(skewed):
    cut, _ = range_pieces(skewed, ["k"], ORDER, SKEW)
    sizes = {(r["k"], r["_piece"]): r["count"] for r in cut.groupBy("k", "_piece").count().collect()}
    hot = [n for (k, _), n in sizes.items() if k == "hot"]
    assert sum(hot) == 200 and len(hot) >= 3 and max(hot) < 150
    assert all(piece == 0 for k, piece in sizes if k not in ("hot", None))


@pytest.mark.parametrize("order", [ORDER, ["id"], ["s", ("v", "desc"), "id"]])
def test_sequence_equals_plain_window(skewed, order):
    plain = skewed.withColumn(
        "seq", F.row_number().over(Window.partitionBy("k").orderBy(*sort_columns(order))).cast("bigint")
    )
    assert rows(windows.with_sequence(skewed, ["k"], order, skew=SKEW), "id", "seq") == rows(plain, "id", "seq")
    assert rows(windows.with_sequence(skewed, ["k"], order), "id", "seq") == rows(plain, "id", "seq")


def test_group_total_equals_plain_window(skewed):
    over = Window.partitionBy("k")
    plain = skewed.withColumn("t", F.sum("v").over(over)).withColumn("n", F.count("a").over(over))
    total = windows.with_group_total(skewed, ["k"], {"t": F.sum("v"), "n": F.count("a")}, SKEW)
    assert rows(total, "id", "t", "n") == rows(plain, "id", "t", "n")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_join(spark, skewed, how):
    side = spark.createDataFrame([("hot", 1), ("k1", 2), (None, 3), ("zz", 4)], "k string, w int")
    got = spread_join(skewed, side, ["k"], how, skew=SKEW)
    want = skewed.join(side, ["k"], how)
    columns = [c for c in want.columns]
    assert rows(got.select(columns)) == rows(want)


def test_spread_join_null_safe(spark, skewed):
    side = spark.createDataFrame([("hot", 1), (None, 3)], "k string, w int")
    got = spread_join(skewed, side, ["k"], "left", skew=SKEW, null_safe=True)
    assert got.where("w = 3").count() == skewed.where("k is null").count()
    assert got.count() == 600


def test_collect_parts_hold_every_row_in_order(skewed):
    parts = nested.collect_parts(skewed, ["k"], ["id"], F.col("id"), "ids", part_rows=30, skew=SKEW)
    seen = {}
    for r in sorted(parts.collect(), key=lambda r: (str(r["k"]), r["piece"], r["part"])):
        assert len(r["ids"]) <= 30 and r["ids"] == sorted(r["ids"])
        seen.setdefault(r["k"], []).extend(r["ids"])
    want = {}
    for r in skewed.orderBy("id").collect():
        want.setdefault(r["k"], []).append(r["id"])
    assert seen == want


def test_cuts_depend_on_the_group_alone(spark, skewed):
    def of_hot(frame):
        parts = nested.collect_parts(frame, ["k"], ["id"], F.col("id"), "ids", part_rows=30, skew=SKEW)
        return rows(parts.where("k = 'hot'"), "piece", "part", "ids")

    more = skewed.where("k <> 'hot'")
    grown = skewed.unionByName(more.withColumn("id", F.col("id") + 10_000)).unionByName(more.withColumn("id", F.col("id") + 20_000))
    assert of_hot(grown) == of_hot(skewed)


def test_order_documents_in_parts_keep_facts_of_the_whole(spark):
    data = [("S1", n, "a", 1, "x" if n < 4 else "y", "PO", "r") for n in range(5)] + [
        ("S2", 1, "a", 2, "x", "PO", "r"), ("S2", 2, "a", 3, "y", "PO", "r"), ("S3", 1, "a", 2, "x", "SO", "r"), ("S3", 2, "b", 3, "x", "SO", "r"),
    ]
    lines = spark.createDataFrame(data, "shipment_nbr string, n int, item string, qty int, level string, order_type string, customer_ref string")

    def found(**page):
        docs = nested.order_documents(lines, ["n"], "y", "PO", **page)
        flat = docs.select("shipment_nbr", "shipping_method", "reference", F.posexplode("lines").alias("at", "line"), "part")
        return rows(flat.select("shipment_nbr", "shipping_method", "reference", "line.sku", "line.qty"))

    whole = found()
    assert [r for r in whole if r[0] == "S2"] == [("S2", "x", "r", "a", 5)]
    for size in (1, 2, 3):
        assert found(part_rows=size) == whole


def test_xml_parts_carry_the_first_head(spark):
    lines = spark.createDataFrame([("k", n, f"h{n}") for n in range(5)], "k string, n int, h string")
    xml = nested.render_xml(lines, "k", ["n"], {"H": F.col("h")}, {"N": F.col("n").cast("string")}, "r", "row", part_rows=2)
    assert [x[0].count("<H>h0</H>") for x in rows(xml, "xml")] == [1, 1, 1]


def test_collect_parts_by_weight(skewed):
    parts = nested.collect_parts(
        skewed, ["k"], ["id"], F.col("id"), "ids", part_rows=50, weight=F.col("v").cast("int"), skew=SKEW
    )
    assert parts.agg(F.sum(F.size("ids"))).first()[0] == 600
    assert parts.agg(F.max("weight")).first()[0] < 50 + 9


def test_completion_label_with_hot_group(skewed):
    args = ("k", "a", "v", "v", "s", "s", "label")
    assert rows(windows.completion_label(skewed, *args, skew=SKEW), "id", "label") == rows(
        windows.completion_label(skewed, *args), "id", "label"
    )


def test_ledger_and_group_tests_with_hot_group(skewed):
    ledger = skewed.where("id % 2 = 0 and k <> 'hot'").select("k")
    assert rows(joins.not_in_ledger(skewed, ledger, ["k"], SKEW), "id") == rows(
        skewed.join(ledger.distinct(), "k", "left_anti"), "id"
    )
    assert rows(joins.conflicting_rows(skewed, "k", "a", SKEW), "id") == rows(joins.conflicting_rows(skewed, "k", "a"), "id")
    assert rows(joins.differs_from_first(skewed, ["k"], "a", "s", SKEW), "id") == rows(
        joins.differs_from_first(skewed, ["k"], "a", "s"), "id"
    )


def test_nest_orders_splits_a_hot_order(spark):
    """One order with a third of all lines: parts together equal the whole."""
    detail = []
    for i in range(300):
        order = "A" if i % 3 == 0 else f"o{i % 40}"
        ship = None if i % 7 == 0 else f"{order}-s{i % 5}"
        detail.append((order, i, f"i{i}", 1, "w", ship, None if ship is None else i, None, None, 1, f"t{i % 11}", None))
    frame = spark.createDataFrame(
        detail,
        "order_nbr string, line_nbr int, inventory_cd string, line_qty int, warehouse string, shipment_nbr string, "
        "ship_line_nbr int, ship_date date, ship_status string, ship_line_qty int, tracking string, tracking_created timestamp_ntz",
    )
    orders = spark.createDataFrame([("A",), ("o1",), ("empty",)], "order_nbr string")

    def lines(docs):
        found = []
        for doc in docs.collect():
            for line in doc["line_items"]:
                for shipment in line["shipments"]:
                    packs = [p["tracking"] for p in shipment["packages"]]
                    found += [(doc["order_nbr"], line["line_nbr"], shipment["shipment_nbr"], p) for p in packs or [None]]
        return sorted(found, key=repr)

    whole = nested.nest_orders(orders, frame)
    split = nested.nest_orders(orders, frame, part_rows=8, skew=Skew(pieces=10, min_rows=20))
    assert whole.count() == 3
    assert whole.where("order_nbr = 'empty'").first()["line_items"] == []
    assert split.where("order_nbr = 'A'").count() > 3
    assert lines(split) == lines(whole)


def test_spread_join_takes_nested_columns(spark, skewed):
    nested_columns = skewed.withColumns({"m": F.create_map(F.lit("a"), "v"), "xs": F.array("id"), "st": F.struct("id")})
    side = spark.createDataFrame([("hot", 1)], "k string, w int")
    assert spread_join(nested_columns, side, ["k"], "inner", skew=SKEW).count() == 200


def test_size_shuffles_never_lowers(spark):
    from opsflow.session import size_shuffles

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 1) == int(before)
        assert size_shuffles(spark, 100 << 30) == 800
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_one_shuffle_serves_both_windows_of_a_label(spark):
    lines = spark.range(50).selectExpr("id % 9 AS o", "id % 4 AS i", "id AS own", "id AS q", "'x' AS s", "CAST(NULL AS STRING) AS p")
    assert shuffles(windows.completion_label(lines.repartition(3), "o", "i", "own", "q", "s", "p")) == 1


def test_partitions_grow_with_the_rows(spark):
    lines = spark.range(1000).selectExpr("id % 100 AS k")
    assert windows.dealt(lines, ["k"], lines, None, most=10).rdd.getNumPartitions() == 100
    assert windows.dealt(lines, ["k"], lines, None) is lines
    assert windows.dealt(lines, ["k"], lines, lines, most=10) is lines


def test_nested_orders_deal_distinct_rows_where_they_are_joined(spark):
    detail = spark.createDataFrame(
        [("o", 1, 5, 1, 0, "S", 1, None, "Done", 1, 7, None)],
        "order_nbr string, line_nbr int, inventory_cd int, line_qty int, warehouse int, shipment_nbr string, ship_line_nbr int,"
        " ship_date date, ship_status string, ship_line_qty int, tracking int, tracking_created date",
    )
    docs = spark.createDataFrame([("o", "F")], "order_nbr string, status string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert shuffles(nested.nest_orders(docs, detail)) <= 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_join_in_place_is_a_left_join_without_shuffle(spark):
    left = spark.createDataFrame([(1, 1, "a"), (1, 1, "a"), (1, 2, "b"), (1, None, "c"), (None, 1, "d"), (2, 1, None)], "o int, l int, v string")
    right = spark.createDataFrame([(1, 1, 10), (1, 1, 11), (1, None, 12), (None, 1, 13), (2, 1, None), (3, 1, 14)], "o int, l int, w int")
    joined = join_in_place(left.repartition("o"), right.repartition("o"), ["o", "l"])
    assert joined.columns == ["o", "l", "v", "w"]
    assert shuffles(joined) == 2
    assert rows(joined) == rows(left.join(right, ["o", "l"], "left"))


def test_nested_orders_shuffle_their_rows_once(spark):
    """Lines, shipments, packages and orders: no shuffle of a step after these, so none of nested rows."""
    detail = spark.createDataFrame(
        [("o", 1, 5, 1, 0, "S", 1, None, "Done", 1, 7, None)],
        "order_nbr string, line_nbr int, inventory_cd int, line_qty int, warehouse int, shipment_nbr string, ship_line_nbr int,"
        " ship_date date, ship_status string, ship_line_qty int, tracking int, tracking_created date",
    )
    docs = spark.createDataFrame([("o", "F"), ("none", "F")], "order_nbr string, status string")
    nest = nested.nest_orders(docs, detail)
    assert shuffles(nest) == 4
    found = {r["order_nbr"]: r for r in nest.collect()}
    assert [len(found[o]["line_items"]) for o in ("o", "none")] == [1, 0]
    assert [(found[o]["piece"], found[o]["part"]) for o in ("o", "none")] == [(0, 0), (0, 0)]


def test_dealt_frames_share_partitions_that_grow_with_the_rows(spark):
    lines = spark.range(1000).selectExpr("id % 100 AS k", "id AS v")
    deal = windows.dealer(["k"], lines, most=10)
    joined = join_in_place(deal(lines), deal(lines.selectExpr("k", "v", "v AS w")), ["k", "v"])
    assert joined.rdd.getNumPartitions() == 100
    assert joined.where("v = w").count() == 1000
    assert windows.dealer(["k"], lines)(lines).rdd.getNumPartitions() == 2
