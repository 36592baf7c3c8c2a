"""Documents in long form: of any length, in exact order, cut only where asked, told apart by digests."""

import pytest
from pyspark.sql import functions as F

from opsflow.operators import longform, nested
from opsflow.operators.longform import Level, changed_documents, digests, document_nodes, leaves_of, order_nodes, pages, xml_chunks
from opsflow.plans import sending
from tests.conftest import rows

LARGE = 25_000
DETAIL = (
    "order_nbr string, line_nbr int, inventory_cd int, line_qty int, warehouse int, shipment_nbr string, ship_line_nbr int,"
    " ship_date date, ship_status string, ship_line_qty int, tracking int, tracking_created date"
)


@pytest.fixture(scope="module")
def detail(spark):
    """One order of 25,000 lines, a small one whose lines share a shipment of two packages, one without lines."""
    large = spark.range(LARGE).select(
        F.lit("big").alias("order_nbr"), F.col("id").cast("int").alias("line_nbr"), (F.col("id") % 7).cast("int").alias("inventory_cd"),
        F.lit(2).alias("line_qty"), F.lit(1).alias("warehouse"), *[F.lit(None).cast(t).alias(n) for n, t in (
            ("shipment_nbr", "string"), ("ship_line_nbr", "int"), ("ship_date", "date"), ("ship_status", "string"),
            ("ship_line_qty", "int"), ("tracking", "int"), ("tracking_created", "date"))],
    )
    small = [("s", line, 5, 1, 0, "S1", line, None, "Done", 1, tracking, None) for line in (1, 2) for tracking in (8, 9)]
    return large.unionByName(spark.createDataFrame(small, DETAIL))


@pytest.fixture(scope="module")
def nodes(spark, detail):
    orders = spark.createDataFrame([("big", "O"), ("s", "F"), ("none", "P")], "order_nbr string, status string")
    return order_nodes(orders, detail, {"status": F.col("status")})


def test_every_line_has_its_exact_place(nodes):
    big = nodes.where("order_nbr = 'big' AND path = 'line_items'")
    assert big.count() == LARGE
    assert big.where("get(at, 0) <> cast(leaves['line_nbr'] as bigint) + 1").count() == 0
    assert big.where("size(at) <> 1").count() == 0


def test_nested_places_and_leaves(nodes):
    got = rows(leaves_of(nodes.where("order_nbr IN ('s', 'none')"), ["order_nbr"]))
    want = [("none", "$", "", "status", "P"), ("s", "$", "", "status", "F")]
    for a in (1, 2):
        line = {"line_nbr": a, "inventory_cd": 5, "line_qty": 1, "warehouse": 0}
        ship = {"shipment_nbr": "S1", "ship_line_nbr": a, "ship_date": None, "ship_status": "Done", "ship_line_qty": 1}
        want += [("s", "line_items", f"{a}", n, str(v)) for n, v in line.items()]
        want += [("s", "line_items.shipments", f"{a}.1", n, None if v is None else str(v)) for n, v in ship.items()]
        for c, tracking in ((1, 8), (2, 9)):
            want += [("s", "line_items.shipments.packages", f"{a}.1.{c}", "tracking", str(tracking)),
                     ("s", "line_items.shipments.packages", f"{a}.1.{c}", "tracking_created", None)]
    assert got == sorted(want, key=repr)


def test_pages_hold_all_nodes_in_document_order(nodes):
    cut = pages(nodes, ["order_nbr"], 1000)
    sizes = sorted(map(tuple, cut.where("order_nbr = 'big'").select("page", F.size("nodes")).collect()))
    total = 2 * LARGE + 1  # root, lines, and a shipment without a number under each
    assert sizes == [(i, min(1000, total - 1000 * i)) for i in range(-(-total // 1000))]
    (small,) = cut.where("order_nbr = 's'").collect()
    assert [list(n.at) for n in small.nodes] == sorted(list(n.at) for n in small.nodes)
    assert [n.path.count(".") for n in small.nodes] == [0, 0, 1, 2, 2, 0, 1, 2, 2]


def test_one_changed_leaf_sends_one_document(nodes):
    ledger = digests(nodes, ["order_nbr"])
    assert changed_documents(nodes, ["order_nbr"], ledger).collect() == []
    shuffled = nodes.repartition(5, "at")
    assert changed_documents(shuffled, ["order_nbr"], ledger).collect() == []
    one = (F.col("order_nbr") == "big") & (F.col("path") == "line_items") & (F.get("at", F.lit(0)) == 20_000)
    edited = F.when(one, F.create_map(F.lit("line_nbr"), F.lit("x"))).otherwise(F.col("leaves"))
    due = changed_documents(nodes.withColumn("leaves", edited), ["order_nbr"], ledger)
    assert rows(due, "order_nbr") == [("big",)]
    twice = ledger.unionByName(due)  # an older state is in the ledger as well
    assert rows(changed_documents(nodes, ["order_nbr"], twice), "order_nbr") == [("big",)]
    sent, rest = sending.unsent_documents(nodes, ["order_nbr"], ledger.where("order_nbr <> 's'"))
    assert rows(sent.select("order_nbr").distinct()) == rows(rest, "order_nbr") == [("s",)]


def test_pages_do_not_touch_the_ledger(nodes):
    """Digests of documents put together from pages of any size are those of the documents."""
    want = rows(digests(nodes, ["order_nbr"]))
    for size in (3, 100_000):
        again = pages(nodes, ["order_nbr"], size).select("order_nbr", F.inline("nodes"))
        assert rows(digests(again, ["order_nbr"])) == want


def test_nulls_link_to_nulls_and_orphans_are_left_out(spark):
    docs = spark.createDataFrame([(1, None), (2, "x")], "k int, tag string")
    lines = spark.createDataFrame([(None, "a"), ("x", "b"), ("x", None), ("gone", "c")], "tag string, v string")
    own = document_nodes(docs.select("tag"), ["tag"], {}, [Level("l", lines, ["tag"], ["v"], {"v": F.col("v")})])
    assert rows(leaves_of(own, ["tag"])) == sorted([(None, "l", "1", "v", "a"), ("x", "l", "1", "v", None), ("x", "l", "2", "v", "b")], key=repr)
    empty = document_nodes(docs.where("k > 9").select("tag"), ["tag"], {}, [Level("l", lines.where("v = '-'"), ["tag"], ["v"], {"v": F.col("v")})])
    assert empty.collect() == []


def test_two_lines_of_one_item_become_one(spark):
    lines = spark.createDataFrame(
        [("a", 7, 2, "fast", "RT", "r", 1), ("a", 7, 3, "slow", "RT", "r", 2), ("b", 7, 2, "x", "SO", "r", 1), ("b", 8, None, "std", "SO", "r", 2),
         ("c", None, 1, "x", "RT", "q", 1), ("c", None, 1, "std", "RT", "q", 2)],
        "shipment_nbr string, item int, qty int, level string, order_type string, customer_ref string, n int",
    )
    got = rows(leaves_of(longform.order_create_nodes(lines, ["n"], "std", "RT", {"first": "n"}), ["shipment_nbr"]))
    heads = {(s, n): v for s, path, _, n, v in got if path == "$"}
    assert heads == {("a", "shipping_method"): "fast", ("a", "reference"): "r", ("a", "first"): "1", ("b", "shipping_method"): "x",
                     ("b", "reference"): None, ("b", "first"): "1", ("c", "shipping_method"): "x", ("c", "reference"): "q", ("c", "first"): "1"}
    assert [(s, at, v) for s, path, at, n, v in got if n == "qty"] == [("a", "1", "5"), ("b", "1", "2"), ("b", "2", None), ("c", "1", "1"), ("c", "2", "1")]
    assert {v for s, _, _, n, v in got if s == "b" and n == "shipVia"} == {"x"}


def test_one_xml_text_however_many_lines(spark):
    lines = spark.range(12_000).select(F.lit("k").alias("k"), F.col("id").alias("n"), F.lit(None).cast("string").alias("none"))
    chunks = xml_chunks(lines, "k", ["n"], {"Ref": F.col("k"), "To": {"Nr": F.col("n"), "No": F.col("none")}}, {"I": F.col("n")}, "R", "L")
    whole = "".join(r.xml for r in chunks.orderBy("place").collect())
    want = "<R><Ref>k</Ref><To><Nr>0</Nr><No></No></To><Ls>" + "".join(f"<L><I>{i}</I></L>" for i in range(12_000)) + "</Ls></R>"
    assert whole == want


def test_long_form_of_address_documents(spark):
    fields = {f"{p}{n}": "str" for p in ("vs_", "vb_") for n in nested.ADDRESS_FIELDS}
    row = {"order_type": "WB", "order_nbr": "1", "customer": "c", "match": 0, **dict.fromkeys(fields, None)}
    row |= {f"vs_{n}": f"s{n}" for n in nested.ADDRESS_FIELDS}
    ddl = "order_type string, order_nbr string, customer string, match int, " + ", ".join(f"{n} string" for n in fields)
    docs = nested.address_documents(spark.createDataFrame([tuple(row.values())], ddl))
    found = longform.address_nodes(docs)
    assert rows(found.select("path")) == [("$",), ("ShipToAddress",)]
    (ship,) = found.where("path = 'ShipToAddress'").collect()
    assert set(ship.leaves.values()) == {f"s{n}" for n in nested.ADDRESS_FIELDS}


def test_address_changes(spark):
    wide = spark.createDataFrame([("1", "a", "b", "a", "b", 1), ("2", "a", "b", "c", None, 0)], "order_nbr string, s_city string, s_line1 string, b_city string, b_line1 string, match int")
    replies = spark.createDataFrame([("1", "A", None, None, None), ("2", "a", "b", "C", None)], "order_nbr string, s_city string, s_line1 string, b_city string, b_line1 string")
    assert rows(sending.address_changes(wide, replies)) == [
        ("1", "bill_to", "city", "a", "A"), ("1", "ship_to", "city", "a", "A"), ("2", "bill_to", "city", "c", "C"),
    ]


def test_only_confirmed_documents_enter_the_ledger(spark, nodes):
    due = digests(nodes, ["order_nbr"])
    replies = spark.createDataFrame([("s", True), ("s", True), ("big", False)], "order_nbr string, ok boolean")
    assert rows(sending.sent_rows(due, replies, ["order_nbr"], F.lit("now")), "order_nbr", "sent_at") == [("s", "now")]


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_one_shuffle_by_the_parent_per_level(nodes):
    # root; lines; shipments and the places of lines; packages and the places of shipments, each in every branch above it
    assert shuffles(nodes) <= 14


def test_documents_and_links_without_a_key(spark):
    """Null keys link to null keys, equal rows are one node, numbers follow the order."""
    detail = spark.createDataFrame(
        [(None, 2, 5, 1, 0, "S", 2, None, "Done", 1, 7, None)] * 2 + [(None, None, 6, 1, 0, None, None, None, None, None, None, None)], DETAIL
    )
    docs = spark.createDataFrame([(None, "F"), ("x", "O")], "order_nbr string, status string")
    got = order_nodes(docs, detail, {"status": F.col("status")})
    assert rows(got, "order_nbr", "path", "at") == sorted(
        [(None, "$", []), ("x", "$", []), (None, "line_items", [1]), (None, "line_items", [2]), (None, "line_items.shipments", [1, 1]),
         (None, "line_items.shipments", [2, 1]), (None, "line_items.shipments.packages", [2, 1, 1])], key=repr)


def test_pages_do_not_build_the_nodes_twice(nodes):
    plan = pages(nodes, ["order_nbr"], 1000)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_digest_is_the_sum_of_the_hashes(nodes):
    one = F.xxhash64("path", "at", "name", "value").cast("decimal(38,0)")
    plain = leaves_of(nodes, ["order_nbr"]).groupBy("order_nbr").agg(F.count(F.lit(1)).alias("n_leaves"), F.sum(one).alias("digest"))
    assert rows(digests(nodes, ["order_nbr"]), "order_nbr", "n_leaves", "digest") == rows(plain, "order_nbr", "n_leaves", "digest")
    assert digests(nodes, ["order_nbr"]).schema["digest"].dataType.simpleString() == "decimal(38,0)"
