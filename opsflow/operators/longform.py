"""Documents in long form: one row per node, so that no document has to fit one row.

A node has the document's keys, its ``path`` (names of the levels, joined by dots), ``at``
(its ordinal on every level, from 1) and ``leaves`` (names and texts of its values).
Ordinals are exact places in the whole group, whatever its size. A document of any
length is that many rows; ``pages`` cuts it where a receiver wants bounded messages, as
a separate step whose size is the caller's to give.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from opsflow.functions import nested as nf, text
from opsflow.operators.nested import LINE_COLUMNS, SHIPMENT_COLUMNS, sort_key
from opsflow.operators.skew import FIND, Order, finer, group_pieces
from opsflow.operators.windows import last_unless_default, with_sequence
from opsflow.session import settle

ROOT = "$"


@dataclass(frozen=True)
class Level:
    """Nodes below the nodes of ``parent`` (a path; the root if not given).

    ``rows`` has one row per node. ``link``: columns that tell its parent (of a root
    document: its keys). ``own``: columns that nodes of deeper levels link to.
    ``order_by`` tells the nodes of one parent apart. ``once``: equal rows are one node.
    ``hot`` is what ``group_pieces`` found for ``link``, searched in ``rows`` if not given.
    """

    path: str
    rows: DataFrame
    link: Sequence[str]
    order_by: Sequence[Order]
    leaves: Mapping[str, Column]
    parent: str = ROOT
    own: Sequence[str] = ()
    once: bool = False
    hot: DataFrame | None | object = FIND


def _link_key(columns: Sequence[str]) -> Column:
    """Columns as one value that is never null, so that nulls in it equal nulls."""
    return F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(columns)])


def leaf_map(leaves: Mapping[str, Column]) -> Column:
    """Names and texts of values; a null value stays, as null."""
    pairs = [part for name, value in leaves.items() for part in (F.lit(name), value.cast("string"))]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")


def _numbered(level: Level) -> DataFrame:
    """``_key, _own0 .., _place, _leaves`` per node: its place among those of one parent.

    Without a hot parent one shuffle by the parent serves equal rows, places and the join
    to the parents.
    """
    link, rows = list(level.link), level.rows
    hot = group_pieces(rows, link) if level.hot is FIND else level.hot
    if hot is None:
        rest = [c for c in rows.columns if c not in link]
        rows = rows.select(_link_key(link).alias("_key"), *rest).repartition("_key")
        rows = rows.distinct() if level.once else rows
        rows = rows.select("*", *[F.col("_key")[f"k{i}"].alias(c) for i, c in enumerate(link)])
        numbered = with_sequence(rows, ["_key"], level.order_by, "_place", hot=None)
    else:
        rows = rows.distinct() if level.once else rows
        numbered = with_sequence(rows, link, level.order_by, "_place", hot=hot).withColumn("_key", _link_key(link))
    return numbered.select(
        "_key", *[F.col(c).alias(f"_own{i}") for i, c in enumerate(level.own)], "_place", leaf_map(level.leaves).alias("_leaves")
    )


def _linked(mine: DataFrame, above: DataFrame) -> Column:
    key, link = mine.schema["_key"].dataType, above.schema["_link"].dataType
    if key.simpleString() == link.simpleString():
        return F.col("_key") == F.col("_link")
    pairs = [F.col("_key")[n].eqNullSafe(F.col("_link")[n]) for n in key.fieldNames()]
    return reduce(Column.__and__, pairs)


def document_nodes(docs: DataFrame, keys: Sequence[str], head: Mapping[str, Column], levels: Sequence[Level]) -> DataFrame:
    """``keys, path, at, leaves`` of every node of every document.

    ``docs`` has a row per document; its root (path ``$``, no ordinals) has the values of
    ``head``. A level's nodes are numbered within their parent and then joined to all
    parents they link to; nulls link to nulls. Nodes without a parent are left out.
    """
    keys = list(keys)
    none = F.array().cast("array<bigint>")
    nodes = docs.select(*keys, F.lit(ROOT).alias("path"), none.alias("at"), leaf_map(head).alias("leaves"))
    places = {ROOT: docs.select(*keys, _link_key(keys).alias("_link"), none.alias("_above"))}
    for level in levels:
        mine, above = _numbered(level), places[level.parent]
        at = F.concat("_above", F.array("_place"))
        joined = mine.join(above, _linked(mine, above))
        nodes = nodes.unionByName(joined.select(*keys, F.lit(level.path).alias("path"), at.alias("at"), F.col("_leaves").alias("leaves")))
        own = _link_key([f"_own{i}" for i in range(len(level.own))])
        places[level.path] = joined.select(*keys, own.alias("_link"), at.alias("_above"))
    return nodes


def leaves_of(nodes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, path, at, name, value``: one row per value; ``at`` as text, as in ``3.1``."""
    place = F.array_join(F.transform("at", lambda n: n.cast("string")), ".")
    return nodes.select(*keys, "path", place.alias("at"), F.explode("leaves").alias("name", "value"))


def pages(nodes: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """``keys, page, nodes``: each document cut into arrays of ``size`` nodes, in document order.

    A node comes before those below it. The cut is at exact places, so it depends on the
    document alone. The search for hot documents and the cut both read the nodes, so these are
    written once.
    """
    keys = list(keys)
    nodes = settle(nodes, "nodes")
    placed = with_sequence(nodes, keys, ["at", "path"], "_n")
    page = F.floor((F.col("_n") - 1) / size).alias("page")
    node = F.struct("_n", "path", "at", "leaves")
    later = lambda x, y: F.when(x["_n"] < y["_n"], -1).otherwise(1)
    gathered = placed.groupBy(*keys, page).agg(F.array_sort(F.collect_list(node), later).alias("nodes"))
    return gathered.withColumn("nodes", F.transform("nodes", lambda n: F.struct(n["path"], n["at"], n["leaves"])))


def digests(nodes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, n_leaves, digest`` per document: count and sum of the hashes of its leaves.

    A sum needs no order and no whole document in one place: it is combined on the map
    side, and page cuts cannot change it. Equal leaves count each.
    """
    one = F.xxhash64("path", F.array_join(F.transform("at", lambda n: n.cast("string")), "."), "name", "value")
    each = nodes.select(*keys, "path", "at", F.explode("leaves").alias("name", "value")).select(*keys, one.alias("_hash"))
    # upper and lower halves are summed as whole numbers: decimals come in once per document
    upper, lower = F.sum(F.shiftright("_hash", 32)), F.sum(F.col("_hash").bitwiseAND(F.lit(0xFFFFFFFF)))
    digest = upper.cast("decimal(28,0)") * F.lit(1 << 32).cast("decimal(10,0)") + lower.cast("decimal(20,0)")
    return each.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_leaves"), digest.cast("decimal(38,0)").alias("digest"))


def changed_documents(nodes: DataFrame, keys: Sequence[str], ledger: DataFrame) -> DataFrame:
    """``keys, n_leaves, digest`` of the documents that the ledger lacks or has with another digest.

    ``ledger`` has ``keys, n_leaves, digest``, one row per key or several; one that differs is
    enough to send. These rows are what the ledger gets after sending.
    """
    sent = ledger.groupBy(*keys).agg(
        F.min(F.struct("n_leaves", "digest")).alias("_low"), F.max(F.struct("n_leaves", "digest")).alias("_high")
    )
    now = digests(nodes, keys)
    mine = F.struct("n_leaves", "digest")
    return now.join(sent, list(keys), "left").where(
        F.col("_low").isNull() | (mine != F.col("_low")) | (mine != F.col("_high"))
    ).select(*keys, "n_leaves", "digest")


def xml_chunks(
    lines: DataFrame, key: str, order_by: Sequence[Order], head: Mapping[str, Column | Mapping], line: Mapping[str, Column | Mapping], root: str, row: str
) -> DataFrame:
    """``key, place, xml``: one XML text per key, whole when its chunks are joined by ``place``.

    Chunk 0 opens the document with the head fields of the first row, every line is a
    chunk, and the last one closes it. Fields are text columns, already escaped; a
    mapping in their place is a block of fields.
    """

    def tag(name: str, value: Column | Mapping) -> Column:
        inner = F.concat(*[tag(n, c) for n, c in value.items()]) if isinstance(value, Mapping) else text.null_to_blank(value.cast("string"))
        return F.concat(F.lit(f"<{name}>"), inner, F.lit(f"</{name}>"))

    opened = F.concat(F.lit(f"<{root}>"), *[tag(n, c) for n, c in head.items()], F.lit(f"<{row}s>"))
    groups = lines.groupBy(key).agg(F.min_by(opened, F.struct(*sort_key(order_by))).alias("_open"), F.count(F.lit(1)).alias("_n"))
    ends = F.inline(
        F.array(
            F.struct(F.lit(0).cast("bigint").alias("place"), F.col("_open").alias("xml")),
            F.struct((F.col("_n") + 1).alias("place"), F.lit(f"</{row}s></{root}>").alias("xml")),
        )
    )
    block = F.concat(F.lit(f"<{row}>"), *[tag(n, c) for n, c in line.items()], F.lit(f"</{row}>"))
    body = with_sequence(lines, [key], order_by, "place").select(key, "place", block.alias("xml"))
    return groups.select(key, ends).unionByName(body)


# -- the documents of the send flows -----------------------------------------


def order_nodes(orders: DataFrame, detail: DataFrame, head: Mapping[str, Column]) -> DataFrame:
    """Orders with their lines, the shipments of each line and the packages of each shipment.

    ``detail`` has a row per order, line, shipment line and package. Lines that were not
    shipped have one empty shipment; packages belong to (order, shipment).
    """
    line_key, ship_key = ["order_nbr", "line_nbr"], ["order_nbr", "shipment_nbr"]
    packages = detail.where(F.col("shipment_nbr").isNotNull()).select(*ship_key, "tracking", "tracking_created")
    # lines, shipments and packages are parts of orders: without a hot order none of them is hot
    hot = finer(group_pieces(detail, ["order_nbr"]))
    column = lambda names: {n: F.col(n) for n in names}
    return document_nodes(
        orders, ["order_nbr"], head,
        [
            Level(
                "line_items", detail.select(*LINE_COLUMNS), ["order_nbr"], LINE_COLUMNS[1:],
                column(LINE_COLUMNS[1:]), own=line_key, once=True, hot=hot,
            ),
            Level(
                "line_items.shipments", detail.select(*SHIPMENT_COLUMNS), line_key, SHIPMENT_COLUMNS[2:],
                column(SHIPMENT_COLUMNS[2:]), parent="line_items", own=ship_key, once=True, hot=hot,
            ),
            Level(
                "line_items.shipments.packages", packages, ship_key, ["tracking", "tracking_created"],
                column(["tracking", "tracking_created"]), parent="line_items.shipments", once=True, hot=hot,
            ),
        ],
    )


def package_nodes(matched: DataFrame, order_by: Sequence[Order], as_of_text: str, box: str = "DEFAULT BOX") -> DataFrame:
    """Shipments with one package per tracking number and the contents of each.

    ``matched`` has ``shipment_nbr, tracking, inventory_cd, qty, split_line_nbr``.
    """
    key, package = ["shipment_nbr"], ["shipment_nbr", "tracking"]
    return document_nodes(
        matched.select(*key).distinct(), key, {},
        [
            Level(
                "packages", matched.select(*package).distinct(), key, ["tracking"],
                {
                    "BoxID": F.lit(box), "TrackingNbr": F.col("tracking"),
                    "Description": F.lit(f"Package added via API @ {as_of_text}"), "Weight": F.lit(0), "UOM": F.lit("LBS"),
                },
                own=package,
            ),
            Level(
                "packages.contents", matched, package, order_by,
                {
                    "InventoryID": F.col("inventory_cd"), "Quantity": F.col("qty"), "UOM": F.lit("EA"),
                    "ShipmentSplitLineNbr": F.col("split_line_nbr"),
                },
                parent="packages",
            ),
        ],
    )


def order_create_nodes(
    lines: DataFrame, order_by: Sequence[Order], default_level: str, reference_type: str, carry: Mapping[str, str] | None = None
) -> DataFrame:
    """Order-create documents with one service level for all lines.

    ``carry``: further head values ``{leaf: column}``, those of the first line.

    ``lines``: ``shipment_nbr, item, qty, level, order_type, customer_ref`` and the order
    columns. Exactly two lines of one item become one line with the summed quantity and the
    first line's level. The reference is kept for ``reference_type`` only.
    """
    key, carry = ["shipment_nbr"], dict(carry or {})
    along = F.struct(*sort_key(order_by))
    level = last_unless_default(lines, key, order_by, "level", default_level, "_chosen")
    whole = lines.groupBy(*key).agg(
        F.min_by(F.struct("order_type", "customer_ref", "level", F.struct(F.lit(0).alias("_"), *[F.col(c).alias(n) for n, c in carry.items()]).alias("carry")), along).alias("_head"),
        F.count(F.lit(1)).alias("_n"),
        F.count("item").alias("_items"), F.min("item").alias("_low"), F.max("item").alias("_high"),
        F.sum("qty").alias("_sum"), F.count("qty").alias("_qtys"),
    )
    merges = (F.col("_n") == 2) & (F.col("_items") == 2) & (F.col("_low") == F.col("_high"))
    docs = whole.join(level, key).select(
        *key, merges.alias("_merges"), F.when(F.col("_qtys") == 2, F.col("_sum")).alias("_both"),
        F.when(merges, F.col("_head.level")).otherwise(F.col("_chosen")).alias("shipping_method"),
        F.when(F.col("_head.order_type") == reference_type, F.col("_head.customer_ref")).alias("reference"),
        *[F.col(f"_head.carry.{n}").alias(f"_carry_{n}") for n in carry],
    )
    rows = lines.join(docs.select(*key, "_merges", "_both", "shipping_method"), key)
    placed = with_sequence(rows, key, order_by, "_n").where(~F.col("_merges") | (F.col("_n") == 1))
    qty = F.when(F.col("_merges"), F.col("_both")).otherwise(F.col("qty"))
    return document_nodes(
        docs, key,
        {"shipping_method": F.col("shipping_method"), "reference": F.col("reference"), **{n: F.col(f"_carry_{n}") for n in carry}},
        [Level("lines", placed, key, ["_n"], {"sku": F.col("item"), "qty": qty, "item_ref": F.col("item"), "shipVia": F.col("shipping_method")})],
    )


def address_nodes(documents: DataFrame) -> DataFrame:
    """Documents of ``address_documents`` as a root and a node per address block that is there."""
    key = documents.select(nf.unwrap(F.col("OrderNbr")).alias("order_nbr"), "*")

    def block(name: str) -> Level:
        rows = key.where(F.col(name).isNotNull()).select("order_nbr", F.lit(1).alias("_one"), F.col(name).alias("_block"))
        fields = documents.schema[name].dataType.fieldNames()
        return Level(name, rows, ["order_nbr"], ["_one"], {f: nf.unwrap(F.col(f"_block.{f}")) for f in fields})

    scalars = ["OrderType", "OrderNbr", "CustomerID", "ShipToAddressOverride", "BillToAddressOverride"]
    return document_nodes(
        key, ["order_nbr"], {c: nf.unwrap(F.col(c)) for c in scalars}, [block("ShipToAddress"), block("BillToAddress")]
    )
