"""Flattening nested records and assembling nested documents.

Documents are built with ``collect_parts``: a group becomes one document row,
and a group too large for one row becomes several, numbered by ``piece`` and
``part`` (both 0 for an ordinary group), that together hold all of it. What is true
of a whole group (its head, level, count of lines) comes from aggregates over its
lines, never from one of these rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from opsflow.functions import dates, nested as nf, numbers, predicates, text
from opsflow.operators.skew import (
    DEFAULT,
    FIND,
    Order,
    Skew,
    finer,
    group_pieces,
    join_in_place,
    range_pieces,
    sort_columns,
    spread_join,
)
from opsflow.operators.windows import Deal, dealer, last_unless_default, with_sequence

PART_ROWS = 10_000
LINE_COLUMNS = ["order_nbr", "line_nbr", "inventory_cd", "line_qty", "warehouse"]
SHIPMENT_COLUMNS = [
    "order_nbr", "line_nbr", "shipment_nbr", "ship_line_nbr", "ship_date", "ship_status", "ship_line_qty",
]


def collect_parts(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Order],
    element: Column,
    out: str,
    part_rows: int = PART_ROWS,
    carry: Sequence[Column] = (),
    weight: Column | None = None,
    skew: Skew = DEFAULT,
    basis: DataFrame | None = None,
    cut_by: Sequence[Order] | None = None,
    hot: DataFrame | None | object = FIND,
) -> DataFrame:
    """Rows of each group as an array along ``order_by``.

    Output: ``keys, piece, part, carry..., out, weight``. A group of up to
    ``part_rows`` rows (or that much ``weight``) gives one row. Without ``weight``
    the cuts are at the exact place of a row in its group, so they depend on that
    group alone. With it, hot groups are cut along ``cut_by`` first, leading columns
    of ``order_by`` that ``basis`` has.
    """
    keys = list(keys)
    if weight is None:
        numbered = with_sequence(df, keys, order_by, "_at", skew, None if cut_by else basis, hot)
        return (
            numbered.groupBy(*keys, F.lit(0).alias("piece"), F.floor((F.col("_at") - 1) / part_rows).alias("part"))
            .agg(
                *carry,
                F.array_sort(F.collect_list(F.struct("_at", element.alias("_element")))).alias("_rows"),
                F.count(F.lit(1)).alias("weight"),
            )
            .withColumn("_rows", F.transform("_rows", lambda row: row["_element"]))
            .withColumnRenamed("_rows", out)
        )
    rows, bounds = range_pieces(df, keys, cut_by or order_by, skew, basis, hot)
    cut = [] if bounds is None else ["_piece"]
    piece = F.lit(0) if bounds is None else F.col("_piece")
    along = Window.partitionBy(*keys, *cut).orderBy(*sort_columns(order_by))
    running = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.withColumn("_weight", weight.cast("bigint"))
        .withColumn("_at", F.row_number().over(along))
        .withColumn(
            "_part",
            F.floor((F.sum("_weight").over(running) - F.col("_weight")) / part_rows),
        )
        .groupBy(*keys, piece.alias("piece"), F.col("_part").alias("part"))
        .agg(
            *carry,
            F.array_sort(F.collect_list(F.struct("_at", element.alias("_element")))).alias("_rows"),
            F.sum("_weight").alias("weight"),
        )
        .withColumn("_rows", F.transform("_rows", lambda row: row["_element"]))
        .withColumnRenamed("_rows", out)
    )


# -- flattening ------------------------------------------------------------


def flatten_lines(
    df: DataFrame, array: str, header: Mapping[str, Column], line: Mapping[str, str]
) -> DataFrame:
    """One row per array element: header expressions plus element fields.

    A record with an empty or missing list gives no row.
    """
    exploded = df.select(
        *[expression.alias(name) for name, expression in header.items()],
        F.explode(array).alias("_line"),
    )
    return exploded.select(
        *header, *[F.col(f"_line.{field}").alias(name) for name, field in line.items()]
    )


def flatten_variant(
    df: DataFrame,
    array: str,
    kind: str,
    header: Mapping[str, Column],
    common: Mapping[str, str],
    by_kind: Mapping[str, Mapping[str, str]],
    only_for: Mapping[str, tuple[str, Column]],
) -> DataFrame:
    """Flatten lines whose field names depend on the record's kind.

    ``by_kind`` maps each output to ``{kind: field}``; other kinds give null.
    ``only_for`` maps an output to ``(kind, header expression)``.
    """
    exploded = df.select(
        F.col(kind).alias("_kind"),
        *[expression.alias(name) for name, expression in header.items()],
        *[
            F.when(F.col(kind) == wanted, expression).alias(name)
            for name, (wanted, expression) in only_for.items()
        ],
        F.explode(array).alias("_line"),
    )
    choices = [
        predicates.first_match(
            [(F.col("_kind") == k, F.col(f"_line.{field}")) for k, field in fields.items()]
        ).alias(name)
        for name, fields in by_kind.items()
    ]
    return exploded.select(
        *header,
        *[F.col(f"_line.{field}").alias(name) for name, field in common.items()],
        *choices,
        *only_for,
    )


def header_detail(
    df: DataFrame,
    array: str,
    header: Mapping[str, Column],
    detail_header: Mapping[str, Column],
    detail: Mapping[str, str],
) -> tuple[DataFrame, DataFrame]:
    """One input, two tables: headers, and lines with their header keys."""
    heads = df.select(*[expression.alias(name) for name, expression in header.items()])
    return heads, flatten_lines(df, array, detail_header, detail)


def inventory_levels(
    df: DataFrame,
    item: str,
    quantities: Mapping[str, str],
    array: str,
    warehouse: str,
    warehouses: Mapping[str, str],
    default: str = "Unknown",
) -> tuple[DataFrame, DataFrame]:
    """Stock per item and per item and warehouse, from quantities held as text."""
    summary = df.select(
        F.col(item).alias("item"),
        *[numbers.text_to_int(F.col(src)).alias(out) for out, src in quantities.items()],
    )
    lines = df.select(F.col(item).alias("item"), F.explode(array).alias("_line"))
    detail = lines.select(
        "item",
        predicates.decode(F.col(f"_line.{warehouse}"), warehouses, default).alias("warehouse"),
        *[
            numbers.text_to_int(F.col(f"_line.{src}")).alias(out)
            for out, src in quantities.items()
        ],
    )
    return summary, detail


CHECKPOINT_FIELDS = (
    "checkpoint_time", "created_at", "message", "tag", "subtag", "subtag_message", "city", "state", "slug", "raw_tag", "source",
)


def tracking_export(df: DataFrame, zone: str) -> tuple[DataFrame, DataFrame]:
    """Tracked parcels and their checkpoints in local time.

    Records whose first customer has no phone number are left out.
    """
    phone = F.get(F.col("customers"), F.lit(0))["phone_number"]
    kept = df.where(F.coalesce(phone, F.lit("")) != "")
    keys = {
        "order_nbr": F.col("order_number"),
        "tracking": F.col("tracking_number"),
        "id": F.col("id"),
        "shipment_nbr": text.null_to_blank(F.col("order_id")),
    }
    header = {
        **keys,
        "phone": text.plain_phone(phone),
        "product": F.col("custom_fields.product_title"),
        "shipment_type": F.col("shipment_type"),
        "weight": F.col("shipment_weight.value"),
        "link": F.col("courier_tracking_link"),
        "dest_line1": F.col("destination_raw_location"),
        "dest_city": F.col("destination_city"),
        "dest_state": F.col("destination_state"),
        "dest_zip": F.col("destination_postal_code"),
        "tag": F.col("tag"),
        "subtag": F.col("subtag"),
        "subtag_message": F.col("subtag_message"),
        "last_update": dates.wall_clock(F.col("updated_at"), zone),
        "created": dates.wall_clock(F.col("created_at"), zone),
    }
    heads = kept.select(*[c.alias(n) for n, c in header.items()])
    points = flatten_lines(
        kept,
        "checkpoints",
        keys,
        {**{n: n for n in CHECKPOINT_FIELDS}, "zip": "postal_code"},
    )
    detail = points.withColumns(
        {
            "checkpoint_time": dates.wall_clock(F.col("checkpoint_time"), zone),
            "created_at": dates.wall_clock(F.col("created_at"), zone),
        }
    )
    return heads, detail


PACKAGES = (
    "array<struct<manifest_courier:string,"
    "items:array<struct<sku:string,quantity:int,order_item_qty:int>>,"
    "tracking_numbers:array<string>>>"
)


def expand_packed_events(df: DataFrame, json: str, topic: str = "shipment:packed") -> DataFrame:
    """One row per packed item with its tracking number and courier.

    Items pair with tracking numbers and packages by position; a single one of
    either serves all items. Events without tracking numbers, of other topics
    or with broken JSON give no row.
    """
    # an event is parsed once for topic and message, the message of a wanted topic once more
    named = df.select(F.json_tuple(json, "topic", "message").alias("_topic", "_message"))
    message = F.from_json("_message", f"order_unique_id STRING, packages {PACKAGES}")
    parsed = named.where(F.col("_topic") == topic).select(message.alias("_m")).select(
        F.col("_m.order_unique_id").alias("shipment_nbr"), F.col("_m.packages").alias("_packages")
    )
    lists = parsed.select(
        "shipment_nbr",
        "_packages",
        F.flatten(F.filter(F.col("_packages.items"), lambda a: a.isNotNull())).alias("_items"),
        F.flatten(
            F.filter(F.col("_packages.tracking_numbers"), lambda a: a.isNotNull())
        ).alias("_trackings"),
    ).where(F.size("_trackings") > 0)
    rows = lists.select("*", F.posexplode("_items").alias("_at", "_item"))
    return rows.select(
        "shipment_nbr",
        F.col("_item.sku").alias("inventory_cd"),
        nf.one_or_nth(F.col("_trackings"), F.col("_at")).alias("tracking"),
        F.col("_item.quantity").alias("qty"),
        nf.one_or_nth(F.col("_packages"), F.col("_at"))["manifest_courier"].alias("courier"),
        F.col("_item.order_item_qty").alias("order_item_qty"),
    )


def flatten_properties(
    df: DataFrame, bag: str, spec: Mapping[str, tuple[str, Column | None]]
) -> DataFrame:
    """Columns from a property bag: ``{out: (property, None | expression)}``.

    An expression sees the property's text as column ``_p_<out>``.
    """
    raw = df.withColumns(
        {f"_p_{out}": nf.property_or(F.col(bag), name) for out, (name, _) in spec.items()}
    )
    return raw.withColumns(
        {
            out: F.col(f"_p_{out}") if expression is None else expression
            for out, (_, expression) in spec.items()
        }
    ).drop(*[f"_p_{out}" for out in spec])


def flatten_shipment_reply(df: DataFrame) -> DataFrame:
    """Lines of landed shipment replies, with the first allocation of each."""
    lines = df.select(
        nf.unwrap(F.col("ShipmentNbr")).alias("shipment_nbr"),
        nf.unwrap(F.col("Status")).alias("status"),
        nf.unwrap(F.col("PackageCount")).alias("package_count"),
        F.size("Details").alias("line_count"),
        F.explode("Details").alias("_line"),
    )
    return lines.select(
        "shipment_nbr",
        "status",
        "package_count",
        "line_count",
        F.col("_line.LineNbr.value").alias("line_nbr"),
        F.col("_line.InventoryID.value").alias("inventory_cd"),
        F.col("_line.ShippedQty.value").alias("qty"),
        F.get(F.col("_line.Allocations"), F.lit(0))["SplitLineNbr"]["value"].alias("split_line_nbr"),
    )


# -- assembling ------------------------------------------------------------


def nest_orders(
    orders: DataFrame,
    detail: DataFrame,
    part_rows: int = PART_ROWS,
    skew: Skew = DEFAULT,
    deal: Deal | None = None,
) -> DataFrame:
    """Orders with their lines, the shipments of each line and their packages.

    ``detail`` has one row per order, line, shipment line and package. Packages
    belong to (order, shipment), so all lines of a shipment repeat them.
    Orders without detail keep an empty list.

    Without a hot order ``deal`` (by ``order_nbr``, found for ``detail`` if not given) puts all
    rows of an order into one partition, once; no later step shuffles and documents never
    cross the network.
    """
    ship_key, line_key = ["order_nbr", "shipment_nbr"], ["order_nbr", "line_nbr"]
    hot = group_pieces(detail, ["order_nbr"], skew)
    hot_shipments = hot if hot is None else group_pieces(detail, ship_key, skew)
    hot_lines = hot if hot is None else group_pieces(detail, line_key, skew)
    if hot is not None:
        deal = lambda rows: rows
    elif deal is None:
        deal = dealer(["order_nbr"], detail)

    def join(left: DataFrame, right: DataFrame, keys: Sequence[str], few: DataFrame | None) -> DataFrame:
        return join_in_place(left, right, keys) if hot is None else spread_join(left, right, keys, "left", few)

    packages = collect_parts(
        deal(detail.where(F.col("shipment_nbr").isNotNull()).select(*ship_key, "tracking", "tracking_created")).distinct(),
        ship_key,
        ["tracking", "tracking_created"],
        F.struct("tracking", "tracking_created"),
        "packages",
        part_rows,
        skew=skew,
        basis=detail,
        hot=hot_shipments,
    ).drop("weight")
    package_type = packages.schema["packages"].dataType.simpleString()
    shipments = join(deal(detail.select(*SHIPMENT_COLUMNS)).distinct(), packages, ship_key, hot_shipments).withColumns(
        {
            "packages": F.coalesce("packages", F.array().cast(package_type)),
            "_piece_of": F.col("piece"),
            "_part_of": F.col("part"),
        }
    ).drop("piece", "part")
    by_line = collect_parts(
        shipments,
        line_key,
        [*SHIPMENT_COLUMNS[2:], "_piece_of", "_part_of"],
        F.struct(*SHIPMENT_COLUMNS[2:], "packages"),
        "shipments",
        part_rows,
        weight=F.lit(1) + F.size("packages"),
        skew=skew,
        basis=detail,
        cut_by=SHIPMENT_COLUMNS[2:],
        hot=hot_lines,
    ).withColumnsRenamed({"piece": "_piece_of", "part": "_part_of", "weight": "_leaves"})
    lines = join(deal(detail.select(*LINE_COLUMNS)).distinct(), by_line, line_key, hot_lines)
    by_order = collect_parts(
        lines,
        ["order_nbr"],
        [*LINE_COLUMNS[1:], "_piece_of", "_part_of"],
        F.struct(*LINE_COLUMNS[1:], "shipments"),
        "line_items",
        part_rows,
        weight=F.lit(1) + F.coalesce("_leaves", F.lit(0)),
        skew=skew,
        basis=detail,
        cut_by=LINE_COLUMNS[1:],
        hot=hot,
    ).drop("weight")
    line_type = by_order.schema["line_items"].dataType.simpleString()
    if hot is None:
        # documents are wide, however few: they are not to be broadcast
        docs = deal(orders).join(by_order.hint("merge"), "order_nbr", "left")
        found = {"piece": F.lit(0), "part": F.lit(0).cast("bigint"), "line_items": F.array().cast(line_type)}
        return docs.select(
            "order_nbr",
            *[F.coalesce(name, none).alias(name) for name, none in found.items()],
            *[c for c in orders.columns if c != "order_nbr"],
        )
    filled = spread_join(by_order, orders, ["order_nbr"], "inner", hot)
    empty = orders.join(detail.select("order_nbr").distinct(), "order_nbr", "left_anti").withColumns(
        {
            "piece": F.lit(0),
            "part": F.lit(0).cast("bigint"),
            "line_items": F.array().cast(line_type),
        }
    )
    return filled.unionByName(empty)


def package_documents(
    matched: DataFrame,
    order_by: Sequence[Order],
    as_of_text: str,
    box: str = "DEFAULT BOX",
    part_rows: int = PART_ROWS,
    skew: Skew = DEFAULT,
) -> DataFrame:
    """Shipments with one package per tracking number and the contents of each.

    ``matched`` has ``shipment_nbr, tracking, inventory_cd, qty, split_line_nbr``.
    """
    hot = group_pieces(matched, ["shipment_nbr"], skew)
    contents = collect_parts(
        matched,
        ["shipment_nbr", "tracking"],
        order_by,
        nf.wrap(
            InventoryID=F.col("inventory_cd"),
            Quantity=F.col("qty"),
            UOM=F.lit("EA"),
            ShipmentSplitLineNbr=F.col("split_line_nbr"),
        ),
        "contents",
        part_rows,
        skew=skew,
        hot=finer(hot),
    )
    package = F.struct(
        nf.wrapped(F.lit(box)).alias("BoxID"),
        nf.wrapped(F.col("tracking")).alias("TrackingNbr"),
        nf.wrapped(F.lit(f"Package added via API @ {as_of_text}")).alias("Description"),
        nf.wrapped(F.lit(0)).alias("Weight"),
        nf.wrapped(F.lit("LBS")).alias("UOM"),
        F.col("contents").alias("PackageContents"),
    )
    return collect_parts(
        contents,
        ["shipment_nbr"],
        ["tracking", "piece", "part"],
        package,
        "packages",
        part_rows,
        weight=F.col("weight"),
        skew=skew,
        basis=matched,
        cut_by=["tracking"],
        hot=hot,
    ).drop("weight")


def return_package_documents(
    lines: DataFrame,
    order_by: Sequence[Order],
    as_of_text: str,
    missing: str = "No ExtRefNbr for tracking",
    part_rows: int = PART_ROWS,
    skew: Skew = DEFAULT,
) -> DataFrame:
    """One package with all lines of a return: tracking is the external
    reference, else the tracking number, else a fixed text."""
    choice = F.coalesce(
        text.blank_to_null(F.col("ext_ref")), text.blank_to_null(F.col("tracking")), F.lit(missing)
    )
    return package_documents(
        lines.withColumn("tracking", choice), order_by, as_of_text, part_rows=part_rows, skew=skew
    )


def order_documents(
    lines: DataFrame,
    order_by: Sequence[Order],
    default_level: str,
    reference_type: str,
    part_rows: int = PART_ROWS,
    skew: Skew = DEFAULT,
) -> DataFrame:
    """Order-create documents with one service level for all lines.

    ``lines``: ``shipment_nbr, item, qty, level, order_type, customer_ref`` and
    the order columns. Exactly two lines of one item become one line with the
    summed quantity. The reference is kept for ``reference_type`` only.
    """
    key = ["shipment_nbr"]
    hot = group_pieces(lines, key, skew)
    level = last_unless_default(lines, key, order_by, "level", default_level, "_chosen")
    along = F.struct(*sort_key(order_by))
    whole = lines.groupBy(*key).agg(
        F.min_by(F.struct("order_type", "customer_ref", "level"), along).alias("_head"),
        F.count(F.lit(1)).alias("_n"), F.count("item").alias("_items"),
        F.min("item").alias("_low"), F.max("item").alias("_high"), F.min("qty").alias("_q1"), F.max("qty").alias("_q2"),
        F.count("qty").alias("_qtys"),
    )
    docs = collect_parts(
        lines, key, order_by, F.struct("item", "qty", "level"), "_lines", part_rows, skew=skew, hot=hot
    )
    docs = spread_join(spread_join(docs, level, key, "left", hot), whole, key, "inner", hot)
    merges = (F.col("_n") == 2) & (F.col("_items") == 2) & (F.col("_low") == F.col("_high"))
    both = F.when(F.col("_qtys") == 2, F.col("_q1") + F.col("_q2"))
    merged = F.array(F.struct(F.col("_low").alias("item"), both.alias("qty"), F.col("_head.level").alias("level")))
    return (
        docs.where(~merges | (F.col("part") == 0))
        .withColumn("shipping_method", F.when(merges, F.col("_head.level")).otherwise(F.col("_chosen")))
        .withColumn("_lines", F.when(merges, merged).otherwise(F.col("_lines")))
        .select(
            "shipment_nbr",
            "piece",
            "part",
            "shipping_method",
            F.when(F.col("_head.order_type") == reference_type, F.col("_head.customer_ref")).alias("reference"),
            F.transform(
                "_lines",
                lambda line: F.struct(
                    line["item"].alias("sku"),
                    line["qty"].alias("qty"),
                    line["item"].alias("item_ref"),
                    F.col("shipping_method").alias("shipVia"),
                ),
            ).alias("lines"),
        )
    )


def sort_key(order_by: Sequence[Order]) -> list[Column]:
    """Columns of an ascending order, for ``min_by``."""
    names = [term if isinstance(term, str) else term[0] for term in order_by]
    if any(not isinstance(term, str) and term[1] == "desc" for term in order_by):
        raise ValueError("this operator needs an ascending order")
    return [F.col(name) for name in names]


def tracking_documents(df: DataFrame, states: Mapping[str, str]) -> DataFrame:
    """Tracking-create documents: renamed fields, customer block, contact list, tags."""
    email = text.first_of_list(F.col("email"))
    return df.select(
        F.col("tracking").alias("tracking_number"),
        F.col("slug"),
        F.col("shipment_nbr").alias("order_id"),
        F.col("customer").alias("customer_name"),
        text.country_iso3(F.col("origin_country")).alias("origin_country_iso3"),
        nf.lookup(F.col("origin_state"), states).alias("origin_state"),
        text.join_lines(F.col("origin_line1"), F.col("origin_line2")).alias("origin_raw_location"),
        text.country_iso3(F.col("dest_country")).alias("destination_country_iso3"),
        nf.lookup(F.col("dest_state"), states).alias("destination_state"),
        text.join_lines(F.col("dest_line1"), F.col("dest_line2")).alias("destination_raw_location"),
        F.col("order_nbr").alias("order_number"),
        F.date_format("order_date", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("order_date"),
        F.struct(
            text.first_name(F.col("customer")).alias("first_name"),
            text.last_name(F.col("customer")).alias("last_name"),
            F.col("product_title"),
        ).alias("custom_fields"),
        F.array(
            F.struct(
                email.alias("email"),
                F.lit("en").alias("language"),
                F.col("customer").alias("name"),
                F.col("phone_number"),
                F.lit("buyer").alias("role"),
            )
        ).alias("customers"),
        F.array("phone_number").alias("smses"),
        nf.sorted_tags(
            F.col("customer_class"), F.col("item_class"), F.col("package_value")
        ).alias("shipment_tags"),
    )


ADDRESS_FIELDS = ("address_line1", "address_line2", "city", "state", "postal_code", "country")


def address_documents(df: DataFrame) -> DataFrame:
    """Address overrides: ship-to always, bill-to as a copy when the addresses
    were equal, as its own value when validated on its own, else absent.

    ``df`` has ``order_type, order_nbr, customer, match`` and the validated
    ``vs_*`` and ``vb_*`` fields. Orders without a validated street get none.
    """

    def block(prefix: str) -> Column:
        return F.struct(*[nf.wrapped(F.col(f"{prefix}{f}")).alias(f) for f in ADDRESS_FIELDS])

    bill = F.when(F.col("match") == 1, block("vs_")).when(
        F.col("vb_address_line1").isNotNull(), block("vb_")
    )
    return df.where(F.col("vs_address_line1").isNotNull()).select(
        nf.wrapped(F.col("order_type")).alias("OrderType"),
        nf.wrapped(F.col("order_nbr")).alias("OrderNbr"),
        nf.wrapped(F.col("customer")).alias("CustomerID"),
        nf.wrapped(F.lit(True)).alias("ShipToAddressOverride"),
        block("vs_").alias("ShipToAddress"),
        F.when(bill.isNotNull(), nf.wrapped(F.lit(True))).alias("BillToAddressOverride"),
        bill.alias("BillToAddress"),
    )


def render_xml(
    lines: DataFrame,
    key: str,
    order_by: Sequence[Order],
    head: Mapping[str, Column],
    line: Mapping[str, Column],
    root: str,
    row: str,
    part_rows: int = PART_ROWS,
    skew: Skew = DEFAULT,
) -> DataFrame:
    """XML text per key: head fields of its first row, then one block per line.

    Fields are text columns, already escaped. Output: ``key, piece, part, xml``. All
    parts of a key carry the head of its first row.
    """

    def tag(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"<{name}>"), text.null_to_blank(value.cast("string")), F.lit(f"</{name}>"))

    block = F.concat(F.lit(f"<{row}>"), *[tag(n, c) for n, c in line.items()], F.lit(f"</{row}>"))
    first = F.min_by(F.concat(*[tag(n, c) for n, c in head.items()]), F.struct(*sort_key(order_by)))
    hot = group_pieces(lines, [key], skew)
    docs = collect_parts(lines, [key], order_by, block, "_blocks", part_rows, skew=skew, hot=hot)
    heads = lines.groupBy(key).agg(first.alias("_head"))
    return spread_join(docs, heads, [key], "inner", hot).select(
        key,
        "piece",
        "part",
        F.concat(
            F.lit(f"<{root}>"), F.col("_head"), F.lit(f"<{row}s>"), F.array_join("_blocks", ""),
            F.lit(f"</{row}s></{root}>"),
        ).alias("xml"),
    )


def classify_replies(df: DataFrame) -> DataFrame:
    """Message and failure flag of landed XML replies (``status_code, body``).

    A reply fails when its message has 'error' but not 'already exists'.
    """
    result = F.regexp_extract("body", r"(?s)<CreateNewResult>(.*?)</CreateNewResult>", 1)
    number = F.regexp_extract(result, r"<RMA_?Number>([^<]*)</RMA_?Number>", 1)
    message = F.regexp_extract(result, r"<Message>([^<]*)</Message>", 1)
    code = F.col("status_code").cast("string")
    reply = (
        F.when(text.null_to_blank(result) == "", F.concat(code, F.lit(" ERROR: Error parsing response")))
        .when(number != "", F.concat(code, F.lit(" "), message, F.lit(": "), number, F.lit(" posted successfully!")))
        .otherwise(F.concat(code, F.lit(" ERROR: "), message))
    )
    lower = F.lower(F.col("reply"))
    return df.withColumn("reply", reply).withColumn(
        "failed", lower.contains("error") & ~lower.contains("already exists")
    )


def attribute_documents(sent: DataFrame, replies: DataFrame, link_prefix: str, as_of: Column) -> DataFrame:
    """Attributes to write back for sent shipments, from the landed replies."""
    joined = sent.join(replies, "shipment_nbr")
    return joined.select(
        "shipment_nbr",
        nf.wrap(
            order_id=F.col("order_id"),
            order_nbr=F.col("shipment_nbr"),
            courier_code=F.col("shipping_description"),
            courier_name=F.col("shipping_method"),
            sent_at=F.date_format(as_of, "yyyy-MM-dd'T'HH:mm:ss"),
            link=text.join_text(link_prefix, F.col("order_id").cast("string")),
        ).alias("attributes"),
    )


def ledger_rows(
    requests: DataFrame, replies: DataFrame, request_id: str, keys: Sequence[str], as_of: Column
) -> DataFrame:
    """Ledger rows of landed replies: keys from the reply, else from the request."""
    renamed = replies.withColumnsRenamed({key: f"_reply_{key}" for key in keys})
    joined = requests.select(request_id, *keys).join(renamed, request_id)
    return joined.select(
        *[F.coalesce(text.blank_to_null(F.col(f"_reply_{key}")), F.col(key)).alias(key) for key in keys],
        F.col("code").cast("string").alias("response_code"),
        "message",
        "id",
        as_of.alias("ts"),
    )


def current_shipment(orders: DataFrame, since: Column) -> DataFrame:
    """Shipment of an order from its ``shipments`` array: the only one, or of
    several the first modified at or after ``since``; nulls if there is none."""
    recent = F.filter("shipments", lambda s: s["modified_at"] >= since)
    chosen = F.when(F.size("shipments") > 1, F.get(recent, F.lit(0))).otherwise(
        F.get("shipments", F.lit(0))
    )
    found = F.col("_chosen").isNotNull()
    return (
        orders.withColumn("_chosen", chosen)
        .select(
            "order_nbr",
            "order_type",
            F.col("_chosen.shipment_nbr").alias("shipment_nbr"),
            *[F.when(found, F.col(c)).alias(c) for c in ("customer_id", "description", "ext_ref")],
        )
    )
