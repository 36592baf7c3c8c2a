"""Warehouse datasets: copies, ledgers, matching, packing, receipts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from opsflow.functions import dates, fixed, predicates as p, text
from opsflow.operators import changes, joins, matching, nested, rows, tables
from opsflow.operators.joins import Lookup, enrich
from opsflow.operators.skew import Order, group_pieces
from opsflow.operators.tables import TableSpec
from opsflow.operators.windows import completion_label, with_group_total, with_sequence
from opsflow.session import settle


def tracked_shipments_view(
    shipments: DataFrame, warehouses: DataFrame, items: DataFrame, customers: DataFrame,
    order_lines: DataFrame, slugs: DataFrame, as_of: datetime, lookback: str,
    freight_sites: Sequence[str], freight_methods: Sequence[str], excluded_sites: Sequence[str] = (),
) -> DataFrame:
    """Tracked shipments from the warehouse copies.

    Line 1 of each shipment, and other lines with another tracking number. The
    carrier slug comes from the tracking text, the slug table (SmartPost counts
    as fedex), or the freight rule.
    """
    kept = joins.differs_from_first(shipments, ["shipment_nbr"], "ship_line_nbr", "tracking").where(
        p.changed_since(F.col("ship_date"), as_of, lookback)
        & (F.col("tracking") != "Undefined")
        & F.col("tracking_created").isNotNull()
    )
    if excluded_sites:
        kept = kept.where(~F.col("warehouse").isin(*excluded_sites))
    wide = enrich(
        kept,
        [
            Lookup(warehouses, {"warehouse": "warehouse"}, {f"origin_{c}": c for c in ("line1", "city", "country")}, "inner"),
            Lookup(items, {"inventory_cd": "inventory_cd"}, {"product_title": "descr"}, "inner"),
            Lookup(customers, {"customer_id": "customer_id"},
                   {"_class": "customer_class", "_contact": "contact_name", "_account": "account_name"}, "inner"),
            Lookup(order_lines, {"order_nbr": "order_nbr", "order_line_nbr": "line_nbr"}, {"order_total": "order_total"}, "inner"),
        ],
    )
    carrier = F.col("carrier")
    wide = joins.join_expr(
        wide, slugs.select(F.col("carrier").alias("_carrier"), F.col("slug").alias("_slug")),
        F.when(carrier == "SmartPost", "fedex").otherwise(carrier), "_carrier",
    )
    customer = p.prefer_filled(F.col("attention"), F.col("account_name"))
    own_contact = (F.col("_class") == "B2B") & (F.col("_contact") != "") & (F.col("account_name") == F.col("_account"))
    two_words = F.ltrim("_contact").contains(" ")
    freight = F.col("warehouse").isin(*freight_sites) & carrier.isNull() & F.col("ship_via").isin(*freight_methods)
    return wide.select(
        "shipment_nbr", "ship_line_nbr", "order_nbr", "order_line_nbr", "inventory_cd", "product_title", "tracking",
        customer.alias("customer"),
        F.when(own_contact, text.first_name_strict(F.col("_contact"))).otherwise(text.first_name_strict(customer)).alias("first_name"),
        F.when(own_contact & two_words, text.last_name_strict(F.col("_contact"))).otherwise(text.last_name_strict(customer)).alias("last_name"),
        text.phone_with_prefix(F.col("phone"), F.col("country")).alias("phone_number"),
        "warehouse", "origin_line1", "origin_city", "origin_country", "order_total",
        p.first_match(
            [(F.col("tracking").like("%,9%"), "usps"), (F.col("_slug").isNotNull(), F.col("_slug")), (freight, "sekologistics")], ""
        ).alias("slug"),
        "carrier",
    )


def orders_sent_since(ledger: DataFrame, as_of: datetime, lookback: str = "60 MINUTES", zone: str = "America/New_York") -> DataFrame:
    """Ledger rows sent after a cutoff; ``as_of`` is UTC, the ledger is local time."""
    cutoff = dates.shift_zone(F.lit(as_of), "UTC", zone) - F.expr(f"INTERVAL {lookback}")
    return ledger.withColumn("cutoff", cutoff).where(F.col("sent_at") >= F.col("cutoff")).withColumn(
        "order_concat", text.join_text(F.col("order_nbr"), "-", F.col("decoded_status"))
    )


def recent_deletions(tombstones: DataFrame, spec: TableSpec, as_of: datetime, lookback: str = "2 HOURS") -> DataFrame:
    """Fresh tombstones in the shape of their target table."""
    fresh = tombstones.where(p.changed_since(F.col("deleted_at"), as_of, lookback))
    return tables.conform(fresh, spec)


def purge(
    orders: DataFrame, shipments: DataFrame, order_deletes: DataFrame, line_deletes: DataFrame, shipment_deletes: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """The order and shipment copies without what the tombstones name.

    Orders go by number, lines by order number and line, shipments by number.
    """
    kept, _ = changes.delete_by_keys(orders, order_deletes, ["order_nbr"])
    kept = joins.not_in_ledger(kept, line_deletes, ["order_nbr", "line_nbr"], basis=orders)
    left, _ = changes.delete_by_keys(shipments, shipment_deletes, ["shipment_nbr"])
    return kept, left


def fulfilment_audit(fulfilment: DataFrame, deletions: DataFrame, n: int) -> DataFrame:
    """Newest unfinished fulfilments of shipments that still exist."""
    unfinished = fulfilment.where(
        ~F.col("ff_status").isin("DELETED", "COMPLETED", "ERROR", "TRANSMITTED")
        & ~F.col("shipment_status").isin("COMPLETED", "Confirmed", "Invoiced", "")
    )
    live = joins.not_in_ledger(unfinished, deletions, ["shipment_nbr", "order_type"], basis=fulfilment)
    return rows.newest(live, n, [("posted_at", "desc"), "id"])


def stuck_returns(
    send_log: DataFrame, returns: DataFrame, items: DataFrame, deletions: DataFrame, link: str,
    error: str = "200 ERROR", reason: str = "Item does not exist",
) -> DataFrame:
    """Returns the warehouse refused for an unknown item and that still matter."""
    refused = send_log.where(F.col("response").startswith(error) & F.col("response").endswith(reason))
    wide = enrich(
        refused,
        [
            Lookup(returns, {"key_value": "return_nbr"},
                   {"return_nbr": "return_nbr", "return_status": "return_status", "_item": "inventory_cd", "return_type": "return_type"}),
            Lookup(items, {"_item": "inventory_cd"}, {"descr": "descr"}),
        ],
    ).where(p.null_or(F.col("return_nbr"), F.col("return_status") == "Open"))
    gone = deletions.select(F.col("order_nbr").alias("key_value"))
    return joins.not_in_ledger(wide, gone, ["key_value"], basis=send_log).select(
        "key_value", "response", "return_status", F.rtrim("_item").alias("inventory_cd"), "descr", "return_type",
        text.join_text(link, F.col("return_type"), "/", F.col("return_nbr")).alias("return_link"),
    ).distinct()


def closed_shipments_with_lines(closed: DataFrame) -> DataFrame:
    """Closed shipments under their plain number, with the lines of that number."""
    plain = closed.withColumn("rma_number", text.normalize_ref(F.col("rma_number")))
    return with_group_total(plain, ["rma_number"], {"lines": F.count("rma_number")})


def ready_shipments(
    fulfil: DataFrame, partner_items: DataFrame, max_items: int, ready: str = "Ready", done: str = "Complete"
) -> DataFrame:
    """Ready partner shipments with package numbers and a completion label.

    ``fulfil``: ``shipment_nbr, ship_line_nbr, split_line_nbr, inventory_cd,
    ship_qty, rs_qty, tracking, rs_status, ff_status, shipment_id``.
    ``partner_items``: ``shipment_id, shipment_nbr, inventory_cd, tracking,
    courier_code, courier_name``. Shipments with more than ``max_items`` items on
    one tracking number are left out.
    """
    labelled = completion_label(
        fulfil, "shipment_nbr", "inventory_cd", "rs_qty", "ship_qty", "rs_status", "ff_status", "complete"
    )
    order: list[Order] = ["ship_line_nbr", "split_line_nbr", "inventory_cd"]
    in_scope = fulfil.where((F.col("ff_status") == ready) & (F.col("ff_status") != done))
    listed = labelled.where((F.col("ff_status") == ready) & (F.col("ff_status") != done))
    package, shipment = ["shipment_nbr", "tracking"], ["shipment_nbr"]
    hot = group_pieces(in_scope, shipment)
    hot_package = None if hot is None else group_pieces(in_scope, package)
    count = F.count(F.lit(1))
    numbered = with_sequence(listed, package, order, "num", basis=in_scope, hot=hot_package)
    counted = with_group_total(numbered, package, {"items_on_package": count}, basis=in_scope, hot=hot_package)
    numbered = with_sequence(counted, shipment, order, "package_num", basis=in_scope, hot=hot)
    counted = with_group_total(numbered, shipment, {"max_package_num": count}, basis=in_scope, hot=hot)
    small = (
        in_scope.groupBy(*package).agg(count.alias("n"))
        .groupBy(*shipment).agg(F.max("n").alias("n"))
        .where(F.col("n") <= max_items)
    )
    kept = joins.restrict_to(counted, small, shipment, hot=hot)
    return enrich(
        kept,
        [
            Lookup(
                partner_items,
                {c: c for c in ("shipment_id", "shipment_nbr", "inventory_cd", "tracking")},
                {"courier_code": "courier_code", "courier_name": "courier_name"}, "inner",
            )
        ],
    )


def link_per_return(status: DataFrame, link: str, excluded: Sequence[str] = ("3", "4")) -> DataFrame:
    return status.where(~F.col("rma_type").isin(*excluded)).select(
        "rma_number", "rma_id", text.join_text(link, F.col("rma_id").cast("string")).alias("link_3pl"), "rma_type"
    ).distinct()


def packed_events(
    events: DataFrame, json: str, shipments: DataFrame, as_of: datetime, lookback: str = "365 DAYS",
    finished: Sequence[str] = ("Completed", "Confirmed", "Invoiced"),
) -> DataFrame:
    """Packed items of unfinished recent shipments, from the event feed."""
    live = shipments.where(
        ~F.col("status").isin(*finished) & p.changed_since(F.col("order_date"), as_of, lookback)
    )
    return joins.restrict_to(nested.expand_packed_events(events, json), live, ["shipment_nbr"])


def returns_awaiting_receipt(status: DataFrame, as_of: datetime, lookback: str = "21 DAYS") -> DataFrame:
    closed = (F.col("rma_status") == "CLOSED") | (F.col("line_status") == "RECEIVED")
    return status.where(
        (F.col("rma_type") == "3") & closed & p.changed_since(F.col("modified_at"), as_of, lookback)
    )


def receipts_to_create(open_returns: DataFrame, awaiting: DataFrame) -> DataFrame:
    """Open return lines with the newest warehouse line of the same return."""
    reports = awaiting.select(
        text.normalize_ref(F.col("rma_number")).alias("return_nbr"),
        F.col("inventory_cd").alias("inventory_cd_3pl"), F.col("qty").alias("qty_3pl"), "created_at", "rma_id", "rma_line_id",
    )
    first = matching.match_first(
        open_returns, reports, ["return_nbr"], [("created_at", "desc"), "rma_id", "rma_line_id"]
    )
    return first.select(
        "order_type", F.col("return_nbr").alias("order_nbr"), "acct_cd", "inventory_cd", "qty", "inventory_cd_3pl", "qty_3pl"
    )


def status_conflicts(copy: DataFrame) -> DataFrame:
    """Orders that show several statuses: the best-ranked one and the next."""
    rank = p.decode(F.col("status"), fixed.STATUS_RANKS, fixed.OTHER_STATUS_RANK)
    return joins.ranked_conflicts(copy, "order_nbr", "status", rank)


def clean_status_conflicts(copy: DataFrame, truth: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows to delete for a wrong status, and their number per true status."""
    doomed = changes.resolve_status_conflicts(copy, status_conflicts(copy), truth, "order_nbr", "status")
    true = truth.select("order_nbr", F.col("status").alias("true_status"))
    counts = enrich(status_conflicts(copy).select("order_nbr"), [Lookup(true, {"order_nbr": "order_nbr"}, {"true_status": "true_status"}, "inner")])
    return doomed, counts.groupBy("true_status").agg(F.count(F.lit(1)).alias("orders"))


def numbers_to_recheck(
    closed: DataFrame, receipts: DataFrame, send_log: DataFrame, status: DataFrame, as_of: datetime,
    lookback: str = "2 DAYS", reason: str = "Item does not exist",
) -> DataFrame:
    """Return numbers whose warehouse status is open, unknown or freshly checked."""
    sent = send_log.where(~F.col("response").endswith(reason))
    numbers = rows.union_keys(
        [(closed, "rma_number"), (receipts, "rma_number"), (sent, "key_value")], "rma_number"
    )
    wide = enrich(
        numbers,
        [Lookup(status, {"rma_number": "rma_number"},
                {c: c for c in ("last_checked", "rma_status", "line_status")})],
    )
    state = F.col("rma_status")
    fresh = p.changed_since(F.col("last_checked"), as_of, lookback) & (state != "OPEN")
    return wide.where(p.null_or(state, ~state.isin("CLOSED", "")) | fresh).distinct()


def packages_to_add(
    open_lines: DataFrame, ready: DataFrame, events: DataFrame, closed: DataFrame, as_of_text: str, part_rows: int = nested.PART_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Packages to add to open shipments, as matched rows and as documents.

    Packed events come first (by shipment and item), else the ready list (by
    shipment, line, split and item); the other partner's closed shipments are
    added on top, one per shipment item.
    """
    base = open_lines.select("shipment_nbr", "ship_line_nbr", "split_line_nbr", "inventory_cd", "ship_qty", "order_qty")
    ref = text.normalize_ref(F.col("shipment_nbr"))
    payload = ["qty_3pl", "tracking", "items_on_package", "courier", "instructions"]
    from_events = events.select(
        ref.alias("shipment_nbr"), "inventory_cd", F.col("qty").alias("qty_3pl"), "tracking",
        F.col("order_item_qty").cast("bigint").alias("items_on_package"), "courier", F.lit(None).cast("string").alias("instructions"),
    )
    from_ready = ready.select(
        ref.alias("shipment_nbr"), "ship_line_nbr", "split_line_nbr", "inventory_cd", F.col("rs_qty").alias("qty_3pl"), "tracking",
        "items_on_package", F.col("courier_name").alias("courier"), F.col("complete").alias("instructions"),
    )
    from_closed = rows.distinct_by(
        closed.select(
            F.col("rma_number").alias("shipment_nbr"), "inventory_cd", F.col("qty_shipped").alias("qty_3pl"), "tracking",
            F.col("lines").alias("items_on_package"), F.col("carrier_code").alias("courier"), F.lit(None).cast("string").alias("instructions"),
        ),
        ["shipment_nbr", "inventory_cd"],
        ["tracking", "qty_3pl", "courier"],
    )
    item_key = ["shipment_nbr", "inventory_cd"]
    matched = matching.match_precedence(
        base,
        [("events", from_events, item_key), ("ready", from_ready, ["shipment_nbr", "ship_line_nbr", "split_line_nbr", "inventory_cd"])],
        [("closed", from_closed, item_key)],
    ).select("shipment_nbr", "ship_line_nbr", "split_line_nbr", "inventory_cd", "ship_qty", "order_qty", *payload, "source")
    # the matched rows are a result of their own and feed the documents: computed once
    matched = settle(matched, "matched")
    docs = nested.package_documents(
        matched.withColumnRenamed("qty_3pl", "qty"),
        ["ship_line_nbr", "split_line_nbr", "inventory_cd", "source", "qty", "courier", "items_on_package", "instructions"],
        as_of_text,
        part_rows=part_rows,
    )
    return matched, docs


def failed_payloads(api_log: DataFrame, day: Column, excluded: Sequence[str] = ()) -> DataFrame:
    """Distinct payloads that failed on a day, with shipment and customer."""
    failed = api_log.where((F.col("response") == "Failure") & (F.col("ts").cast("date") == day))
    if excluded:
        failed = failed.where(~F.col("key_value").isin(*excluded))
    return failed.select("payload").distinct().select(
        "payload",
        F.get_json_object("payload", "$.ShipmentNbr.value").alias("shipment_nbr"),
        F.get_json_object("payload", "$.CustomerID.value").alias("customer_id"),
    )


def link_write_back(missing: DataFrame, links: DataFrame) -> DataFrame:
    """Attribute rows to write: link or id of the return, by attribute name."""
    return changes.attribute_updates(
        missing, links.drop("rma_type"), {"shipment_nbr": "rma_number"},
        {"AttributeLINK3PL": F.col("link_3pl"), "AttributeRMAID": F.col("rma_id")},
    ).select("company_id", "record_id", "field_name", "value_numeric", "value_date", "value_string", "value_text")
