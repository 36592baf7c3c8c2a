"""Order and shipment extracts over the ERP tables.

Each function takes the tables it reads as a mapping of frames. Frames hold one
company: apply ``of_company`` to the scans first, so that the filter reaches
them. Column names are those of ``catalog/erp_tables.py``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from opsflow.functions import fixed, numbers, predicates as p, text
from opsflow.operators import aggregates, joins, rows
from opsflow.operators.joins import Lookup, enrich
from opsflow.operators.nested import collect_parts
from opsflow.operators.skew import FIND, group_pieces
from opsflow.operators.windows import with_group_total

Erp = Mapping[str, DataFrame]
ORDER = {"order_type": "order_type", "order_nbr": "order_nbr"}
ADDRESS = ("line1", "line2", "city", "state", "postal_code", "country")
CONTACT = ("full_name", "attention", "phone1", "phone2", "email")


def of_company(tables: Erp, company_id: int) -> dict[str, DataFrame]:
    """The rows of one company, for every table that has the column."""
    return {
        name: df.where(F.col("company_id") == company_id) if "company_id" in df.columns else df
        for name, df in tables.items()
    }


def address(erp: Erp, key: str, prefix: str, how: str = "left", extra: Sequence[str] = ()) -> Lookup:
    return Lookup(
        erp["address"], {key: "address_id"}, {f"{prefix}{c}": c for c in (*ADDRESS, *extra)}, how
    )


def contact(erp: Erp, key: str, prefix: str, how: str = "left") -> Lookup:
    return Lookup(erp["contact"], {key: "contact_id"}, {f"{prefix}{c}": c for c in CONTACT}, how)


def account(erp: Erp, key: str, prefix: str = "", how: str = "inner") -> Lookup:
    return Lookup(
        erp["account"], {key: "account_id"}, {f"{prefix}acct_cd": "acct_cd", f"{prefix}acct_name": "acct_name"}, how
    )


def owner(erp: Erp, how: str = "left") -> Lookup:
    """The order's owner: the account whose default contact owns it."""
    return Lookup(
        erp["account"], {"owner_id": "contact_id"}, {"owner_cd": "acct_cd", "owner_name": "acct_name"}, how
    )


def item(erp: Erp, how: str = "inner") -> Lookup:
    return Lookup(
        erp["item"],
        {"inventory_id": "inventory_id"},
        {"inventory_cd": "inventory_cd", "item_descr": "descr", "item_class_id": "item_class_id", "is_stock": "is_stock"},
        how,
    )


def item_class(erp: Erp) -> Lookup:
    return Lookup(
        erp["item_class"], {"item_class_id": "item_class_id"},
        {"item_class_cd": "item_class_cd", "item_class_descr": "descr"}, "inner",
    )


def site(erp: Erp, key: str = "site_id", out: str = "site_cd", how: str = "inner") -> Lookup:
    return Lookup(erp["site"], {key: "site_id"}, {out: "site_cd"}, how)


def sales_people(erp: Erp) -> list[Lookup]:
    return [
        Lookup(erp["customer_sales_person"], {"customer_id": "customer_id"}, {"_sp": "sales_person_id"}),
        Lookup(erp["sales_person"], {"_sp": "sales_person_id"}, {"sales_person_cd": "sales_person_cd"}),
    ]


def ship_code(via: Column) -> Column:
    """Carrier code: ground where no method is given, null for unknown methods."""
    return p.decode(F.coalesce(via, F.lit("GROUND")), fixed.SHIP_CODES)


def trimmed(*names: str) -> list[Column]:
    return [F.rtrim(name).alias(name) for name in names]


# -- order lines -----------------------------------------------------------


def sales_orders(
    erp: Erp, as_of: datetime, lookback: str = "2 HOURS",
    excluded: Sequence[str] = ("QT", "RA", "RC", "RR", "RM"), domain: str = "corp",
) -> DataFrame:
    """Changed order lines with customer, item, salesperson and shipment data.

    Shipping address and contact fall back to billing. The shipment status is
    decoded from the shipment's own code.
    """
    changed = erp["order_header"].where(
        ~F.col("order_type").isin(*excluded) & p.changed_since(F.col("modified_at"), as_of, lookback)
    )
    # parties and people are facts of an order: one row each, before its lines come in; short
    # values and equal keys first, so that few shuffles carry contacts and addresses
    headers = enrich(
        changed,
        [
            account(erp, "customer_id"),
            Lookup(erp["customer"], {"customer_id": "account_id"}, {"customer_class": "class_id"}, "inner"),
            *sales_people(erp),
            Lookup(erp["users"], {"created_by_id": "user_id"}, {"_created": "user_name"}),
            Lookup(erp["users"], {"modified_by_id": "user_id"}, {"_modified": "user_name"}),
            owner(erp),
            Lookup(erp["contact"], {"owner_id": "contact_id"}, {"owner_email": "email"}),
            contact(erp, "ship_contact_id", "s_"),
            contact(erp, "bill_contact_id", "b_"),
            address(erp, "ship_address_id", "s_"),
            address(erp, "bill_address_id", "b_"),
        ],
    )
    headers = joins.lookup_code(headers, erp["status_lookup"], "SOOrder", "status", "order_status", "inner")
    shipped = Lookup(
        erp["shipment_line"],
        {"order_type": "orig_order_type", "order_nbr": "orig_order_nbr", "line_nbr": "orig_line_nbr", "inventory_id": "inventory_id"},
        {"shipment_nbr": "shipment_nbr", "_ship_type": "shipment_type", "_ship_site": "site_id"},
    )
    lines = erp["order_line"].withColumnsRenamed({"orig_order_type": "line_orig_type", "orig_order_nbr": "line_orig_nbr"})
    # what is true of a line is looked up without the columns of its order, which come in last
    wide = enrich(
        lines.join(changed.select(*ORDER), list(ORDER), "left_semi"),
        [
            shipped,
            Lookup(erp["shipment"], {"shipment_nbr": "shipment_nbr", "_ship_type": "shipment_type"},
                   {"ship_date": "ship_date", "_ship_status": "status"}),
            site(erp, out="line_warehouse", how="left"),
            site(erp, "_ship_site", "ship_warehouse", "left"),
            Lookup(erp["item_replenishment"], {"inventory_id": "inventory_id"}, {"replenishment_class": "class_id"}),
            item(erp),
            Lookup(headers, ORDER, {c: c for c in headers.columns if c not in ORDER}, "inner"),
        ],
    )
    wide = joins.lookup_code(wide, erp["status_lookup"], "SOShipment", "_ship_status", "ship_status")

    def either(name: str) -> Column:
        return p.prefer(F.col(f"s_{name}"), F.col(f"b_{name}"))

    return wide.select(
        "order_type", "order_nbr", "line_nbr",
        F.col("order_date").cast("date").alias("date_placed"),
        *trimmed("acct_cd"), "acct_name", "customer_class", *trimmed("inventory_cd", "item_descr"),
        numbers.whole(F.col("order_qty")).alias("quantity"),
        numbers.money(F.col("line_amt") + F.col("disc_amt")).alias("line_price"),
        numbers.money(F.col("order_total")).alias("order_total"),
        "order_status", "customer_order_nbr", *trimmed("owner_cd"), "owner_name", "owner_email",
        *trimmed("sales_person_cd", "discount_id"), "modified_at",
        numbers.money(F.col("disc_amt")).alias("disc_amt"),
        numbers.money(F.col("ext_cost")).alias("line_cost"),
        F.left(either("phone1"), F.lit(20)).alias("phone"), either("email").alias("email"),
        either("line1").alias("address_line1"), text.blank_to_null(either("line2")).alias("address_line2"),
        either("city").alias("city"), either("state").alias("state"),
        either("postal_code").alias("zip"), either("country").alias("country"),
        numbers.money(F.col("line_amt")).alias("line_amount"),
        "replenishment_class", "is_stock", *trimmed("line_warehouse"), "ship_date", "shipment_nbr",
        "ship_status", *trimmed("ship_warehouse"), "completed",
        F.col("line_orig_type").alias("original_order_type"), F.col("line_orig_nbr").alias("original_order_nbr"),
        numbers.money(F.col("freight_amt")).alias("freight_price"),
        numbers.money(F.col("premium_freight_amt")).alias("premium_freight_price"),
        numbers.money(F.col("freight_total")).alias("freight_total"), "created_at",
        text.user_name(F.col("_created"), domain).alias("created_by"),
        text.user_name(F.col("_modified"), domain).alias("modified_by"),
    )


def quotes(erp: Erp, as_of: datetime, lookback: str = "1 DAY", quote_type: str = "QT") -> DataFrame:
    """Changed quotes with their lines and the orders made from them.

    Quotes without lines stay; the line number, part of the key, is then 99.
    """
    start = F.date_trunc("day", F.lit(as_of) - F.expr(f"INTERVAL {lookback}"))
    changed = erp["order_header"].where(
        (F.col("order_type") == quote_type) & (F.col("modified_at") >= start)
    )
    wide = enrich(
        changed,
        [
            account(erp, "customer_id"),
            Lookup(erp["customer"], {"customer_id": "account_id"}, {"customer_class": "class_id"}, "inner"),
            address(erp, "ship_address_id", "s_"),
            contact(erp, "ship_contact_id", "s_"),
            Lookup(erp["order_line"], ORDER, {c: c for c in (
                "line_nbr", "inventory_id", "site_id", "order_qty", "line_amt", "disc_amt", "ext_cost", "discount_id")}),
            item(erp, "left"),
            Lookup(erp["item_replenishment"], {"inventory_id": "inventory_id"}, {"replenishment_class": "class_id"}),
            site(erp, out="line_warehouse", how="left"),
            *sales_people(erp),
            owner(erp),
            Lookup(erp["order_header"], {"order_type": "orig_order_type", "order_nbr": "orig_order_nbr"},
                   {"attached_order_type": "order_type", "attached_order_nbr": "order_nbr"}),
        ],
    )
    wide = joins.lookup_code(wide, erp["status_lookup"], "SOOrder", "status", "order_status", "inner")
    result = wide.select(
        "order_type", F.col("order_nbr").alias("quote_nbr"), "line_nbr",
        F.col("order_date").cast("date").alias("date_placed"), *trimmed("acct_cd"), "acct_name", "customer_class",
        *trimmed("inventory_cd", "item_descr"), numbers.whole(F.col("order_qty")).alias("quantity"),
        numbers.money(F.col("line_amt")).alias("line_price"), numbers.money(F.col("order_total")).alias("order_total"),
        "order_status", "customer_order_nbr", *trimmed("owner_cd"), "owner_name",
        F.lit(None).cast("string").alias("owner_email"), *trimmed("sales_person_cd"), "discount_id",
        numbers.money(F.col("disc_amt")).alias("disc_amt"), numbers.money(F.col("ext_cost")).alias("line_cost"),
        numbers.money(F.col("paid_amt")).alias("total_paid"),
        F.col("s_phone1").alias("phone"), F.col("s_email").alias("email"), F.col("s_line1").alias("address_line1"),
        text.blank_to_null(F.col("s_line2")).alias("address_line2"), F.col("s_city").alias("city"),
        F.col("s_state").alias("state"), F.col("s_postal_code").alias("zip"), F.col("s_country").alias("country"),
        numbers.money(F.col("line_amt")).alias("line_amount"), "replenishment_class", "is_stock", *trimmed("line_warehouse"), "modified_at", "created_at",
        "attached_order_type", "attached_order_nbr",
    )
    return rows.fill_key(result, "line_nbr", 99)


def phone_order_lines(
    erp: Erp, as_of: datetime, lookback: str = "1 DAY",
    order_types: Sequence[str] = ("PH", "BF"), excluded_items: str = "NSG-",
) -> DataFrame:
    """Recent phone-order lines with contact name and agent."""
    recent = erp["order_header"].where(
        F.col("order_type").isin(*order_types)
        & p.any_changed_since([F.col("order_date"), F.col("modified_at")], as_of, lookback)
    )
    wide = enrich(
        erp["order_line"].select("order_type", "order_nbr", "line_nbr", "inventory_id", "line_amt"),
        [
            Lookup(recent, ORDER, {c: c for c in ("customer_id", "owner_id", "ship_contact_id", "order_date", "status")}, "inner"),
            item(erp),
            account(erp, "customer_id"),
            contact(erp, "ship_contact_id", "s_", "inner"),
            owner(erp, "inner"),
        ],
    ).where(F.col("s_phone1").isNotNull() & ~F.col("inventory_cd").contains(excluded_items))
    wide = joins.lookup_code(wide, erp["status_lookup"], "SOOrder", "status", "order_status")
    return wide.select(
        *trimmed("acct_cd"),
        p.contact_name(F.col("s_full_name"), F.col("s_attention"), F.col("acct_name")).alias("name"),
        F.col("s_phone1").alias("phone"), "order_nbr", "line_nbr",
        F.date_format("order_date", "yyyy-MM-dd").alias("order_date"), "order_status",
        *trimmed("inventory_cd"), "item_descr", numbers.money(F.col("line_amt")).alias("line_amt"),
        F.col("owner_name").alias("agent"),
    ).distinct()


# -- shipments -------------------------------------------------------------


def carrier_slug(tracking: Column) -> Column:
    """Carrier by the first characters of a tracking number."""
    one, two = F.left(tracking, F.lit(1)), F.left(tracking, F.lit(2))
    return p.first_match(
        [(one == "9", "usps"), ((one == "8") | two.isin("38", "39", "87"), "fedex"), (two == "1Z", "ups")]
    )


def tracked_shipments(
    erp: Erp, since: date, excluded_sites: Sequence[str] = (), excluded_orders: Sequence[str] = (),
) -> DataFrame:
    """Shipped and tracked lines with addresses, carrier and package value class.

    Order lines join by item, so an item on several lines of an order repeats.
    """
    # what is true of a shipment is looked up once per shipment, before its lines come in
    shipments = enrich(
        erp["shipment"].where(F.col("ship_date") >= F.lit(since)).select(
            "shipment_nbr", "shipment_type", "status", "ship_date", "customer_id", "ship_contact_id", "ship_address_id", "package_count", "note_id"
        ),
        [
            account(erp, "customer_id"),
            Lookup(erp["customer"], {"customer_id": "account_id"}, {"customer_class": "class_id"}, "inner"),
            contact(erp, "ship_contact_id", "s_", "inner"),
            address(erp, "ship_address_id", "dest_", "inner"),
        ],
    )
    shipments = joins.attach_attributes(
        shipments, erp["shipment_attributes"], {"note_id": "record_id"},
        {
            "courier_code": ("AttributeCOURCODE", "value_string"),
            "courier_name": ("AttributeCOURNAME", "value_string"),
            "carrier_name": ("AttributeCARRIER", "value_string"),
            "_sent": ("AttributeSHP2WH", "value_numeric"),
        },
    )
    shipments = joins.lookup_code(shipments, erp["status_lookup"], "SOShipment", "status", "ship_status", "inner")
    packed = enrich(
        erp["package_split"].select("shipment_nbr", "shipment_line_nbr", "inventory_id", "package_line_nbr"),
        [Lookup(erp["package"].where(F.col("track_number").isNotNull()),
                {"shipment_nbr": "shipment_nbr", "package_line_nbr": "line_nbr"},
                {"track_number": "track_number", "tracking_created": "created_at"}, "inner")],
    )
    wide = enrich(
        erp["shipment_line"].withColumnRenamed("line_nbr", "ship_line_nbr").drop("modified_at"),
        [
            Lookup(shipments, {"shipment_nbr": "shipment_nbr", "shipment_type": "shipment_type"},
                   {c: c for c in shipments.columns if c not in ("shipment_nbr", "shipment_type")}, "inner"),
            Lookup(packed, {"shipment_nbr": "shipment_nbr", "ship_line_nbr": "shipment_line_nbr", "inventory_id": "inventory_id"},
                   {"track_number": "track_number", "tracking_created": "tracking_created"}, "inner"),
            Lookup(erp["order_line"], {"orig_order_type": "order_type", "orig_order_nbr": "order_nbr", "inventory_id": "inventory_id"},
                   {"order_qty": "order_qty", "line_shipped_qty": "shipped_qty", "unit_price": "unit_price", "line_amt": "line_amt"}, "inner"),
            Lookup(erp["order_header"].where(~F.col("order_nbr").isin(*excluded_orders)) if excluded_orders else erp["order_header"],
                   {"orig_order_type": "order_type", "orig_order_nbr": "order_nbr"},
                   {"freight_amt": "freight_amt", "order_total": "order_total", "order_date": "order_date"}, "inner"),
            item(erp),
            item_class(erp),
            Lookup(erp["site"], {"site_id": "site_id"}, {"site_cd": "site_cd", "_wa": "address_id"}, "inner"),
            address(erp, "_wa", "origin_", "inner"),
        ],
    )
    if excluded_sites:
        wide = wide.where(~F.rtrim("site_cd").isin(*excluded_sites))
    # packages are parts of shipments: without a hot shipment no package is hot
    hot = None if group_pieces(erp["shipment_line"], ["shipment_nbr"]) is None else FIND
    valued = with_group_total(
        wide, ["shipment_nbr", "orig_order_nbr", "track_number"], {"_value": F.sum("line_amt")}, hot=hot
    )
    customer = p.prefer_filled(F.col("s_attention"), F.col("s_full_name"))
    tracking = text.clean_tracking(F.col("track_number"), fixed.TRACKING_PREFIXES)
    named = valued.withColumns({"customer": customer, "tracking": tracking})
    return named.select(
        "shipment_nbr", "ship_line_nbr", F.col("ship_status").alias("status"),
        F.col("orig_order_nbr").alias("order_nbr"), F.col("orig_line_nbr").alias("order_line_nbr"),
        F.col("orig_order_type").alias("order_type"), *trimmed("inventory_cd"), F.col("item_descr").alias("product_title"),
        numbers.whole(F.col("order_qty")).alias("order_qty"), numbers.whole(F.col("line_shipped_qty")).alias("ship_qty"),
        "tracking", F.col("tracking_created").cast("date").alias("tracking_created"), F.col("ship_date").cast("date").alias("ship_date"),
        F.rtrim("acct_cd").alias("customer_id"), "customer",
        text.first_name(F.col("customer")).alias("first_name"), text.last_name(F.col("customer")).alias("last_name"),
        text.phone_with_prefix(F.col("s_phone1"), F.col("dest_country")).alias("phone_number"), F.col("s_email").alias("email"),
        *[c for c in named.columns if c.startswith(("dest_", "origin_"))],
        F.rtrim("site_cd").alias("warehouse"), "package_count",
        numbers.money(F.col("unit_price") * F.col("shipped_qty")).alias("line_price"),
        numbers.money(F.col("line_amt")).alias("line_amt"), numbers.money(F.col("freight_amt")).alias("freight_amt"),
        F.col("_sent").cast("int").alias("sent_to_warehouse"), numbers.money(F.col("order_total")).alias("order_total"),
        carrier_slug(F.col("tracking")).alias("slug"), "courier_code", "courier_name", "carrier_name",
        F.col("order_date").cast("date").alias("order_date"), *trimmed("customer_class", "item_class_cd"), "item_class_descr",
        p.bucketize(F.col("_value"), fixed.VALUE_BOUNDS, fixed.VALUE_LABELS).alias("package_value"),
    )


def order_shipment_detail(
    erp: Erp, link: str, excluded: Sequence[str] = ("QT", "CM", "ZA"), orders: DataFrame | None = None
) -> DataFrame:
    """Order lines with their shipment lines and packages, one row each.

    ``orders`` (a list of order numbers) restricts the scan by a semi join.
    """
    headers = erp["order_header"].where(~F.col("order_type").isin(*excluded))
    if orders is not None:
        headers = joins.restrict_to(headers, orders, ["order_nbr"])
    wide = enrich(
        erp["order_line"].select("order_type", "order_nbr", "line_nbr", "inventory_id", "site_id", "order_qty"),
        [
            Lookup(headers, ORDER, {"order_date": "order_date", "status": "status"}, "inner"),
            Lookup(erp["order_line_split"], {**ORDER, "line_nbr": "line_nbr"}, {"split_line_nbr": "split_line_nbr"}, "inner"),
            Lookup(erp["shipment_line"],
                   {"order_nbr": "orig_order_nbr", "line_nbr": "orig_line_nbr", "split_line_nbr": "orig_split_line_nbr"},
                   {"shipment_nbr": "shipment_nbr", "_type": "shipment_type", "ship_line_nbr": "line_nbr", "_qty": "shipped_qty"}, "inner"),
            Lookup(erp["shipment"], {"shipment_nbr": "shipment_nbr", "_type": "shipment_type"},
                   {"ship_date": "ship_date", "_ship_status": "status"}, "inner"),
            Lookup(erp["shipment_split"], {"shipment_nbr": "shipment_nbr", "ship_line_nbr": "line_nbr", "inventory_id": "inventory_id"},
                   {"_split": "split_line_nbr"}),
            Lookup(erp["package_split"],
                   {"shipment_nbr": "shipment_nbr", "ship_line_nbr": "shipment_line_nbr", "_split": "shipment_split_line_nbr"},
                   {"_package": "package_line_nbr", "tracking_created": "created_at"}),
            Lookup(erp["package"], {"shipment_nbr": "shipment_nbr", "_package": "line_nbr"}, {"tracking": "track_number"}),
            site(erp, out="warehouse", how="left"),
            item(erp),  # last: no other shuffle carries its texts
        ],
    )
    wide = joins.lookup_code(wide, erp["status_lookup"], "SOOrder", "status", "order_status", "inner")
    wide = joins.lookup_code(wide, erp["status_lookup"], "SOShipment", "_ship_status", "ship_status", "inner")
    return wide.select(
        F.col("order_date").cast("date").alias("order_date"), "order_type", "order_nbr", "order_status", "line_nbr",
        numbers.whole(F.col("order_qty")).alias("line_qty"), *trimmed("inventory_cd"), "item_descr", *trimmed("warehouse"),
        "shipment_nbr", "ship_line_nbr", F.col("ship_date").cast("date").alias("ship_date"),
        numbers.whole(F.col("_qty")).alias("ship_line_qty"), "ship_status", "tracking", "tracking_created",
        text.join_text(link, F.col("shipment_nbr")).alias("ship_link"),
    ).distinct()


def open_shipments_to_pack(
    erp: Erp, as_of: datetime, lookback: str, site_prefix: str, sites: Sequence[str], box: str = "DEFAULT BOX"
) -> DataFrame:
    """Open shipment lines without a tracking number at the given warehouses."""
    chosen = erp["site"].where(F.rtrim("site_cd").isin(*sites) | F.col("site_cd").startswith(site_prefix))
    open_ones = erp["shipment"].where(F.col("status") == "N")
    wide = enrich(
        erp["shipment_line"].select("shipment_nbr", "line_nbr", "inventory_id", "shipped_qty", "orig_order_qty", F.col("modified_at").alias("_m2")),
        [
            Lookup(open_ones, {"shipment_nbr": "shipment_nbr"},
                   {"status": "status", "site_id": "site_id", "customer_id": "customer_id", "_m1": "modified_at"}, "inner"),
            Lookup(chosen, {"site_id": "site_id"}, {"site_cd": "site_cd"}, "inner"),
            Lookup(erp["shipment_split"], {"shipment_nbr": "shipment_nbr", "line_nbr": "line_nbr", "inventory_id": "inventory_id"},
                   {"split_line_nbr": "split_line_nbr"}, "inner"),
            item(erp),
            Lookup(erp["package_split"],
                   {"shipment_nbr": "shipment_nbr", "split_line_nbr": "shipment_split_line_nbr", "line_nbr": "shipment_line_nbr"},
                   {"package_line_nbr": "package_line_nbr", "_m3": "modified_at"}),
            Lookup(erp["package"], {"shipment_nbr": "shipment_nbr", "package_line_nbr": "line_nbr"}, {"tracking": "track_number"}),
            account(erp, "customer_id"),
        ],
    )
    stamps = [F.col("_m1"), F.col("_m2"), F.col("_m3")]
    return wide.where(p.any_changed_since(stamps, as_of, lookback) & F.col("tracking").isNull()).select(
        "shipment_nbr", F.col("line_nbr").alias("ship_line_nbr"), F.lit(box).alias("box_id"), "split_line_nbr", "inventory_id",
        *trimmed("inventory_cd", "acct_cd"), numbers.whole(F.col("shipped_qty")).alias("ship_qty"),
        numbers.whole(F.col("orig_order_qty")).alias("order_qty"), "tracking", *trimmed("site_cd"),
        text.join_text(F.col("shipment_nbr"), "-", F.rtrim("inventory_cd")).alias("ship_item"),
        p.decode(F.col("status"), fixed.SHIPMENT_STATUS).alias("ship_status"), "package_line_nbr",
        F.when(F.col("package_line_nbr").isNotNull(), "Has Package").otherwise("No Package").alias("package"),
    )


def shipments_ready_to_confirm(erp: Erp) -> DataFrame:
    """Open shipments whose shipped and packed quantities agree, twice."""
    open_ones = erp["shipment"].where(F.col("status") == "N").select("shipment_nbr")
    lines = erp["shipment_line"].join(open_ones, "shipment_nbr", "left_semi").select(
        "shipment_nbr", "line_nbr", "inventory_id", "shipped_qty"
    )
    packed = enrich(
        erp["package_split"].withColumnRenamed("shipment_line_nbr", "line_nbr"),
        [Lookup(erp["package"], {"shipment_nbr": "shipment_nbr", "package_line_nbr": "line_nbr"}, {"tracking": "track_number"})],
    ).select("shipment_nbr", "line_nbr", "inventory_id", "packed_qty", "tracking")
    return aggregates.ready_to_confirm(
        lines, packed, "shipment_nbr", ["line_nbr", "inventory_id"], "shipped_qty", "packed_qty", "tracking"
    )


# -- sending to warehouses -------------------------------------------------


def returns(erp: Erp, site_code: str, order_type: str = "RC") -> DataFrame:
    """Open return orders at one warehouse with ship-to data and sent flag."""
    open_ones = erp["order_header"].where((F.col("status") == "N") & (F.col("order_type") == order_type))
    take = ("customer_id", "ship_contact_id", "ship_address_id", "note_id", "order_date", "ship_via", "customer_order_nbr", "status")
    wide = enrich(
        erp["order_line"].select("order_type", "order_nbr", "line_nbr", "inventory_id", "site_id", "order_qty", "orig_order_type", "orig_order_nbr"),
        [
            Lookup(open_ones, ORDER, {c: c for c in take}, "inner"),
            contact(erp, "ship_contact_id", "s_", "inner"),
            address(erp, "ship_address_id", "s_", "inner"),
            account(erp, "customer_id"),
            item(erp),
            item_class(erp),
            Lookup(erp["site"].where(F.rtrim("site_cd") == site_code), {"site_id": "site_id"}, {}, "inner"),
        ],
    )
    wide = joins.attach_attributes(
        wide, erp["order_attributes"], {"note_id": "record_id"}, {"_sent": ("AttributeRCSHP2WH", "value_numeric")}
    )
    return joins.lookup_code(wide, erp["status_lookup"], "SOOrder", "status", "order_status")


def ship_to(fallback_email: str, width: int) -> list[Column]:
    """Ship-to block shared by the send extracts."""
    via = F.col("ship_via")
    return [
        via, ship_code(via).alias("ship_code"), F.lit(fixed.SHIP_PRIORITY).alias("ship_priority"),
        F.left("s_full_name", F.lit(width)).alias("ship_to_name"), F.left("acct_name", F.lit(width)).alias("company_name"),
        p.prefer(F.col("s_email"), F.lit(fallback_email)).alias("ship_to_email"),
        p.prefer(F.col("s_phone1"), F.col("s_phone2")).alias("ship_to_phone"),
        *[F.col(f"s_{c}").alias(f"ship_to_{c}") for c in ADDRESS],
    ]


def stock_location(descr: Column, class_descr: Column, code: Column, used_words: Sequence[str], new_items: Sequence[str]) -> Column:
    """Shelf of an item: used goods, parts, new goods, else null."""
    return p.first_match(
        [
            (p.contains_any(descr, used_words), "CPO"),
            (class_descr.ilike("%part%") | (class_descr == "Misc. Other"), "Parts"),
            (class_descr.ilike("%Product%") | F.rtrim(code).isin(*new_items), "NEW-RESTCK"),
        ]
    )


def returns_to_send(
    erp: Erp, site_code: str, fallback_email: str, excluded_orders: Sequence[str] = (), new_items: Sequence[str] = ("08568",)
) -> DataFrame:
    """Return lines not yet sent to the warehouse."""
    wide = returns(erp, site_code).where(p.null_or(F.col("_sent"), F.col("_sent") != 1))
    if excluded_orders:
        wide = wide.where(~F.col("order_nbr").isin(*excluded_orders))
    qty = numbers.whole(F.col("order_qty"))
    return wide.select(
        F.col("order_nbr").alias("rma_number"), "order_status",
        p.prefer(F.col("orig_order_nbr"), F.col("customer_order_nbr")).alias("original_order_nbr"),
        F.when(F.col("order_type") == "RC", "3").otherwise("W").alias("rma_type"),
        *ship_to(fallback_email, 25), "line_nbr", *trimmed("inventory_cd"), qty.alias("qty"), *trimmed("acct_cd"),
        "orig_order_type", "item_descr",
        stock_location(F.col("item_descr"), F.col("item_class_descr"), F.col("inventory_cd"), ["cpo"], new_items).alias("location"),
        "item_class_descr", F.col("_sent").cast("int").alias("sent_to_warehouse"), "order_type", "order_date",
    )


def returns_without_receipt(erp: Erp, site_code: str, fallback_email: str) -> DataFrame:
    """Return lines sent to the warehouse that no shipment line answers yet."""
    wide = returns(erp, site_code).where(F.col("_sent") == 1)
    received = erp["shipment_line"].select(
        F.col("orig_order_nbr").alias("order_nbr"), F.col("orig_line_nbr").alias("line_nbr"), "inventory_id"
    )
    left = joins.not_in_ledger(wide, received, ["order_nbr", "line_nbr", "inventory_id"], basis=erp["order_line"])
    return left.select(
        F.col("order_nbr").alias("return_nbr"), "line_nbr", "order_type", *trimmed("inventory_cd"),
        numbers.whole(F.col("order_qty")).alias("qty"), *trimmed("acct_cd"), "item_descr", "item_class_descr",
        F.col("_sent").cast("int").alias("sent_to_warehouse"), "order_date", "order_status",
        p.prefer(F.col("orig_order_nbr"), F.col("customer_order_nbr")).alias("original_order_nbr"), *ship_to(fallback_email, 25),
    )


def outgoing(erp: Erp, sites: DataFrame, names: Mapping[str, tuple[str, str]], return_type: str = "RC") -> DataFrame:
    """Unsent, unfinished shipment lines at the given warehouses."""
    waiting = erp["shipment"].where(~F.col("status").isin("C", "L", "F", "I"))
    take = ("status", "site_id", "customer_id", "ship_contact_id", "ship_address_id", "note_id", "ship_via")
    lines = erp["shipment_line"].where(F.col("orig_order_type") != return_type).select(
        "shipment_type", "shipment_nbr", "line_nbr", "orig_order_type", "orig_order_nbr", "inventory_id", "shipped_qty"
    )
    wide = enrich(
        lines,
        [
            Lookup(waiting, {"shipment_type": "shipment_type", "shipment_nbr": "shipment_nbr"}, {c: c for c in take}, "inner"),
            Lookup(sites, {"site_id": "site_id"}, {}, "inner"),
            contact(erp, "ship_contact_id", "s_", "inner"),
            address(erp, "ship_address_id", "s_", "inner"),
            account(erp, "customer_id"),
            item(erp),
            item_class(erp),
        ],
    )
    wide = joins.attach_attributes(
        wide, erp["shipment_attributes"], {"note_id": "record_id"}, {"_sent": ("AttributeSHP2WH", "value_numeric"), **names}
    ).where(F.col("_sent") == 0)
    return joins.lookup_code(wide, erp["status_lookup"], "SOShipment", "status", "ship_status")


def shipments_to_send(
    erp: Erp, site_code: str, fallback_email: str, new_items: Sequence[str] = ("08568",)
) -> DataFrame:
    """Lines for the first warehouse partner, with record type and shelf."""
    sites = erp["site"].where(F.rtrim("site_cd") == site_code)
    words = ["cpo", "pre own", "pre-own"]
    return outgoing(erp, sites, {}).select(
        F.col("shipment_nbr").alias("rma_number"), "ship_status", F.col("orig_order_nbr").alias("order_nbr"),
        F.when(F.col("orig_order_type") == "RC", "3").otherwise("W").alias("rma_type"), *ship_to(fallback_email, 35), "line_nbr",
        *trimmed("inventory_cd"), numbers.whole(F.col("shipped_qty")).alias("qty"), *trimmed("acct_cd"), "orig_order_type", "item_descr",
        stock_location(F.col("item_descr"), F.col("item_class_descr"), F.col("inventory_cd"), words, new_items).alias("location"),
        "item_class_descr", F.col("_sent").cast("int").alias("sent_to_warehouse"),
    )


def service_level(code: Column, via: Column, descr: Column, regulated: Sequence[str]) -> Column:
    """Service level asked of the second partner (fixed rule values)."""
    standard = via.isin("GROUND", "PSC150THRES", "WHITEGLOVE399", "WHITEGLOVE450", "WHITEGLOVE499")
    return p.first_match(
        [
            (F.rtrim(code).isin(*regulated), "cheapest_GROUND"),
            (standard & descr.ilike("%battery%"), "cheapest_UPS"),
            (standard, "cheapest_ALL"),
            (via == "2DAY", "cheapest_TWO_DAY"),
            (via == "LTL", "external_ltl"),
        ],
        "cheapest_ALL",
    )


def shipments_to_send_with_level(
    erp: Erp, site_prefix: str, fallback_email: str, regulated: Sequence[str]
) -> DataFrame:
    """Lines for the second warehouse partner, with partner order id and service level."""
    sites = erp["site"].where(F.upper("site_cd").startswith(site_prefix.upper()))
    return outgoing(erp, sites, {"partner_order_id": ("AttributeRSORDERID", "value_string")}).select(
        "shipment_nbr", "ship_status", F.col("_sent").cast("int").alias("sent_to_warehouse"), "partner_order_id",
        "orig_order_nbr", "orig_order_type", "line_nbr", numbers.whole(F.col("shipped_qty")).alias("qty"),
        *trimmed("inventory_cd"), "item_descr", "item_class_descr", *trimmed("acct_cd"), *ship_to(fallback_email, 35),
        service_level(F.col("inventory_cd"), F.col("ship_via"), F.col("item_descr"), regulated).alias("level"),
    )


def missing_links(
    erp: Erp, site_code: str, since: datetime, fields: Sequence[str] = ("AttributeLINK3PL", "AttributeRMAID"), company_id: int = 2
) -> DataFrame:
    """Shipments of a warehouse that lack an attribute, one row per missing name."""
    chosen = erp["site"].where(F.rtrim("site_cd") == site_code)
    recent = erp["shipment"].where(F.col("created_at") >= F.lit(since))
    shipments = enrich(
        erp["shipment_line"].select("shipment_nbr", "shipment_type", "site_id"),
        [
            Lookup(recent, {"shipment_nbr": "shipment_nbr", "shipment_type": "shipment_type"}, {"record_id": "note_id", "status": "status"}, "inner"),
            Lookup(chosen, {"site_id": "site_id"}, {}, "inner"),
        ],
    )
    shipments = joins.lookup_code(shipments, erp["status_lookup"], "SOShipment", "status", "_s", "inner").select("shipment_nbr", "record_id").distinct()
    names = {f"_v{i}": (name, "value_string") for i, name in enumerate(fields)}
    wide = joins.attach_attributes(shipments, erp["shipment_attributes"], {"record_id": "record_id"}, names)
    branches = {
        name: wide.where(p.null_or(F.col(f"_v{i}"), F.col(f"_v{i}") == "")).select("shipment_nbr", "record_id")
        for i, name in enumerate(fields)
    }
    return rows.with_constants(
        rows.union_tagged(branches, "field_name"),
        {"company_id": (company_id, "int"), "value_numeric": (None, "decimal(18,4)"), "value_date": (None, "timestamp_ntz"), "value_text": (None, "string")},
    )


# -- orders to the helpdesk ------------------------------------------------


def orders_with_lines(
    erp: Erp, headers: DataFrame, customer_link: str, order_link: str, answer: str, return_type: str = "RT"
) -> DataFrame:
    """Order headers with their lines as a JSON array, parties, links and salesperson."""
    wide = enrich(
        headers,
        [
            Lookup(erp["account"], {"customer_id": "account_id"},
                   {"acct_cd": "acct_cd", "acct_name": "acct_name", "_account_note": "note_id", "_since": "created_at"}, "inner"),
            Lookup(erp["customer"], {"customer_id": "account_id"}, {"customer_class": "class_id"}, "inner"),
            owner(erp),
            Lookup(erp["sales_person"], {"sales_person_id": "sales_person_id"}, {"_sp_cd": "sales_person_cd", "_sp": "descr"}),
            Lookup(erp["account_answers"], {"_account_note": "note_id"}, {"crm_link": "value"}, where=F.col("attribute_id") == answer),
            Lookup(erp["invoice"], {"order_nbr": "order_nbr", "order_type": "order_type"}, {"_ref": "ref_nbr"}),
            Lookup(erp["pay_link"], {"_ref": "ref_nbr"}, {"payment_link": "url"}),
            # contacts and addresses are the widest: after the others, so that few shuffles carry them
            address(erp, "bill_address_id", "billing_", "inner"),
            address(erp, "ship_address_id", "shipping_", "inner"),
            contact(erp, "bill_contact_id", "b_", "inner"),
            contact(erp, "ship_contact_id", "s_", "inner"),
        ],
    )
    wide = joins.lookup_code(wide, erp["status_lookup"], "SOOrder", "status", "order_status", "inner")
    line_rows = enrich(
        erp["order_line"].join(headers.select("order_nbr").distinct(), "order_nbr", "left_semi"), [item(erp)]
    ).select(
        "order_nbr", "line_nbr", *trimmed("inventory_cd", "item_descr"), numbers.whole(F.col("order_qty")).alias("qty")
    )
    docs = collect_parts(
        line_rows, ["order_nbr"], ["line_nbr", "inventory_cd", "qty", "item_descr"],
        F.struct("line_nbr", "inventory_cd", "item_descr", "qty"), "_lines", basis=erp["order_line"],
        cut_by=["line_nbr"],
    )
    wide = enrich(wide, [Lookup(docs, {"order_nbr": "order_nbr"}, {"_lines": "_lines", "piece": "piece", "part": "part"})])
    by_person = (F.col("order_type") == return_type) | F.col("_sp_cd").isNotNull()
    return wide.select(
        F.col("order_date").cast("date").alias("date"), "order_type", "order_nbr", "piece", "part",
        F.to_json("_lines").alias("line_items"), "order_status", "status", *trimmed("acct_cd", "acct_name"), "customer_class", "payment_link",
        *[c for c in wide.columns if c.startswith(("billing_", "shipping_"))],
        text.join_text("+1", F.col("b_phone1")).alias("billing_phone"), F.col("b_email").alias("billing_email"),
        text.join_text("+1", F.col("s_phone1")).alias("shipping_phone"), F.col("s_email").alias("shipping_email"),
        F.when(by_person, F.rtrim("_sp_cd")).otherwise(F.rtrim("owner_cd")).alias("sales_person_cd"),
        F.when(by_person, F.rtrim("_sp")).otherwise(F.col("owner_name")).alias("sales_person"),
        text.join_text(customer_link, F.rtrim("acct_cd")).alias("customer_link"),
        text.join_text(order_link, F.col("order_type"), "/", F.rtrim("order_nbr")).alias("order_link"),
        "crm_link", F.col("_since").cast("date").alias("customer_since"), "modified_at",
    )


def orders_to_send(
    erp: Erp, ledger: DataFrame, customer_link: str, order_link: str, answer: str,
    n: int, excluded: Sequence[str] = ("QT", "CM", "ZA"),
) -> DataFrame:
    """Newest ``n`` orders whose (order, status) the send ledger lacks.

    Orders that lack a party or a known status can't be sent and take no place
    among the ``n``.
    """
    headers = erp["order_header"].where(~F.col("order_type").isin(*excluded))
    unsent = joins.not_in_ledger(headers, ledger, ["order_nbr", "status"])
    needed = [
        ("account", "account_id", "customer_id"), ("customer", "account_id", "customer_id"), ("address", "address_id", "bill_address_id"),
        ("address", "address_id", "ship_address_id"), ("contact", "contact_id", "bill_contact_id"), ("contact", "contact_id", "ship_contact_id"),
    ]
    for table, key, own in needed:
        unsent = unsent.join(erp[table].select(F.col(key).alias(own)), own, "left_semi")
    known = erp["status_lookup"].where(F.col("tbl") == "SOOrder").select(F.col("code").alias("status"))
    chosen = rows.newest(unsent.join(known, "status", "left_semi"), n, [("modified_at", "desc"), "order_nbr"])
    return orders_with_lines(erp, chosen, customer_link, order_link, answer)


def orders_to_resend(
    erp: Erp, as_of: datetime, lookback: str, customer_link: str, order_link: str, answer: str,
    excluded: Sequence[str] = ("QT", "CM", "ZA"),
) -> DataFrame:
    """All recently changed orders, sent or not."""
    headers = erp["order_header"].where(
        ~F.col("order_type").isin(*excluded) & p.changed_since(F.col("modified_at"), as_of, lookback)
    )
    return orders_with_lines(erp, headers, customer_link, order_link, answer)


def addresses_to_validate(
    erp: Erp, order_type: str = "WB", status: str = "H", excluded: Sequence[str] = ("L", "C", "S")
) -> DataFrame:
    """Held orders whose ship-to address is not validated, with the bill-to one."""
    held = erp["order_header"].where(
        (F.col("order_type") == order_type) & (F.col("status") == status) & ~F.col("status").isin(*excluded)
    )
    wide = enrich(
        held,
        [
            address(erp, "ship_address_id", "s_", "inner", ("is_validated",)),
            Lookup(erp["contact"], {"ship_contact_id": "contact_id"}, {}, "inner"),
            address(erp, "bill_address_id", "b_", "inner"),
            Lookup(erp["contact"], {"bill_contact_id": "contact_id"}, {}, "inner"),
            account(erp, "customer_id"),
        ],
    ).where(p.null_or(F.col("s_is_validated"), ~F.col("s_is_validated")))
    wide = joins.lookup_code(wide, erp["status_lookup"], "SOOrder", "status", "order_status", "inner")
    pairs = [(F.col(f"s_{c}"), F.col(f"b_{c}")) for c in ADDRESS]
    shown = [
        (text.null_to_blank(F.col(f"{side}_{c}")) if c == "line2" else F.col(f"{side}_{c}")).alias(f"{side}_{c}")
        for side in ("s", "b")
        for c in ADDRESS
    ]
    return wide.select(
        "order_nbr", "order_type", *trimmed("acct_cd"), F.col("order_date").cast("date").alias("order_date"),
        F.col("s_is_validated").alias("is_validated"), "order_status", *shown, p.all_equal(pairs).alias("match"),
    )
