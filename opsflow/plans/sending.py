"""Send flows from the extract to what is sent: documents, XML texts, requests and ledger rows.

Transport is not here: what a partner answered is a landed table, and what is to be sent
is one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from opsflow.functions import predicates as p, text
from opsflow.operators import changes, longform
from opsflow.operators.skew import Order

LINE_ORDER = ["line_nbr", "inventory_cd"]
#: Head values of an order-create document and their columns in the extract.
RECEIVER = {
    "lastname": "ship_to_name", "street1": "ship_to_line1", "city": "ship_to_city", "region": "ship_to_state",
    "postcode": "ship_to_postal_code", "country": "ship_to_country", "telephone": "ship_to_phone", "unique_id": "shipment_nbr",
}


def partner_requests(lines: DataFrame, known: DataFrame) -> DataFrame:
    """``shipment_nbr, acct_cd, operation, note`` per shipment that has no partner order id.

    A shipment that the partner's landed lookup (``known``: ``shipment_nbr``) has is asked
    for again, all others are to be created.
    """
    waiting = lines.where(p.null_or(F.col("partner_order_id"), F.col("partner_order_id") == ""))
    shipments = waiting.groupBy("shipment_nbr").agg(F.min("acct_cd").alias("acct_cd"))
    found = shipments.join(known.select("shipment_nbr", F.lit(True).alias("_known")).distinct(), "shipment_nbr", "left")
    kind = F.when(F.col("_known"), "search").otherwise("create")
    return found.select(
        "shipment_nbr", "acct_cd", F.concat("shipment_nbr", F.lit(", order."), kind).alias("operation"),
        F.when(F.col("_known"), "Already at partner").alias("note"),
    )


def partner_orders(
    lines: DataFrame, known: DataFrame, order_by: Sequence[Order], default_level: str, reference_type: str, reference: str
) -> DataFrame:
    """Order-create documents, as nodes, of the shipments that are to be created."""
    wanted = partner_requests(lines, known).where("note IS NULL").select("shipment_nbr")
    rows = lines.join(wanted, "shipment_nbr", "left_semi").withColumnsRenamed(
        {"inventory_cd": "item", "orig_order_type": "order_type", reference: "customer_ref"}
    )
    names = {"inventory_cd": "item", "orig_order_type": "order_type", reference: "customer_ref"}
    order = [names.get(o, o) if isinstance(o, str) else o for o in order_by]
    return longform.order_create_nodes(rows, order, default_level, reference_type, RECEIVER)


def return_xml(lines: DataFrame, order_by: Sequence[Order], reference: str) -> DataFrame:
    """XML texts of returns or shipments for the first partner, as chunks per ``rma_number``.

    Names are cut to 25 characters; a missing contact is the company.
    """
    company = text.markup_text(F.col("company_name"), 25)
    contact = F.coalesce(text.markup_text(text.blank_to_null(F.col("ship_to_name")), 25), company)
    field = lambda name: text.markup_text(F.col(f"ship_to_{name}"))
    head = {
        "RMANumber": F.col("rma_number"), "RMATypeName": F.col("rma_type"), "ShipMethod": text.markup_text(F.col("ship_via")),
        "CustomerRef": text.markup_text(F.col(reference)),
        "Customer": {
            "ShipTo": {
                "CompanyName": company, "Contact": contact, "ContactEmail": field("email"), "Address1": field("line1"),
                "Address2": field("line2"), "City": field("city"), "State": field("state"), "Zip": field("postal_code"),
                "Phone": field("phone"), "Country": field("country"),
            }
        },
    }
    line = {
        "RMALineNumber": F.col("line_nbr"), "ItemNumber": text.markup_text(F.col("inventory_cd")), "Quantity": F.col("qty"),
        "Location": F.col("location"), "Description": text.markup_text(F.col("item_descr")),
    }
    return longform.xml_chunks(lines, "rma_number", order_by, head, line, "NewRMA", "RMALine")


def address_changes(wide: DataFrame, validated: DataFrame) -> DataFrame:
    """``order_nbr, side, field, old, new``: what validation changed in ship-to and bill-to addresses.

    ``validated``: landed replies ``order_nbr, s_<field>, b_<field>``; a null reply value
    leaves the old one. With ``match`` the bill-to address follows the ship-to one.
    """
    fields = [c.removeprefix("s_") for c in wide.columns if c.startswith("s_") and c in validated.columns]
    new = validated.select("order_nbr", *[F.col(f"{side}_{f}").alias(f"_new_{side}_{f}") for side in "sb" for f in fields])
    joined = wide.join(new, "order_nbr")
    parts = []
    for side, name in (("s", "ship_to"), ("b", "bill_to")):
        reply = {f: F.col(f"_new_{side}_{f}") for f in fields}
        if side == "b":
            reply = {f: F.when(F.col("match") == 1, F.col(f"_new_s_{f}")).otherwise(c) for f, c in reply.items()}
        pairs = {f: (F.col(f"{side}_{f}"), F.coalesce(c, F.col(f"{side}_{f}"))) for f, c in reply.items()}
        found = changes.field_changes(joined, pairs)
        parts.append(found.select("order_nbr", F.lit(name).alias("side"), "field", "old", "new"))
    return parts[0].unionByName(parts[1])


def unsent_documents(nodes: DataFrame, keys: Sequence[str], ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of the documents to send, whole, and the ledger rows to write once they are sent."""
    due = longform.changed_documents(nodes, keys, ledger)
    return nodes.join(due.select(*keys), list(keys), "left_semi"), due


def sent_rows(due: DataFrame, replies: DataFrame, keys: Sequence[str], at: Column) -> DataFrame:
    """Ledger rows of the documents that a landed reply (``keys, ok``) confirms."""
    confirmed = replies.where("ok").select(*keys).distinct()
    return due.join(confirmed, list(keys), "left_semi").withColumn("sent_at", at)
