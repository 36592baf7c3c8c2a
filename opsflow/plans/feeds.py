"""Datasets from landed partner feeds: returns, stock, campaigns, tracking, CRM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opsflow import sources
from opsflow.functions import dates, fixed, nested as nf, predicates as p, text
from opsflow.operators import aggregates, changes, joins, nested, rows, windows
from opsflow.operators.joins import Lookup, enrich


# -- warehouse partner reports ---------------------------------------------


def receipts(reports: DataFrame) -> DataFrame:
    return reports.select(
        F.col("rmaNumber").alias("rma_number"), dates.parse_utc(F.col("receiptDate")).alias("receipt_date"),
        F.col("receiptId").alias("receipt_id"), F.col("rmaId").alias("rma_id"), F.col("rmaLineId").alias("rma_line_id"),
        F.col("quantity").alias("qty"), F.col("itemNumber").alias("inventory_cd"), "location",
        F.col("itemType").alias("item_type"), F.col("category").alias("item_category"), F.col("description").alias("descr"), "price", "cost",
    )


def closed_shipments(reports: DataFrame) -> DataFrame:
    """Shipment reports as one row per shipped line."""
    return nested.flatten_lines(
        reports,
        "shipLines",
        {
            "rma_number": F.col("rmaNumber"), "rma_id": F.col("rmaId"), "rma_type": F.col("rmaType"),
            "created_at": dates.parse_utc(F.col("createDate")), "ship_date": dates.parse_utc(F.col("shipDate")),
            "carrier": F.col("carrier"), "carrier_code": F.col("carrierCode"), "tracking": F.col("trackingNum"),
            "priority": F.col("priority"), "freight_cost": F.col("freightCost"),
            "outbound_ship_method": F.col("outboundShipMethod"),
        },
        {
            "rma_line_id": "rmaLineId", "inventory_cd": "itemNum", "qty_shipped": "qtyShipped", "qty_to_ship": "qtytoShip",
            "location": "location", "item_category": "category", "descr": "model",
        },
    )


def return_statuses(reports: DataFrame, checked_at: Column) -> DataFrame:
    """Return reports as one row per line; W and 3 read different line fields."""
    return nested.flatten_variant(
        reports,
        "rmaLines",
        "rmaTypeName",
        {
            "rma_number": F.col("rmaNumber"), "rma_id": F.col("rmaId"), "rma_type": F.col("rmaTypeName"),
            "rma_status": F.col("rmaStatus"), "customer_ref": F.col("customerRef"), "rma_type_name": F.col("rmaTypeDescription"),
            "created_at": dates.parse_utc(F.col("rmaCreateDate")), "modified_at": dates.parse_utc(F.col("rmaLastModifiedDate")),
            "last_checked": checked_at,
        },
        {"rma_line_id": "rmaLineID", "rma_line_nbr": "rmaLineNumber"},
        {
            "line_status": {"W": "rpStatus", "3": "dfStatus"},
            "inventory_cd": {"W": "rpItem", "3": "dfItem"},
            "qty": {"W": "rpQuantityExp", "3": "dfQuantityExp"},
            "descr": {"3": "dfModelNum"},
        },
        {"carrier": ("W", F.col("inboundShipCarrier")), "priority": ("W", F.col("inboundShipPriority"))},
    )


QUANTITIES = (
    "expected", "processed", "putaway", "available", "allocated", "reserved", "picked", "advertised", "on_hand",
)


def inventory_levels(reports: DataFrame, warehouses: Mapping[str, str], at: Column) -> tuple[DataFrame, DataFrame]:
    """Stock per item and per item and warehouse."""
    summary, detail = nested.inventory_levels(
        reports, "sku", {q: f"qty_{q}" for q in QUANTITIES}, "detailed", "warehouse_id", warehouses
    )
    return summary.withColumn("ts", at), detail.withColumn("ts", at)


# -- campaigns -------------------------------------------------------------

# Known spellings of the report headers (fixed values).
CAMPAIGN_HEADERS = {
    "report_date": ["Day", "day", "date"],
    "campaign_raw": ["campaign", "Campaign", "campaignname", "campaign_name"],
    "campaign_id_raw": ["campaignid", "CampaignId"],
    "clicks": ["clicks", "Clicks"],
    "impressions": ["displays", "Displays"],
    "cost": ["advertisercost", "AdvertiserCost", "cost", "Cost"],
    "conversions": ["SalesAllPc30d", "salesallpc30d", "sales", "Sales"],
    "revenue": ["revenuegeneratedallpc30d", "RevenueGeneratedAllPc30d", "revenue", "Revenue"],
}
CAMPAIGN_METRICS = ["impressions", "clicks", "cost", "conversions", "revenue"]


def campaign_performance(report: DataFrame, advertiser_id: int, loaded_at: Column) -> DataFrame:
    """Cleaned campaign rows. Without an id column the id in the name is used."""
    required = ["report_date", "campaign_raw", *CAMPAIGN_METRICS]
    named = sources.drop_rollups(sources.canonicalize(report, CAMPAIGN_HEADERS, required), "report_date")
    cast = sources.safe_cast(
        named,
        {"clicks": ("bigint", 0, None), "impressions": ("bigint", 0, None), "conversions": ("bigint", 0, None),
         "cost": ("double", 0.0, 4), "revenue": ("double", 0.0, 4)},
    )
    raw = F.col("campaign_raw")
    campaign_id = F.col("campaign_id_raw").cast("bigint") if "campaign_id_raw" in cast.columns else text.trailing_id(raw)
    return cast.select(
        F.trim("report_date").cast("date").alias("report_date"), F.lit(advertiser_id).alias("advertiser_id"),
        campaign_id.alias("campaign_id"), text.strip_trailing_id(raw).alias("campaign_name"),
        "impressions", "clicks", "cost", "conversions", "revenue", loaded_at.alias("load_ts"),
    )


def campaign_diff(stored: DataFrame, loaded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Diff log and rows to upsert for campaign days. Stored decimals compare as doubles."""
    comparable = {c: F.col(c).cast("double") for c in ("cost", "revenue")}
    return changes.metric_diff(
        stored.withColumns(comparable), loaded.withColumns(comparable), ["report_date", "campaign_id"], CAMPAIGN_METRICS, "load_ts"
    )


def sales_by_campaign(sales: DataFrame, since: date, until: date) -> DataFrame:
    """Gross and net sales per order, sources and day with sales, canceled orders left out."""
    day = F.col("day").cast("date")
    return (
        sales.where(~F.col("is_canceled_order") & day.between(F.lit(since), F.lit(until)))
        .groupBy("order_name", "order_utm_source", "utm_source", day.alias("day"))
        .agg(F.sum("gross_sales").alias("gross_sales"), F.sum("net_sales").alias("net_sales"))
        .where("gross_sales <> 0")
        .orderBy("day", "order_name")
    )


# -- orders to the helpdesk ------------------------------------------------


def order_documents(orders: DataFrame, detail: DataFrame, ledger: DataFrame, part_rows: int = nested.PART_ROWS) -> DataFrame:
    """Order documents with nested lines, shipments and packages that were never
    sent in this state, or changed since. Adds ``payload``, its JSON text."""
    named = orders.withColumns(
        {
            "billing_state_name": nf.lookup(F.col("billing_state"), fixed.US_STATES),
            "billing_country_name": text.country_name(F.col("billing_country")),
        }
    )
    key = [c for c in named.columns if c not in ("line_items", "piece", "part")]
    deal = windows.dealer(["order_nbr"], detail)
    docs = nested.nest_orders(named.select(*key).distinct(), detail, part_rows, deal=deal)
    payload = F.to_json(F.struct(*[c for c in docs.columns if c not in ("piece", "part")]))
    return changes.changed_payloads(
        docs.withColumn("payload", payload).withColumn("decoded_status", F.col("order_status")),
        ledger, ["order_nbr", "decoded_status", "piece", "part"], "payload", hot=None, deal=deal,
    )


# -- parcel tracker --------------------------------------------------------


def new_trackings(shipments: DataFrame, log: DataFrame, old_records: DataFrame) -> DataFrame:
    """Tracking documents of shipments that neither ledger knows."""
    fresh = joins.not_in_ledgers(
        shipments, [(log, ["shipment_nbr", "order_nbr", "tracking"]), (old_records, ["order_nbr", "tracking"])]
    )
    return nested.tracking_documents(fresh, fixed.US_STATES)


def tracking_updates(records: DataFrame, shipments: DataFrame) -> DataFrame:
    """Changed customer and tag blocks of tracked parcels.

    ``records``: ``id, tracking_number, order_number, customers, shipment_tags``
    in the types of the tracking documents.
    """
    wanted = nested.tracking_documents(shipments, fixed.US_STATES).select(
        "tracking_number", "order_number", F.col("order_id").alias("shipment_nbr"), "customers", "shipment_tags"
    )
    blocks = changes.changed_blocks(
        records, wanted, ["tracking_number", "order_number"], ["customers", "shipment_tags"]
    )
    return enrich(
        blocks,
        [
            Lookup(records, {"tracking_number": "tracking_number", "order_number": "order_number"}, {"id": "id"}, "inner"),
            Lookup(wanted, {"tracking_number": "tracking_number", "order_number": "order_number"}, {"shipment_nbr": "shipment_nbr"}, "inner"),
        ],
    )


def tracking_export(records: DataFrame, zone: str = "America/New_York") -> tuple[DataFrame, DataFrame]:
    return nested.tracking_export(records, zone)


# -- CRM -------------------------------------------------------------------


def open_deals(deals: DataFrame, pipeline: str, closed: Sequence[str], two_years_ago: datetime, year_start: datetime) -> DataFrame:
    """Open deals of two years and closed deals of this year, each once."""
    own = {"column": "pipeline", "operator": "EQ", "value": pipeline}
    groups = [
        [own, {"column": "created_at", "operator": "GTE", "value": F.lit(two_years_ago)},
         {"column": "deal_stage", "operator": "NOT_IN", "values": closed}],
        [own, {"column": "created_at", "operator": "GTE", "value": F.lit(year_start)},
         {"column": "deal_stage", "operator": "IN", "values": closed}],
    ]
    return deals.where(p.filter_groups(groups)).dropDuplicates(["id"])


# Property of each deal column; pass another map where a CRM names them otherwise.
DEAL_PROPERTIES = {
    "deal_name": "dealname", "stage": "dealstage", "deal_type": "dealtype", "product": "product", "lead_source": "lead_source",
    "order_number": "order_number", "is_stalled": "deal_is_stalled", "closed_lost_reason": "closed_lost_reason",
    "primary_competitor": "primary_competitor", "_owner": "owner_id", "amount": "amount", "created_at": "createdate",
    "closed_at": "closedate", "last_activity_at": "notes_last_updated",
}


def deal_snapshot(
    deals: DataFrame, owners: DataFrame, teams: DataFrame, stages: DataFrame, as_of: datetime,
    won: str = "Closed/Won", properties: Mapping[str, str] = DEAL_PROPERTIES,
) -> DataFrame:
    """Deals (``id, properties map``) as typed snapshot rows with rep, team and ages."""
    names = dict(properties)
    spec = {out: (name, None) for out, name in names.items()}
    spec["amount"] = (names["amount"], F.col("_p_amount").try_cast("double"))
    for out in ("created_at", "closed_at", "last_activity_at"):
        spec[out] = (names[out], dates.parse_first(F.col(f"_p_{out}")))
    flat = nested.flatten_properties(deals, "properties", spec)
    wide = enrich(
        flat,
        [
            Lookup(owners, {"_owner": "owner_id"}, {"_rep": "rep_name"}),
            Lookup(teams, {"_rep": "rep_name"}, {"_team": "team"}),
            Lookup(stages, {"stage": "stage_id"}, {"_label": "label"}),
        ],
    )
    unknown = F.when(F.col("_rep").isNull(), "no matching owner").otherwise("unknown")
    return wide.select(
        F.lit(as_of).alias("snapshot_at"), F.col("id").alias("deal_id"), "deal_name", "stage", "deal_type",
        F.coalesce("_rep", F.lit("no matching owner")).alias("rep_name"), F.coalesce("_team", unknown).alias("team"),
        "product", "amount", "lead_source", "order_number",
        F.when(F.col("_label") == won, 1).otherwise(0).alias("is_true_won"), "is_stalled",
        "created_at", "closed_at", "last_activity_at",
        dates.age_days(F.col("created_at"), as_of).alias("days_in_pipeline"),
        dates.age_days(F.col("last_activity_at"), as_of).alias("days_since_activity"),
        "closed_lost_reason", "primary_competitor",
    )


def activity_snapshot(
    activities: Mapping[str, DataFrame], owners: DataFrame, teams: DataFrame, as_of: datetime,
    time_property: str = "timestamp", owner_property: str = "owner_id",
) -> DataFrame:
    """Activity counts per rep and to-date window, one column per kind.

    Each activity frame has a ``properties`` struct or map with time and owner.
    Known reps (those with a team) always appear.
    """
    counts = {}
    for kind, frame in activities.items():
        timed = frame.select(
            dates.parse_first(F.col("properties")[time_property]).alias("ts"), F.col("properties")[owner_property].alias("_owner")
        )
        named = enrich(timed, [Lookup(owners, {"_owner": "owner_id"}, {"rep_name": "rep_name"}, "inner")])
        counts[f"{kind}_count"] = aggregates.todate_counts(named, "rep_name", "ts", as_of, teams)
    wide = aggregates.merge_activity_counts(counts, teams.select(F.col("rep_name").alias("rep"), "team"))
    return wide.withColumnRenamed("rep", "rep_name").withColumns(
        {"new_contact_count": F.lit(0), "snapshot_at": F.lit(as_of)}
    )


# Fields of a property definition and their column names (fixed values).
PROPERTY_FIELDS = {
    "name": "name", "label": "label", "groupName": "group_name", "description": "description", "type": "type",
    "fieldType": "field_type", "createdUserId": "created_user_id", "updatedUserId": "updated_user_id",
    "displayOrder": "display_order", "calculated": "calculated", "archived": "archived", "hidden": "hidden",
    "vendorDefined": "vendor_defined", "createdAt": "created_at", "updatedAt": "updated_at",
}


def property_catalogue(by_object: Mapping[str, DataFrame]) -> DataFrame:
    """Property definitions of all object types in one table; absent fields are null."""

    def fields(df: DataFrame) -> list[Column]:
        return [
            (F.col(field) if field in df.columns else F.lit(None).cast("string")).alias(out)
            for field, out in PROPERTY_FIELDS.items()
        ]

    return rows.concat_rows(
        *[df.select(F.lit(kind).alias("object_type"), *fields(df)) for kind, df in by_object.items()]
    )


def load_campaigns(spark: SparkSession, path: str, advertiser_id: int, loaded_at: Column) -> DataFrame:
    return campaign_performance(sources.scan_report(spark, path), advertiser_id, loaded_at)
