"""Contracts of the target tables (fixed values: names, types, keys).

Every column that is neither key nor insert-only is updated on a repeated key.
"""

from __future__ import annotations

from opsflow.operators.tables import TableSpec

_SPECS = (
    TableSpec(
        "receipts",
        "rma_number STRING, receipt_date TIMESTAMP_NTZ, receipt_id INT, rma_id INT, rma_line_id INT, qty INT, inventory_cd STRING, "
        "location STRING, item_type STRING, item_category STRING, descr STRING, price DECIMAL(18,2), cost DECIMAL(18,2)",
        ("rma_number", "receipt_id", "rma_id", "rma_line_id"),
    ),
    TableSpec(
        "closed_shipments",
        "rma_number STRING, rma_id INT, rma_line_id INT, rma_type STRING, created_at TIMESTAMP_NTZ, ship_date TIMESTAMP_NTZ, "
        "inventory_cd STRING, qty_shipped INT, qty_to_ship INT, location STRING, item_category STRING, descr STRING, carrier STRING, "
        "carrier_code STRING, priority STRING, tracking STRING, freight_cost DECIMAL(18,2), outbound_ship_method STRING",
        ("rma_number", "rma_id", "rma_line_id", "rma_type"),
    ),
    TableSpec(
        "return_status",
        "rma_number STRING, rma_id INT, rma_line_id INT, rma_type STRING, rma_status STRING, customer_ref STRING, rma_line_nbr INT, "
        "line_status STRING, inventory_cd STRING, qty INT, descr STRING, rma_type_name STRING, created_at TIMESTAMP_NTZ, "
        "modified_at TIMESTAMP_NTZ, last_checked TIMESTAMP_NTZ, carrier STRING, priority STRING",
        ("rma_number", "rma_id", "rma_line_id", "rma_type"),
    ),
    TableSpec(
        "inventory_summary",
        "item STRING, expected INT, processed INT, putaway INT, available INT, allocated INT, reserved INT, picked INT, advertised INT, "
        "on_hand INT, ts TIMESTAMP_NTZ",
        ("item",),
    ),
    TableSpec(
        "inventory_detail",
        "item STRING, warehouse STRING, expected INT, processed INT, putaway INT, available INT, allocated INT, reserved INT, picked INT, "
        "advertised INT, on_hand INT, ts TIMESTAMP_NTZ",
        ("item", "warehouse"),
    ),
    TableSpec(
        "api_log",
        "entity STRING, key_value STRING, operation STRING, payload STRING, response STRING, ts TIMESTAMP_NTZ",
        ("entity", "key_value", "operation", "ts"),
    ),
    TableSpec(
        "order_deletions",
        "order_type STRING, order_nbr STRING, deleted_by STRING, deleted_at TIMESTAMP_NTZ",
        ("order_type", "order_nbr"),
    ),
    TableSpec(
        "line_deletions",
        "order_type STRING, order_nbr STRING, line_nbr INT, order_date DATE, deleted_at TIMESTAMP_NTZ, deleted_by STRING, inventory_id INT, "
        "sub_item_id INT, site_id INT, location_id INT, order_qty INT, shipped_qty INT, unit_price DECIMAL(18,2), unit_cost DECIMAL(18,2), "
        "ext_price DECIMAL(18,2), ext_cost DECIMAL(18,2), disc_pct DECIMAL(18,2), disc_amt DECIMAL(18,2), manual_disc BOOLEAN, "
        "reason_code STRING, open_qty INT, open_amt DECIMAL(18,2), line_amt DECIMAL(18,2), completed BOOLEAN, orig_order_type STRING, "
        "orig_order_nbr STRING, orig_line_nbr INT, orig_shipment_type STRING, open_line BOOLEAN, billed_qty INT, unbilled_qty INT, "
        "unbilled_amt DECIMAL(18,2), ship_date DATE, cancel_date DATE, billed_amt DECIMAL(18,2), discount_id STRING, "
        "discount_sequence_id STRING, invoice_type STRING, invoice_nbr STRING, invoice_line_nbr INT, invoice_date DATE, is_free BOOLEAN, "
        "po_create BOOLEAN, po_created BOOLEAN, po_source STRING, po_site_id INT, qty_on_orders INT, customer_order_nbr STRING, "
        "po_create_date DATE, is_stock_item BOOLEAN, net_sales DECIMAL(18,2), margin_amt DECIMAL(18,2), margin_pct DECIMAL(19,2), "
        "created_at TIMESTAMP_NTZ, created_by STRING",
        ("order_type", "order_nbr", "line_nbr"),
    ),
    TableSpec(
        "shipment_deletions", "shipment_nbr STRING, ship_date DATE, deleted_by STRING, deleted_at TIMESTAMP_NTZ", ("shipment_nbr",)
    ),
    TableSpec(
        "order_shipment_deletions",
        "order_type STRING, order_nbr STRING, shipment_nbr STRING, ship_date DATE, deleted_by STRING, deleted_at TIMESTAMP_NTZ",
        ("order_type", "order_nbr", "shipment_nbr"),
    ),
    TableSpec(
        "ad_details",
        "ad_code STRING, ad_version_id STRING, primary_ad_name STRING, secondary_ad_name STRING, category STRING, start_date DATE, "
        "created_at TIMESTAMP_NTZ, created_by STRING, modified_by STRING",
        ("ad_code",),
    ),
    TableSpec(
        "campaign_daily",
        "report_date DATE, advertiser_id INT, campaign_id BIGINT, campaign_name STRING, impressions INT, clicks INT, cost DECIMAL(10,4), "
        "conversions INT, revenue DECIMAL(12,4), load_ts TIMESTAMP_NTZ",
        ("report_date", "campaign_id"),
    ),
    TableSpec(
        "campaign_diff_log",
        "report_date DATE, campaign_id BIGINT, last_ts TIMESTAMP_NTZ, current_ts TIMESTAMP_NTZ, impressions_current INT, "
        "impressions_last INT, clicks_current INT, clicks_last INT, cost_current DECIMAL(18,4), cost_last DECIMAL(18,4), "
        "revenue_current DECIMAL(18,4), revenue_last DECIMAL(18,4), diff BOOLEAN",
        ("report_date", "campaign_id", "last_ts"),
    ),
    TableSpec(
        "quotes",
        "order_type STRING, quote_nbr STRING, line_nbr INT, date_placed DATE, acct_cd STRING, acct_name STRING, customer_class STRING, "
        "inventory_cd STRING, item_descr STRING, quantity INT, line_price DECIMAL(18,2), order_total DECIMAL(18,2), order_status STRING, "
        "customer_order_nbr STRING, owner_cd STRING, owner_name STRING, owner_email STRING, sales_person_cd STRING, discount_id STRING, "
        "disc_amt DECIMAL(18,2), line_cost DECIMAL(18,2), phone STRING, email STRING, address_line1 STRING, address_line2 STRING, "
        "city STRING, state STRING, zip STRING, country STRING, line_amount DECIMAL(18,2), replenishment_class STRING, is_stock BOOLEAN, line_warehouse STRING, "
        "modified_at TIMESTAMP_NTZ, created_at TIMESTAMP_NTZ, attached_order_type STRING, attached_order_nbr STRING, "
        "last_checked TIMESTAMP_NTZ",
        ("order_type", "quote_nbr", "line_nbr"),
    ),
    TableSpec(
        "sales_orders",
        "order_type STRING, order_nbr STRING, line_nbr INT, date_placed DATE, acct_cd STRING, acct_name STRING, customer_class STRING, "
        "inventory_cd STRING, item_descr STRING, quantity INT, line_price DECIMAL(18,2), order_total DECIMAL(18,2), order_status STRING, "
        "customer_order_nbr STRING, owner_cd STRING, owner_name STRING, owner_email STRING, sales_person_cd STRING, "
        "modified_at TIMESTAMP_NTZ, discount_id STRING, disc_amt DECIMAL(18,2), line_cost DECIMAL(18,2), phone STRING, email STRING, "
        "address_line1 STRING, address_line2 STRING, city STRING, state STRING, zip STRING, country STRING, line_amount DECIMAL(18,2), "
        "replenishment_class STRING, is_stock BOOLEAN, line_warehouse STRING, ship_date TIMESTAMP_NTZ, shipment_nbr STRING, "
        "ship_status STRING, ship_warehouse STRING, completed BOOLEAN, original_order_type STRING, original_order_nbr STRING, "
        "freight_price DECIMAL(18,2), premium_freight_price DECIMAL(18,2), freight_total DECIMAL(18,2), created_at TIMESTAMP_NTZ, created_by STRING, modified_by STRING, last_checked TIMESTAMP_NTZ",
        ("order_type", "order_nbr", "line_nbr"),
        insert_only=("disc_amt", "line_cost"),
    ),
    TableSpec(
        "order_ledger",
        "order_nbr STRING, payload STRING, decoded_status STRING, sent_at TIMESTAMP_NTZ, response STRING, status STRING, "
        "last_checked TIMESTAMP_NTZ",
        ("order_nbr", "status"),
        insert_only=("decoded_status",),
    ),
    TableSpec(
        "shipments",
        "shipment_nbr STRING, ship_line_nbr INT, status STRING, order_nbr STRING, order_line_nbr INT, order_date DATE, inventory_cd STRING, "
        "order_qty INT, ship_qty INT, ship_date DATE, customer_id STRING, account_name STRING, email STRING, address_line1 STRING, "
        "address_line2 STRING, city STRING, state STRING, country STRING, zip STRING, warehouse STRING, package_count INT, "
        "line_price DECIMAL(18,2), freight_cost DECIMAL(18,2), sent_to_warehouse INT, inserted_at TIMESTAMP_NTZ, modified_at TIMESTAMP_NTZ, "
        "tracking STRING, tracking_created DATE, phone STRING, attention STRING, ship_via STRING, carrier STRING, courier_code STRING, "
        "courier_name STRING, confirmed_at TIMESTAMP_NTZ, created_at TIMESTAMP_NTZ",
        ("shipment_nbr", "ship_line_nbr", "order_nbr", "order_line_nbr"),
    ),
    TableSpec(
        "tracking_log",
        "shipment_nbr STRING, order_nbr STRING, tracking STRING, response_code STRING, message STRING, id STRING, ts TIMESTAMP_NTZ",
        ("shipment_nbr", "order_nbr", "tracking"),
    ),
    TableSpec(
        "deal_snapshots",
        "snapshot_at TIMESTAMP_NTZ, deal_id STRING, deal_name STRING, stage STRING, deal_type STRING, rep_name STRING, team STRING, "
        "product STRING, amount DECIMAL(18,2), lead_source STRING, order_number STRING, is_true_won INT, is_stalled STRING, "
        "created_at TIMESTAMP_NTZ, closed_at TIMESTAMP_NTZ, last_activity_at TIMESTAMP_NTZ, days_in_pipeline INT, days_since_activity INT, "
        "closed_lost_reason STRING, primary_competitor STRING",
        ("snapshot_at", "deal_id", "stage", "rep_name"),
    ),
    TableSpec(
        "activity_snapshots",
        "rep_name STRING, team STRING, window STRING, call_count BIGINT, email_count BIGINT, meeting_count BIGINT, task_count BIGINT, "
        "new_contact_count BIGINT, window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, snapshot_at TIMESTAMP_NTZ",
        ("rep_name", "window", "window_start", "window_end"),
    ),
    TableSpec(
        "shipment_attributes",
        "company_id INT, record_id STRING, field_name STRING, value_numeric DECIMAL(18,4), value_date TIMESTAMP_NTZ, value_string STRING, "
        "value_text STRING",
        ("company_id", "record_id", "field_name"),
    ),
    TableSpec(
        "tracking_export",
        "order_nbr STRING, tracking STRING, phone STRING, product STRING, shipment_type STRING, weight DECIMAL(18,1), link STRING, "
        "dest_line1 STRING, dest_city STRING, dest_state STRING, dest_zip STRING, tag STRING, subtag STRING, subtag_message STRING, "
        "created TIMESTAMP_NTZ, last_update TIMESTAMP_NTZ, id STRING, shipment_nbr STRING",
        ("order_nbr", "tracking"),
    ),
    TableSpec(
        "tracking_export_detail",
        "order_nbr STRING, tracking STRING, checkpoint_time TIMESTAMP_NTZ, created_at TIMESTAMP_NTZ, message STRING, tag STRING, "
        "subtag STRING, subtag_message STRING, city STRING, state STRING, zip STRING, slug STRING, raw_tag STRING, source STRING, id STRING, "
        "shipment_nbr STRING",
        ("order_nbr", "tracking", "checkpoint_time", "created_at"),
    ),
    TableSpec(
        "properties",
        "object_type STRING, name STRING, label STRING, group_name STRING, description STRING, type STRING, field_type STRING, "
        "created_user_id STRING, updated_user_id STRING, display_order INT, calculated BOOLEAN, archived BOOLEAN, hidden BOOLEAN, "
        "vendor_defined BOOLEAN, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ",
        ("object_type", "name"),
    ),
    TableSpec(
        "phone_revenue",
        "acct_cd STRING, name STRING, phone STRING, order_nbr STRING, line_nbr INT, order_date STRING, order_status STRING, "
        "inventory_cd STRING, item_descr STRING, line_amt DECIMAL(18,2), agent STRING",
        ("acct_cd", "order_nbr", "line_nbr"),
    ),
)

TABLES = {spec.name: spec for spec in _SPECS}
# the current state of deals has the columns of their history, keyed without time
TABLES["deal_tracking"] = TableSpec(
    "deal_tracking", TABLES["deal_snapshots"].ddl, ("deal_id", "stage", "rep_name")
)
