"""SQL twins of the order and shipment datasets, written by grain.

Facts of one header, line, item, party or shipment are gathered on their own; each
dataset then joins the facts it shows.
"""

from __future__ import annotations

import re

from opsflow.catalog.erp_tables import ERP, with_erp


def day(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d')"


def time(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"


def money(expression: str) -> str:
    return f"CAST(CAST({expression} AS DECIMAL(18,2)) AS DOUBLE)"


def whole(expression: str) -> str:
    return f"CAST(trunc({expression}) AS INT)"


#: Facts that several datasets share, each with the key that it is joined by.
FACTS = {
    "party": "SELECT account_id AS customer_id, rtrim(acct_cd) AS acct_cd, acct_name FROM erp_account",
    "class_of": "SELECT account_id AS customer_id, class_id AS customer_class FROM erp_customer",
    "agent": "SELECT contact_id AS owner_id, rtrim(acct_cd) AS owner_cd, acct_name AS owner_name FROM erp_account",
    "seller": """SELECT customer_id, rtrim(sales_person_cd) AS sales_person_cd
                 FROM erp_customer_sales_person LEFT JOIN erp_sales_person USING (sales_person_id)""",
    "store": "SELECT site_id, rtrim(site_cd) AS site_cd FROM erp_site",
    "goods": "SELECT inventory_id, rtrim(inventory_cd) AS inventory_cd, descr AS item_descr, item_class_id, CAST(is_stock AS INT) AS is_stock FROM erp_item",
    "kinds": "SELECT item_class_id, rtrim(item_class_cd) AS item_class_cd, descr AS item_class_descr FROM erp_item_class",
    "supply": "SELECT inventory_id, class_id AS replenishment_class FROM erp_item_replenishment",
    "order_state": "SELECT k.code AS status, k.status AS order_status FROM erp_status_lookup k WHERE tbl = 'SOOrder'",
    "ship_state": "SELECT k.code AS status, k.status AS ship_status FROM erp_status_lookup k WHERE tbl = 'SOShipment'",
    "recipient": """SELECT contact_id AS ship_contact_id, full_name, coalesce(email, 'x@y') AS ship_to_email,
                    coalesce(phone1, phone2) AS ship_to_phone FROM erp_contact""",
    "destination": """SELECT address_id AS ship_address_id, line1 AS ship_to_line1, line2 AS ship_to_line2, city AS ship_to_city,
                      state AS ship_to_state, postal_code AS ship_to_postal_code, country AS ship_to_country FROM erp_address""",
    "sent_flags": """SELECT record_id AS note_id, max(value_numeric) FILTER (WHERE field_name = 'AttributeSHP2WH') AS flag,
                     max(value_string) FILTER (WHERE field_name = 'AttributeRSORDERID') AS partner_order_id,
                     max(value_string) FILTER (WHERE field_name = 'AttributeCOURCODE') AS courier_code
                     FROM erp_shipment_attributes GROUP BY record_id""",
    "return_flags": """SELECT record_id AS note_id, max(value_numeric) AS flag FROM erp_order_attributes
                       WHERE field_name = 'AttributeRCSHP2WH' GROUP BY record_id""",
}


def twin(facts: list[str | tuple[str, str]], select: str) -> str:
    """``WITH`` the ERP tables that are read, the facts in order, then ``select``."""
    named = [(fact, FACTS[fact]) if isinstance(fact, str) else fact for fact in facts]
    body = ",\n".join(f"{name} AS ({text})" for name, text in named)
    used = [name for name in ERP if re.search(rf"\berp_{name}\b", body + select)]
    return f"{with_erp(*used)}, {body}\n{select}"


#: What a parcel's label says, from the facts ``recipient``, ``destination`` and ``party``.
def label(width: int) -> str:
    return f"""CASE coalesce(ship_via, 'GROUND') WHEN 'GROUND' THEN 'FDXG' WHEN '2DAY' THEN 'FED2' END AS ship_code, ship_via,
      'Fedex' AS ship_priority, left(full_name, {width}) AS ship_to_name, left(acct_name, {width}) AS company_name, ship_to_email, ship_to_phone,
      ship_to_line1, ship_to_line2, ship_to_city, ship_to_state, ship_to_postal_code, ship_to_country"""


def location(pre_owned: list[str]) -> str:
    """Shelf of an item: pre-owned by its name, else by its class."""
    named = " OR ".join(f"contains(lower(item_descr), '{word}')" for word in pre_owned)
    return f"""CASE WHEN {named} THEN 'CPO' WHEN contains(lower(item_class_descr), 'part') OR item_class_descr = 'Misc. Other' THEN 'Parts'
      WHEN contains(lower(item_class_descr), 'product') OR inventory_cd = '77' THEN 'NEW-RESTCK' END AS location"""


TWINS: dict[str, str] = {}

# one row per changed order; where it goes: shipping contact and address, else the billing ones
CHANGED = (
    "head",
    f"""SELECT order_type, order_nbr, customer_id, owner_id, status, {day('order_date')} AS date_placed, {money('order_total')} AS order_total,
      customer_order_nbr, {time('modified_at')} AS modified_at, {time('created_at')} AS created_at, {money('freight_amt')} AS freight_price,
      {money('premium_freight_amt')} AS premium_freight_price, {money('freight_total')} AS freight_total, created_by_id, modified_by_id,
      [ship_contact_id, bill_contact_id] AS contacts, [ship_address_id, bill_address_id] AS addresses
    FROM erp_order_header
    WHERE modified_at >= TIMESTAMP '2001-08-01' - INTERVAL 500 DAY AND NOT list_contains(['QT', 'RA', 'RC', 'RR', 'RM'], order_type)""",
)
REACHED = (
    "reached",
    """SELECT order_type, order_nbr, left(arg_min(phone1, turn), 20) AS phone, arg_min(email, turn) AS email
    FROM (SELECT order_type, order_nbr, unnest(contacts) AS contact_id, unnest([1, 2]) AS turn FROM head) JOIN erp_contact USING (contact_id)
    GROUP BY order_type, order_nbr""",
)
PLACED = (
    "placed",
    """SELECT order_type, order_nbr, arg_min(line1, turn) AS address_line1, nullif(arg_min(line2, turn), '') AS address_line2, arg_min(city, turn) AS city,
      arg_min(state, turn) AS state, arg_min(postal_code, turn) AS zip, arg_min(country, turn) AS country
    FROM (SELECT order_type, order_nbr, unnest(addresses) AS address_id, unnest([1, 2]) AS turn FROM head) JOIN erp_address USING (address_id)
    GROUP BY order_type, order_nbr""",
)
TWINS["sales_orders"] = twin(
    [
        CHANGED, REACHED, PLACED, "party", "class_of", "agent", "seller", "store", "goods", "supply", "order_state", "ship_state",
        ("person", r"SELECT user_id, replace(user_name, 'corp\', '') AS who FROM erp_users"),
        (
            "bought",
            f"""SELECT order_type, order_nbr, line_nbr, inventory_id, {whole('order_qty')} AS quantity, {money('line_amt + disc_amt')} AS line_price,
              rtrim(discount_id) AS discount_id, {money('disc_amt')} AS disc_amt, {money('ext_cost')} AS line_cost, {money('line_amt')} AS line_amount,
              CAST(completed AS INT) AS completed, orig_order_type AS original_order_type, orig_order_nbr AS original_order_nbr, site_cd AS line_warehouse
            FROM erp_order_line LEFT JOIN store USING (site_id)""",
        ),
        (
            "trip",
            f"""SELECT shipment_type, shipment_nbr, {time('ship_date')} AS ship_date, ship_status FROM erp_shipment LEFT JOIN ship_state USING (status)""",
        ),
        (
            "sent",
            """SELECT orig_order_type AS order_type, orig_order_nbr AS order_nbr, orig_line_nbr AS line_nbr, inventory_id, shipment_nbr, ship_date,
              ship_status, site_cd AS ship_warehouse
            FROM erp_shipment_line LEFT JOIN store USING (site_id) LEFT JOIN trip USING (shipment_type, shipment_nbr)""",
        ),
    ],
    """SELECT order_type, order_nbr, line_nbr, date_placed, acct_cd, acct_name, customer_class, inventory_cd, rtrim(item_descr) AS item_descr, quantity,
      line_price, order_total, order_status, customer_order_nbr, owner_cd, owner_name, mail.email AS owner_email, sales_person_cd, discount_id, modified_at,
      disc_amt, line_cost, phone, reached.email, address_line1, address_line2, city, state, zip, country, line_amount, replenishment_class, is_stock,
      line_warehouse, ship_date, shipment_nbr, ship_status, ship_warehouse, completed, original_order_type, original_order_nbr, freight_price,
      premium_freight_price, freight_total, created_at, maker.who AS created_by, changer.who AS modified_by
    FROM head JOIN order_state USING (status) JOIN party USING (customer_id) JOIN class_of USING (customer_id)
    LEFT JOIN reached USING (order_type, order_nbr) LEFT JOIN placed USING (order_type, order_nbr)
    LEFT JOIN agent USING (owner_id) LEFT JOIN erp_contact mail ON mail.contact_id = owner_id LEFT JOIN seller USING (customer_id)
    LEFT JOIN person maker ON maker.user_id = created_by_id LEFT JOIN person changer ON changer.user_id = modified_by_id
    JOIN bought USING (order_type, order_nbr) JOIN goods USING (inventory_id) LEFT JOIN supply USING (inventory_id)
    LEFT JOIN sent USING (order_type, order_nbr, line_nbr, inventory_id)""",
)

TWINS["quotes"] = twin(
    [
        "party", "class_of", "agent", "seller", "store", "goods", "supply", "order_state",
        (
            "head",
            f"""SELECT order_type, order_nbr, customer_id, owner_id, ship_contact_id, ship_address_id, {day('order_date')} AS date_placed,
              {money('order_total')} AS order_total, order_status, customer_order_nbr, {money('paid_amt')} AS total_paid,
              {time('modified_at')} AS modified_at, {time('created_at')} AS created_at
            FROM erp_order_header JOIN order_state USING (status)
            WHERE order_type = 'QT' AND CAST(modified_at AS DATE) >= CAST(TIMESTAMP '2001-08-01' - INTERVAL 900 DAY AS DATE)""",
        ),
        (
            "offered",
            f"""SELECT order_type, order_nbr, line_nbr, inventory_cd, rtrim(item_descr) AS item_descr, {whole('order_qty')} AS quantity,
              {money('line_amt')} AS line_price, discount_id, {money('disc_amt')} AS disc_amt, {money('ext_cost')} AS line_cost,
              {money('line_amt')} AS line_amount, replenishment_class, is_stock, site_cd AS line_warehouse
            FROM erp_order_line LEFT JOIN goods USING (inventory_id) LEFT JOIN supply USING (inventory_id) LEFT JOIN store USING (site_id)""",
        ),
        (
            "follow_up",
            """SELECT o.orig_order_type AS order_type, o.orig_order_nbr AS order_nbr, o.order_type AS attached_order_type, o.order_nbr AS attached_order_nbr
            FROM erp_order_header o WHERE o.orig_order_nbr IS NOT NULL""",
        ),
    ],
    """SELECT order_type, order_nbr AS quote_nbr, coalesce(line_nbr, 99) AS line_nbr, date_placed, acct_cd, acct_name, customer_class, inventory_cd,
      item_descr, quantity, line_price, order_total, order_status, customer_order_nbr, owner_cd, owner_name, CAST(NULL AS VARCHAR) AS owner_email,
      sales_person_cd, discount_id, disc_amt, line_cost, total_paid, phone1 AS phone, email, line1 AS address_line1, nullif(line2, '') AS address_line2,
      city, state, postal_code AS zip, country, line_amount, replenishment_class, is_stock, line_warehouse, modified_at, created_at, attached_order_type,
      attached_order_nbr
    FROM head JOIN party USING (customer_id) JOIN class_of USING (customer_id) LEFT JOIN seller USING (customer_id) LEFT JOIN agent USING (owner_id)
    LEFT JOIN erp_contact ON contact_id = ship_contact_id LEFT JOIN erp_address ON address_id = ship_address_id
    LEFT JOIN follow_up USING (order_type, order_nbr) LEFT JOIN offered USING (order_type, order_nbr)""",
)

TWINS["phone_order_lines"] = twin(
    [
        "party", "agent", "goods", "order_state",
        (
            "called",
            f"""SELECT order_type, order_nbr, customer_id, owner_name AS agent, phone1 AS phone, coalesce(ltrim(full_name), ltrim(attention)) AS person,
              {day('order_date')} AS order_date, order_status
            FROM erp_order_header JOIN agent USING (owner_id) JOIN erp_contact ON contact_id = ship_contact_id LEFT JOIN order_state USING (status)
            WHERE phone1 IS NOT NULL AND order_type IN ('BF', 'PH')
              AND greatest(order_date, modified_at) >= TIMESTAMP '2001-08-01' - INTERVAL 800 DAY""",
        ),
    ],
    f"""SELECT DISTINCT acct_cd, coalesce(person, acct_name) AS name, phone, order_nbr, line_nbr, order_date, order_status, inventory_cd, item_descr,
      {money('line_amt')} AS line_amt, agent
    FROM erp_order_line JOIN called USING (order_type, order_nbr) JOIN party USING (customer_id) JOIN goods USING (inventory_id)
    WHERE NOT contains(inventory_cd, '11')""",
)

TWINS["tracked_shipments"] = twin(
    [
        "party", "class_of", "goods", "kinds", "ship_state", "sent_flags",
        (
            "origin",
            """SELECT site_id, rtrim(site_cd) AS warehouse, line1 AS origin_line1, line2 AS origin_line2, city AS origin_city, state AS origin_state,
              postal_code AS origin_postal_code, country AS origin_country
            FROM erp_site JOIN erp_address USING (address_id) WHERE rtrim(site_cd) <> 'OWN5'""",
        ),
        (
            "customer_end",
            """SELECT shipment_type, shipment_nbr, ship_status AS status, ship_date, package_count, acct_cd AS customer_id, rtrim(customer_class) AS customer_class,
              coalesce(nullif(attention, ''), full_name) AS customer,
              CASE WHEN country IN ('CA', 'US') AND NOT contains(phone1, '+') THEN '+1' ELSE '' END || phone1 AS phone_number, email, line1 AS dest_line1,
              line2 AS dest_line2, city AS dest_city, state AS dest_state, postal_code AS dest_postal_code, country AS dest_country,
              CAST(flag AS INT) AS sent_to_warehouse, courier_code
            FROM erp_shipment JOIN ship_state s USING (status) JOIN party p USING (customer_id) JOIN class_of USING (customer_id)
            JOIN erp_contact ON contact_id = ship_contact_id JOIN erp_address ON address_id = ship_address_id LEFT JOIN sent_flags USING (note_id)
            WHERE ship_date >= TIMESTAMP '1999-01-01'""",
        ),
        (
            "ordered",
            f"""SELECT l.order_type, l.order_nbr, l.inventory_id, {whole('l.order_qty')} AS order_qty, {whole('l.shipped_qty')} AS ship_qty, l.unit_price,
              l.line_amt AS amount, {money('freight_amt')} AS freight_amt, {money('order_total')} AS order_total, order_date
            FROM erp_order_line l JOIN erp_order_header USING (order_type, order_nbr) WHERE order_nbr <> '101'""",
        ),
        (
            "parcel",
            """SELECT k.shipment_nbr, k.shipment_line_nbr AS ship_line_nbr, k.inventory_id, p.track_number, p.created_at AS labelled
            FROM erp_package p JOIN erp_package_split k ON k.package_line_nbr = p.line_nbr AND k.shipment_nbr = p.shipment_nbr
            WHERE p.track_number IS NOT NULL""",
        ),
        (
            "shipped",
            """SELECT shipment_type, shipment_nbr, line_nbr AS ship_line_nbr, orig_order_type AS order_type, orig_order_nbr AS order_nbr,
              orig_line_nbr AS order_line_nbr, inventory_id, site_id, shipped_qty AS sent_qty FROM erp_shipment_line""",
        ),
        (
            "every",
            """SELECT * FROM shipped JOIN parcel USING (shipment_nbr, ship_line_nbr, inventory_id) JOIN ordered USING (order_type, order_nbr, inventory_id)
            JOIN customer_end USING (shipment_type, shipment_nbr) JOIN origin USING (site_id) JOIN goods USING (inventory_id) JOIN kinds USING (item_class_id)""",
        ),
        ("worth", "SELECT shipment_nbr, order_nbr, track_number, sum(amount) AS total FROM every GROUP BY shipment_nbr, order_nbr, track_number"),
        (
            "numbered",
            r"""SELECT *, regexp_replace(trim(replace(track_number, 'PRO ' || chr(9), '')), '^[^0-9]', '') AS tracking
            FROM every JOIN worth USING (shipment_nbr, order_nbr, track_number)""",
        ),
    ],
    f"""SELECT shipment_nbr, ship_line_nbr, status, order_nbr, order_line_nbr, order_type, inventory_cd, item_descr AS product_title, order_qty, ship_qty,
      customer_id, customer, phone_number, email, dest_line1, dest_line2, dest_city, dest_state, dest_postal_code, dest_country, origin_line1, origin_line2,
      origin_city, origin_state, origin_postal_code, origin_country, warehouse, package_count, {money('unit_price * sent_qty')} AS line_price,
      {money('amount')} AS line_amt, freight_amt, sent_to_warehouse, order_total, courier_code, CAST(NULL AS VARCHAR) AS courier_name,
      CAST(NULL AS VARCHAR) AS carrier_name, customer_class, item_class_cd, item_class_descr, tracking, {day('labelled')} AS tracking_created,
      {day('ship_date')} AS ship_date, {day('order_date')} AS order_date, split_part(customer, ' ', 1) AS first_name,
      CASE WHEN contains(customer, ' ') THEN substr(customer, strpos(customer, ' ') + 1) END AS last_name,
      CASE WHEN starts_with(tracking, '9') THEN 'usps' WHEN regexp_matches(tracking, '^(8|38|39)') THEN 'fedex' WHEN starts_with(tracking, '1Z') THEN 'ups' END AS slug,
      (SELECT max_by(name, least) FROM (VALUES (-1e18, '$0-499.99'), (500, '$500-999.99'), (1000, '$1000-1999.99'), (2000, '$2000-4999.99'), (5000, '$5000+'))
         AS step(least, name) WHERE least <= total) AS package_value
    FROM numbered""",
)

TWINS["order_shipment_detail"] = twin(
    [
        "goods", "store", "order_state", "ship_state",
        (
            "sold",
            f"""SELECT order_type, order_nbr, line_nbr, split_line_nbr, inventory_id, {day('order_date')} AS order_date, order_status,
              {whole('order_qty')} AS line_qty, inventory_cd, item_descr, site_cd AS warehouse
            FROM erp_order_header JOIN order_state USING (status) JOIN erp_order_line l USING (order_type, order_nbr)
            JOIN erp_order_line_split USING (order_type, order_nbr, line_nbr) JOIN goods USING (inventory_id) LEFT JOIN store USING (site_id)
            WHERE NOT list_contains(['CM', 'QT', 'ZA'], order_type)
              AND EXISTS (SELECT 1 FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND CAST(o_orderkey AS VARCHAR) = order_nbr)""",
        ),
        (
            "sent",
            f"""SELECT orig_order_nbr AS order_nbr, orig_line_nbr AS line_nbr, orig_split_line_nbr AS split_line_nbr, shipment_nbr, e.line_nbr AS ship_line_nbr,
              {whole('shipped_qty')} AS ship_line_qty, {day('ship_date')} AS ship_date, ship_status
            FROM erp_shipment_line e JOIN erp_shipment USING (shipment_type, shipment_nbr) JOIN ship_state USING (status)""",
        ),
        (
            "boxed",
            f"""SELECT s.shipment_nbr, s.line_nbr AS ship_line_nbr, s.inventory_id, p.track_number AS tracking, {time('k.created_at')} AS tracking_created
            FROM erp_shipment_split s LEFT JOIN erp_package_split k ON k.shipment_nbr = s.shipment_nbr AND k.shipment_line_nbr = s.line_nbr
              AND k.shipment_split_line_nbr = s.split_line_nbr
            LEFT JOIN erp_package p ON p.shipment_nbr = k.shipment_nbr AND p.line_nbr = k.package_line_nbr""",
        ),
    ],
    """SELECT DISTINCT order_date, order_type, order_nbr, order_status, line_nbr, line_qty, inventory_cd, item_descr, warehouse, shipment_nbr,
      ship_line_nbr, ship_date, ship_line_qty, ship_status, tracking, tracking_created, concat('ship/', shipment_nbr) AS ship_link
    FROM sold JOIN sent USING (order_nbr, line_nbr, split_line_nbr) LEFT JOIN boxed USING (shipment_nbr, ship_line_nbr, inventory_id)""",
)

TWINS["open_shipments_to_pack"] = twin(
    [
        "party", "goods", "store",
        (
            "waiting",
            """SELECT shipment_nbr, acct_cd, site_cd, modified_at AS changed FROM erp_shipment JOIN store USING (site_id) JOIN party USING (customer_id)
            WHERE status = 'N' AND (site_cd = 'PB' OR starts_with(site_cd, 'PARTNERA'))""",
        ),
        (
            "part_of",
            f"""SELECT shipment_nbr, line_nbr AS ship_line_nbr, split_line_nbr, inventory_id, {whole('shipped_qty')} AS ship_qty,
              {whole('orig_order_qty')} AS order_qty, modified_at AS line_changed
            FROM erp_shipment_line JOIN erp_shipment_split USING (shipment_nbr, line_nbr, inventory_id)""",
        ),
        (
            "box",
            """SELECT k.shipment_nbr, k.shipment_line_nbr AS ship_line_nbr, k.shipment_split_line_nbr AS split_line_nbr, k.package_line_nbr,
              k.modified_at AS box_changed, p.track_number AS tracking
            FROM erp_package_split k LEFT JOIN erp_package p ON p.shipment_nbr = k.shipment_nbr AND p.line_nbr = k.package_line_nbr""",
        ),
    ],
    """SELECT shipment_nbr, ship_line_nbr, 'DEFAULT BOX' AS box_id, split_line_nbr, inventory_id, inventory_cd, acct_cd, ship_qty, order_qty, tracking,
      site_cd, concat_ws('-', shipment_nbr, inventory_cd) AS ship_item, 'Open' AS ship_status, package_line_nbr,
      if(package_line_nbr IS NULL, 'No Package', 'Has Package') AS package
    FROM waiting JOIN part_of USING (shipment_nbr) JOIN goods USING (inventory_id) LEFT JOIN box USING (shipment_nbr, ship_line_nbr, split_line_nbr)
    WHERE tracking IS NULL AND greatest(changed, line_changed, box_changed) >= TIMESTAMP '2001-08-01' - INTERVAL 1500 DAY""",
)

TWINS["shipments_ready_to_confirm"] = twin(
    [
        ("ordered", "SELECT shipment_nbr, CAST(sum(shipped_qty) AS BIGINT) AS shipped_qty FROM erp_shipment_line GROUP BY shipment_nbr"),
        ("packed", "SELECT shipment_nbr, CAST(sum(packed_qty) AS BIGINT) AS packed_qty FROM erp_package_split GROUP BY shipment_nbr"),
        (
            "tracked",
            """SELECT shipment_nbr, shipment_line_nbr AS line_nbr, inventory_id, packed_qty AS qty, track_number
            FROM erp_package_split JOIN (SELECT shipment_nbr, line_nbr AS package_line_nbr, track_number FROM erp_package WHERE track_number IS NOT NULL)
              USING (shipment_nbr, package_line_nbr)""",
        ),
        (
            "met",
            """SELECT shipment_nbr, count(*) AS lines, CAST(sum(shipped_qty) AS BIGINT) AS line_qty, CAST(sum(qty) AS BIGINT) AS package_qty,
              count(DISTINCT track_number) AS packages
            FROM tracked JOIN erp_shipment_line USING (shipment_nbr, line_nbr, inventory_id) GROUP BY shipment_nbr HAVING line_qty = package_qty""",
        ),
    ],
    """SELECT shipment_nbr, lines, line_qty, package_qty, packages, shipped_qty, packed_qty
    FROM met JOIN ordered USING (shipment_nbr) JOIN packed USING (shipment_nbr)
    WHERE shipped_qty = packed_qty AND shipment_nbr IN (SELECT shipment_nbr FROM erp_shipment WHERE status = 'N')""",
)

# one row per line of an open return at the partner's site
RETURNED: list[str | tuple[str, str]] = [
    "party", "recipient", "destination", "goods", "kinds", "store", "order_state", "return_flags",
    (
        "head",
        f"""SELECT order_type, order_nbr, {time('order_date')} AS order_date, customer_order_nbr, ship_via, order_status, flag, acct_cd, acct_name, full_name,
          COLUMNS('ship_to_.*')
        FROM erp_order_header JOIN party USING (customer_id) JOIN recipient USING (ship_contact_id) JOIN destination USING (ship_address_id)
        LEFT JOIN order_state USING (status) LEFT JOIN return_flags USING (note_id) WHERE order_type = 'RC' AND status = 'N'""",
    ),
    (
        "returned",
        f"""SELECT order_type, order_nbr, line_nbr, inventory_id, {whole('order_qty')} AS qty, orig_order_type, orig_order_nbr, inventory_cd, item_descr,
          item_class_descr
        FROM erp_order_line JOIN store USING (site_id) JOIN goods USING (inventory_id) JOIN kinds USING (item_class_id) WHERE site_cd = 'PB'""",
    ),
]
TWINS["returns_to_send"] = twin(
    RETURNED,
    f"""SELECT order_nbr AS rma_number, order_status, coalesce(orig_order_nbr, customer_order_nbr) AS original_order_nbr, '3' AS rma_type, {label(25)},
      line_nbr, inventory_cd, qty, acct_cd, orig_order_type, item_descr, {location(['cpo'])}, item_class_descr, CAST(flag AS INT) AS sent_to_warehouse,
      order_type, order_date
    FROM head JOIN returned USING (order_type, order_nbr) WHERE order_nbr <> '55' AND flag IS DISTINCT FROM 1""",
)
TWINS["returns_without_receipt"] = twin(
    RETURNED,
    f"""SELECT order_nbr AS return_nbr, line_nbr, order_type, inventory_cd, qty, acct_cd, item_descr, item_class_descr, CAST(flag AS INT) AS sent_to_warehouse,
      order_date, order_status, coalesce(orig_order_nbr, customer_order_nbr) AS original_order_nbr, {label(25)}
    FROM head JOIN returned r USING (order_type, order_nbr)
    WHERE flag = 1 AND NOT EXISTS (SELECT 1 FROM erp_shipment_line e
      WHERE e.orig_order_nbr = r.order_nbr AND e.orig_line_nbr = r.line_nbr AND e.inventory_id = r.inventory_id)""",
)

# one row per line of an open shipment that no partner has yet
UNSENT: list[str | tuple[str, str]] = [
    "party", "recipient", "destination", "goods", "kinds", "store", "ship_state", "sent_flags",
    (
        "head",
        """SELECT shipment_type, shipment_nbr, ship_via, ship_status, CAST(flag AS INT) AS sent_to_warehouse, partner_order_id, acct_cd, acct_name, full_name,
          site_cd, COLUMNS('ship_to_.*')
        FROM erp_shipment JOIN sent_flags USING (note_id) JOIN store USING (site_id) JOIN party USING (customer_id) JOIN recipient USING (ship_contact_id)
        JOIN destination USING (ship_address_id) LEFT JOIN ship_state USING (status)
        WHERE flag = 0 AND NOT list_contains(['C', 'F', 'I', 'L'], status)""",
    ),
    (
        "going",
        f"""SELECT shipment_type, shipment_nbr, line_nbr, {whole('shipped_qty')} AS qty, orig_order_type, orig_order_nbr, inventory_cd, item_descr,
          item_class_descr
        FROM erp_shipment_line JOIN goods USING (inventory_id) JOIN kinds USING (item_class_id) WHERE orig_order_type <> 'RC'""",
    ),
]
TWINS["shipments_to_send"] = twin(
    UNSENT,
    f"""SELECT shipment_nbr AS rma_number, ship_status, orig_order_nbr AS order_nbr, 'W' AS rma_type, {label(35)}, line_nbr, inventory_cd, qty, acct_cd,
      orig_order_type, item_descr, {location(['cpo', 'pre own', 'pre-own'])}, item_class_descr, sent_to_warehouse
    FROM head JOIN going USING (shipment_type, shipment_nbr) WHERE site_cd = 'PB'""",
)
TWINS["shipments_to_send_with_level"] = twin(
    UNSENT,
    f"""SELECT shipment_nbr, ship_status, sent_to_warehouse, partner_order_id, orig_order_nbr, orig_order_type, line_nbr, qty, inventory_cd, item_descr,
      item_class_descr, acct_cd, {label(35)},
      CASE WHEN list_contains(['5', '105', '205'], inventory_cd) THEN 'cheapest_GROUND' WHEN ship_via = '2DAY' THEN 'cheapest_TWO_DAY'
           WHEN ship_via = 'LTL' THEN 'external_ltl' WHEN ship_via IS NOT NULL AND contains(lower(item_descr), 'battery') THEN 'cheapest_UPS'
           ELSE 'cheapest_ALL' END AS level
    FROM head JOIN going USING (shipment_type, shipment_nbr) WHERE starts_with(site_cd, 'PARTNERA')""",
)

# one row per order that may be sent, with all its parties
SENDABLE: list[str | tuple[str, str]] = [
    "party", "class_of", "agent", "order_state", "goods",
    (
        "basket",
        f"""SELECT order_nbr, '[' || string_agg(entry, ',' ORDER BY line_nbr, inventory_cd, qty) || ']' AS line_items
        FROM (SELECT order_nbr, line_nbr, inventory_cd, qty,
                format('{{{{"line_nbr":{{}},"inventory_cd":"{{}}","item_descr":"{{}}","qty":{{}}}}}}', line_nbr, inventory_cd, rtrim(item_descr), qty) AS entry
              FROM (SELECT *, {whole('order_qty')} AS qty FROM erp_order_line JOIN goods USING (inventory_id)))
        GROUP BY order_nbr""",
    ),
    ("paid_at", "SELECT order_type, order_nbr, url AS payment_link FROM erp_invoice LEFT JOIN erp_pay_link USING (ref_nbr)"),
    (
        "crm",
        """SELECT account_id AS customer_id, strftime(created_at, '%Y-%m-%d') AS customer_since, value AS crm_link
        FROM erp_account LEFT JOIN (SELECT note_id, value FROM erp_account_answers WHERE attribute_id = 'CRMID') USING (note_id)""",
    ),
    (
        "person",
        "SELECT sales_person_id, rtrim(sales_person_cd) AS person_cd, rtrim(descr) AS person_name FROM erp_sales_person",
    ),
    (
        "bill",
        """SELECT order_type, order_nbr, '+1' || coalesce(phone1, '') AS billing_phone, email AS billing_email, line1 AS billing_line1, city AS billing_city
        FROM erp_order_header JOIN erp_contact ON contact_id = bill_contact_id JOIN erp_address ON address_id = bill_address_id""",
    ),
    (
        "ship",
        """SELECT order_type, order_nbr, '+1' || coalesce(phone1, '') AS shipping_phone, email AS shipping_email, line1 AS shipping_line1,
          country AS shipping_country
        FROM erp_order_header JOIN erp_contact ON contact_id = ship_contact_id JOIN erp_address ON address_id = ship_address_id""",
    ),
    (
        "sendable",
        f"""SELECT *, {day('order_date')} AS date FROM erp_order_header h JOIN order_state USING (status) JOIN party USING (customer_id)
        JOIN class_of USING (customer_id) JOIN bill USING (order_type, order_nbr) JOIN ship USING (order_type, order_nbr)
        WHERE NOT list_contains(['CM', 'QT', 'ZA'], order_type)""",
    ),
]
SEND_COLUMNS = """date, order_type, order_nbr, line_items, order_status, status, acct_cd, rtrim(acct_name) AS acct_name, customer_class, payment_link,
      billing_line1, billing_city, shipping_line1, shipping_country, billing_phone, billing_email, shipping_phone, shipping_email,
      CASE WHEN person_cd IS NULL AND order_type <> 'RT' THEN owner_cd ELSE person_cd END AS sales_person_cd,
      CASE WHEN person_cd IS NULL AND order_type <> 'RT' THEN owner_name ELSE person_name END AS sales_person,
      concat('cust/', acct_cd) AS customer_link, concat_ws('/', 'order', order_type, order_nbr) AS order_link, crm_link, customer_since"""
SEND_FACTS = """LEFT JOIN basket USING (order_nbr) LEFT JOIN paid_at USING (order_type, order_nbr) LEFT JOIN crm USING (customer_id)
    LEFT JOIN person USING (sales_person_id) LEFT JOIN agent USING (owner_id)"""
TWINS["orders_to_send"] = twin(
    [
        *SENDABLE,
        (
            "chosen",
            """SELECT * FROM sendable s WHERE NOT EXISTS (SELECT 1 FROM erp_order_ledger k WHERE k.order_nbr = s.order_nbr AND k.status = s.status)
            ORDER BY modified_at DESC, order_nbr LIMIT 120""",
        ),
    ],
    f"SELECT {SEND_COLUMNS} FROM chosen {SEND_FACTS}",
)
TWINS["orders_to_resend"] = twin(
    SENDABLE,
    f"SELECT {SEND_COLUMNS} FROM sendable {SEND_FACTS} WHERE modified_at >= TIMESTAMP '2001-08-01' - INTERVAL 600 DAY",
)
