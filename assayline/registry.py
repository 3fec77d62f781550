"""Vocabularies shared by the whole package.

Everything in this module is a fixed value: results of other systems are
compared against these words and numbers, so they must not change.
"""

from __future__ import annotations

# ---- fixed values: quality columns every Silver table ends with -------------
QUALITY_COLUMNS = (
    "anomaly_flag",
    "anomaly_reason_code",
    "data_quality_status",
    "metric_certainty_level",
)

# ---- fixed values: severity scales, mildest first ---------------------------
STATUSES = (
    "CLEAN",
    "RECONSTRUCTED",
    "FLAGGED_AMBIGUOUS",
    "FLAGGED_ANOMALY",
    "EXCLUDED_WITH_REASON",
)
CERTAINTIES = ("CONFIRMED", "INFERRED", "ESTIMATED", "UNRELIABLE")

# ---- fixed values: registered anomaly reason codes (40) ---------------------
REASON_CODES = (
    # universal
    "DATE_PARSE_FAIL", "DATE_FUTURE", "DATE_BEFORE_RANGE",
    "STATUS_UNMAPPED", "ORPHAN_FK", "NEGATIVE_QTY",
    "NEGATIVE_AMOUNT", "MISSING_REQUIRED_FIELD",
    # customer
    "IDENTITY_AMBIGUOUS", "PLACEHOLDER_ID_COLLISION",
    "FUZZY_MATCH_LOW_CONF", "EMAIL_MALFORMED", "PHONE_NORMALISATION_FAIL",
    # product
    "SKU_PRODUCT_MISMATCH", "SKU_NOT_IN_CATALOGUE",
    "PRODUCT_FUZZY_MATCH", "PRODUCT_NAME_CONFLICT",
    # inventory
    "RECONSTRUCTED_SNAPSHOT", "MISSING_SNAPSHOT_DAY",
    "ATP_POSITIVE_PHYSICAL_ZERO", "OPEN_BOX_AS_NEW",
    "MOVEMENT_NULL_REF", "OVERSELL",
    # sales
    "CANCELLED_WITH_REVENUE", "PAYMENT_AFTER_CANCEL",
    "TAX_INCLUSION_MISMATCH", "DELIVERY_BEFORE_SHIP",
    "COURIER_CLOCK_DRIFT", "BOPIS_NO_PICKUP_EVENT",
    "REFUND_PARTIAL_PERIOD_AMBIGUITY", "ATTRIBUTION_SESSION_BRIDGE",
    # marketplace
    "NL_SELLER_SOLD_AS_REVENUE", "RELISTED_AFTER_SOLD",
    "IMAGE_HASH_REUSED", "REVIEW_BEFORE_DELIVERY",
    "DUPLICATE_CASE", "ESTIMATED_NL_GMV",
    "LISTING_LOW_CONFIDENCE", "SELLER_HIGH_RISK",
    "MANUAL_CHANNEL_ATTRIBUTION",
)

# ---- fixed values: surrogate-key format -------------------------------------
KEY_SEPARATOR = "|"
KEY_NULL = "~NULL~"
ANONYMOUS_PREFIX = "ANON"
ANONYMOUS_BELOW = 0.70

# ---- fixed values: date formats by hint -------------------------------------
DATE_PATTERNS = {
    "ddmmyyyy": "dd/MM/yyyy",
    "iso_date": "yyyy-MM-dd",
    "ddmonyyyy": "dd-MMM-yyyy",
}
TIMESTAMP_PATTERNS = {
    "iso_timestamp": None,
    "slash_datetime": "yyyy/MM/dd HH:mm",
}
PG_TEXT_PATTERN = "yyyy-MM-dd HH:mm:ss"

# ---- fixed values: matching thresholds --------------------------------------
OVERLAP_BELOW = 0.35
FUZZY_PERCENT = 70
FUZZY_MOST = 0.99
FREE_TEXT_PERCENT = 85

# ---- fixed values: project date window --------------------------------------
WINDOW_START = "2024-03-01"
WINDOW_END = "2024-09-14"

# ---- fixed values: status mapping (source_system, raw_code, canonical_status)
# Every curated row has mapping confidence 1.0.
STATUS_UNMAPPED = "UNMAPPED"
STATUS_MAPPINGS = (
    ("POS", "OPN", "OPEN"),
    ("POS", "CMP", "CONFIRMED"),
    ("POS", "ABT", "CANCELLED"),
    ("POS", "RFD", "REFUNDED"),
    ("POS", "VOD", "CANCELLED"),
    ("POS", "HLD", "OPEN"),
    ("EC", "pending", "OPEN"),
    ("EC", "processing", "OPEN"),
    ("EC", "confirmed", "CONFIRMED"),
    ("EC", "picked", "IN_FULFILMENT"),
    ("EC", "packed", "IN_FULFILMENT"),
    ("EC", "shipped", "IN_FULFILMENT"),
    ("EC", "delivered", "DELIVERED"),
    ("EC", "cancelled", "CANCELLED"),
    ("EC", "returned", "RETURNED"),
    ("PG", "INITIATED", "OPEN"),
    ("PG", "AUTHORIZED", "OPEN"),
    ("PG", "CAPTURED", "CONFIRMED"),
    ("PG", "FAILED", "CANCELLED"),
    ("PG", "REVERSED", "REFUNDED"),
    ("PG", "DISPUTED", "OPEN"),
    ("PG", "PENDING", "OPEN"),
    ("PG", "REFUNDED", "REFUNDED"),
    ("MARKETPLACE", "ACTIVE", "OPEN"),
    ("MARKETPLACE", "SUSPENDED", "CANCELLED"),
    ("MARKETPLACE", "BANNED", "CANCELLED"),
    ("MARKETPLACE", "PENDING", "OPEN"),
    ("MARKETPLACE", "TERMINATED", "CANCELLED"),
)

# ---- fixed values: Bronze lineage columns -----------------------------------
BRONZE_METADATA = ("_source_table", "_ingestion_timestamp", "_source_row_number")

# ---- fixed values: expected Bronze row counts (61 tables, 843,304 rows) -----
EXPECTED_BRONZE_ROWS = (
    ("cl_customers", 2501),
    ("cl_loyalty_tiers", 4),
    ("cl_loyalty_transactions", 2860),
    ("cs_agents", 25),
    ("cs_case_events", 225),
    ("cs_cases", 129),
    ("cs_complaint_categories", 12),
    ("dc_carriers", 5),
    ("dc_delivery_events", 3542),
    ("dc_event_types", 10),
    ("dc_shipments", 771),
    ("ec_delivery_methods", 5),
    ("ec_order_lines", 1840),
    ("ec_order_status_codes", 9),
    ("ec_order_status_history", 3307),
    ("ec_orders", 963),
    ("nl_categories", 13),
    ("nl_event_types", 14),
    ("nl_listing_events", 38706),
    ("nl_listings", 1253),
    ("nl_user_accounts", 356),
    ("pc_brands", 30),
    ("pc_categories", 27),
    ("pc_condition_codes", 10),
    ("pc_price_history", 0),
    ("pc_products", 65),
    ("pg_instrument_types", 12),
    ("pg_status_codes", 8),
    ("pg_transactions", 963),
    ("pos_cashiers", 160),
    ("pos_payment_methods", 7),
    ("pos_status_codes", 6),
    ("pos_stores", 20),
    ("pos_transaction_lines", 24507),
    ("pos_transactions", 10868),
    ("rr_refund_events", 74),
    ("rr_return_reasons", 12),
    ("rr_return_receipts", 74),
    ("rr_return_requests", 74),
    ("rv_reviews", 377),
    ("si_inventory_movements", 438018),
    ("si_inventory_snapshots", 216645),
    ("si_movement_types", 10),
    ("ts_fulfilment_events", 593),
    ("ts_marketplace_orders", 252),
    ("ts_report_reasons", 11),
    ("ts_risk_signals", 58),
    ("ts_safety_reports", 91),
    ("ts_seller_listings", 400),
    ("ts_seller_status_codes", 5),
    ("ts_seller_types", 4),
    ("ts_sellers", 100),
    ("ts_signal_types", 10),
    ("wh_inbound_receipts", 57),
    ("wh_inventory_movements", 30437),
    ("wh_inventory_snapshots", 38610),
    ("wh_movement_types", 12),
    ("wh_warehouses", 3),
    ("ws_event_types", 17),
    ("ws_page_events", 20757),
    ("ws_sessions", 3370),
)
