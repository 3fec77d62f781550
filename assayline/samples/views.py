"""Retail-shaped views over the driver's tables.

Each text is SQL that both engines read the same way. ``{table}`` stands for a
base table: Spark gets a DataFrame for it, the checking SQL its plain name. The
views make missing, unknown and malformed values from the keys, so that every
rule has rows on both of its sides.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "catalogue": """
SELECT p_partkey AS product_id,
       'SKU-' || CAST(p_partkey AS STRING) AS sku,
       p_name AS product_name,
       p_type AS category_id,
       p_brand AS brand_id,
       CASE WHEN p_partkey % 11 = 0 THEN 'ZZ' WHEN p_size > 25 THEN 'NEW' ELSE 'USED' END AS condition_code,
       p_retailprice / 2 AS standard_cost,
       p_retailprice AS rrp,
       CAST(p_size AS DOUBLE) / 4 AS weight_kg,
       p_size % 2 = 0 AS is_campaign_product,
       p_partkey % 7 <> 0 AS is_active,
       CASE WHEN p_partkey % 19 = 0 THEN NULL
            WHEN p_partkey % 23 = 0 THEN '2024-13-45'
            ELSE '2024-0' || CAST(p_partkey % 9 + 1 AS STRING) || '-1' || CAST(p_partkey % 10 AS STRING)
       END AS created_date,
       '2024-10-2' || CAST(p_partkey % 10 AS STRING) AS last_updated,
       'SUP-' || CAST(p_partkey % 100 AS STRING) AS supplier_code
FROM {part}""",
    "brands": """
SELECT DISTINCT p_brand AS brand_id, upper(p_brand) AS brand_name,
       CASE WHEN length(p_brand) > 7 THEN 'PK' ELSE 'AE' END AS brand_country,
       substr(p_brand, 7) AS brand_segment
FROM {part}""",
    "part_categories": """
SELECT DISTINCT p_type AS category_id, lower(p_type) AS category_name,
       CAST(NULL AS STRING) AS parent_category_id, 1 AS level
FROM {part}""",
    "categories": """
SELECT CAST(r_regionkey + 1000 AS INT) AS category_id, r_name AS category_name,
       CAST(NULL AS INT) AS parent_category_id, 1 AS level
FROM {region}
UNION ALL
SELECT n_nationkey, n_name, CAST(n_regionkey + 1000 AS INT), 2 FROM {nation}""",
    "condition_codes": """
SELECT DISTINCT CASE WHEN p_size > 25 THEN 'NEW' ELSE 'USED' END AS code,
       CASE WHEN p_size > 25 THEN 'never opened' ELSE 'opened before' END AS description
FROM {part}""",
    "loyalty_tiers": """
SELECT c_mktsegment AS tier_id, lower(c_mktsegment) AS tier_name,
       min(c_acctbal) AS points_per_currency
FROM {customer} GROUP BY c_mktsegment
UNION ALL
SELECT 'SUPPLIER', 'supplier', max(s_acctbal) FROM {supplier}""",
    "listings": """
SELECT o_orderkey AS listing_id, o_custkey % 100 AS seller_id,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL
            WHEN o_orderkey % 10 = 0 THEN 'RGE-' || CAST(o_orderkey % 37 AS STRING)
            ELSE 'SKU-' || CAST(pk AS STRING) END AS sku_ref,
       CASE WHEN o_orderkey % 89 = 0 THEN NULL
            WHEN o_orderkey % 50 = 1 THEN 'phone case'
            WHEN o_orderkey % 3 = 0 THEN upper(p_name) || ' - used'
            WHEN o_orderkey % 20 = 10 THEN replace(p_name, 'e', '')
            ELSE p_name END AS seller_product_title,
       o_totalprice AS asking_price, p_type AS category_id
FROM {orders}
JOIN (SELECT l_orderkey, min(l_partkey) AS pk FROM {lineitem} GROUP BY l_orderkey) first_part
  ON l_orderkey = o_orderkey
JOIN {part} ON p_partkey = pk""",
    "raw_dates": """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL
            WHEN o_orderkey % 13 = 0 THEN '31/02/2024'
            ELSE lpad(CAST(day(o_orderdate) AS STRING), 2, '0') || '/' ||
                 lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || '/' ||
                 CAST(year(o_orderdate) AS STRING) END AS order_date
FROM {orders}""",
    "date_texts": """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL
            WHEN o_orderkey % 13 = 0 THEN '2024-02-31'
            ELSE substr(CAST(o_orderdate AS STRING), 1, 10) END AS iso_date,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL
            WHEN o_orderkey % 13 = 0 THEN '05-Abc-2024'
            ELSE lpad(CAST(day(o_orderdate) AS STRING), 2, '0') || '-' ||
                 substr('JanFebMarAprMayJunJulAugSepOctNovDec',
                        CAST(3 * month(o_orderdate) - 2 AS INT), 3) || '-' ||
                 CAST(year(o_orderdate) AS STRING) END AS ddmonyyyy
FROM {orders}""",
    "time_texts": """
SELECT event_id,
       CASE WHEN event_id % 17 = 0 THEN NULL
            WHEN event_id % 13 = 0 THEN 'not a time'
            ELSE substr(CAST(ts AS STRING), 1, 10) || 'T' || substr(CAST(ts AS STRING), 12, 8)
       END AS iso_timestamp,
       CASE WHEN event_id % 17 = 0 THEN NULL
            WHEN event_id % 13 = 0 THEN '2024/02/31 10:00'
            ELSE replace(substr(CAST(ts AS STRING), 1, 16), '-', '/') END AS slash_datetime,
       CASE WHEN event_id % 17 = 0 THEN NULL
            WHEN event_id % 13 = 0 THEN 'abc'
            ELSE CAST(1704067200 + event_id * 37 AS STRING) END AS epoch,
       CASE WHEN event_id % 17 = 0 THEN NULL
            WHEN event_id % 13 = 0 THEN '2024-01-01 25:00:00'
            ELSE substr(CAST(ts AS STRING), 1, 19) END AS pg_text
FROM {events}""",
    "order_facts": """
SELECT o_orderkey,
       o_custkey,
       CASE WHEN o_orderkey % 23 = 0 THEN NULL
            WHEN o_orderkey % 29 = 0 THEN -o_custkey - 1
            ELSE o_custkey END AS buyer_id,
       CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_orderstatus END AS status,
       CASE WHEN o_orderstatus = 'P' THEN 'CANCELLED' ELSE 'OPEN' END AS order_state,
       CASE WHEN o_orderkey % 7 = 0 THEN -o_totalprice ELSE o_totalprice END AS amount,
       CAST(o_orderdate AS DATE) AS order_date
FROM {orders}""",
    "bad_reasons": """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL
            WHEN o_orderkey % 3 = 1 THEN 'DATE_PARSE_FAIL'
            WHEN o_orderkey % 5 = 0 THEN 'DATE_PARSE_FAIL, FOO'
            ELSE 'BAR,ORPHAN_FK' END AS anomaly_reason_code,
       CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE o_orderkey % 3 <> 0 END AS anomaly_flag,
       CASE WHEN o_orderkey % 43 = 0 THEN NULL
            WHEN o_orderkey % 3 = 0 THEN 'CLEAN' ELSE 'FLAGGED_ANOMALY' END AS data_quality_status,
       CASE WHEN o_orderkey % 3 = 0 THEN 'CONFIRMED' ELSE 'UNRELIABLE' END AS metric_certainty_level
FROM {orders}""",
    # three snapshots: names and prices change and change back, products are missing and come back
    "product_days": """
SELECT DATE '1996-01-01' AS day, 'SKU-' || CAST(p_partkey AS STRING) AS sku, p_name AS product_name,
       p_brand AS brand_id, p_retailprice AS rrp
FROM {part} WHERE p_partkey % 13 <> 0
UNION ALL
SELECT DATE '1998-01-01', 'SKU-' || CAST(p_partkey AS STRING),
       CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 7 = 1 THEN upper(p_name) ELSE p_name END,
       p_brand, CASE WHEN p_partkey % 5 = 0 THEN p_retailprice + 10 ELSE p_retailprice END
FROM {part} WHERE p_partkey % 17 <> 0
UNION ALL
SELECT DATE '2000-01-01', 'SKU-' || CAST(p_partkey AS STRING), CASE WHEN p_partkey % 14 = 0 THEN NULL ELSE p_name END,
       CASE WHEN p_partkey % 3 = 0 THEN lower(p_brand) ELSE p_brand END,
       CASE WHEN p_partkey % 10 = 0 THEN p_retailprice + 10 ELSE p_retailprice END
FROM {part} WHERE p_partkey % 19 <> 0""",
    # customer records of several systems: shared and shifted contacts, blanks, one address that many give
    "contacts": """
SELECT c_custkey AS record_id,
       CASE WHEN c_custkey % 23 = 0 THEN 'shop@example.org' WHEN c_custkey % 6 >= 4 THEN NULL
            WHEN c_custkey % 29 = 0 THEN '  '
            ELSE 'c' || CAST(CAST(floor(c_custkey / 3) AS BIGINT) AS STRING) || '@example.org' END AS email,
       CASE WHEN c_custkey % 24 < 9 THEN '+1' || CAST(CAST(floor((c_custkey + 1) / 4) AS BIGINT) AS STRING) END AS phone,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name END AS full_name,
       c_mktsegment AS segment
FROM {customer}""",
    # what happens to an order, from its dates and keys; some of it too early, too late or never
    "order_log": """
SELECT o_orderkey AS order_key, 'ordered' AS event, CAST(o_orderdate AS DATE) AS day FROM {orders}
UNION ALL SELECT o_orderkey, 'payment', CAST(o_orderdate AS DATE) + CAST(o_orderkey % 6 AS INT) FROM {orders}
UNION ALL SELECT o_orderkey, 'cancelled', CAST(o_orderdate AS DATE) + 3 FROM {orders} WHERE o_orderstatus = 'P' AND o_orderkey % 7 < 2
UNION ALL SELECT o_orderkey, 'bopis', CAST(o_orderdate AS DATE) FROM {orders} WHERE o_orderpriority = '5-LOW'
UNION ALL SELECT o_orderkey, 'picked_up', CAST(o_orderdate AS DATE) + 2 FROM {orders} WHERE o_orderkey % 4 <> 0
UNION ALL SELECT l_orderkey, 'shipped', CAST(l_shipdate AS DATE) FROM {lineitem}
UNION ALL SELECT l_orderkey, 'delivered', CASE WHEN l_partkey % 40 = 3 THEN NULL
       ELSE CAST(l_shipdate AS DATE) + CAST(l_partkey % 19 - 1 AS INT) END FROM {lineitem} WHERE l_orderkey % 5 <> 0
UNION ALL SELECT l_orderkey, 'review', CAST(l_shipdate AS DATE) + CAST(l_suppkey % 30 AS INT) FROM {lineitem} WHERE l_linenumber = 1""",
    # delays of couriers in days, two of them by clocks that are off
    "deliveries": """
SELECT l_orderkey, l_linenumber, 'C' || CAST(l_suppkey % 30 AS STRING) AS courier,
       CASE WHEN l_orderkey % 50 = 0 THEN NULL
            ELSE CAST(l_partkey % 7 + l_linenumber % 3 + CASE l_suppkey % 30 WHEN 7 THEN 40 WHEN 13 THEN -30 ELSE l_suppkey % 30 % 2 END AS BIGINT)
       END AS delay_days
FROM {lineitem}""",
    # literal mapping rows: fixed values
    "status_map": """
SELECT source_system, raw_code, canonical_status, CAST(1.0 AS DOUBLE) AS mapping_confidence
FROM (VALUES
  ('ORD', 'O', 'OPEN'), ('ORD', 'F', 'DELIVERED'),
  ('LINE', 'O', 'OPEN'), ('LINE', 'F', 'DELIVERED'),
  ('RET', 'R', 'RETURNED'), ('RET', 'N', 'CONFIRMED'),
  ('EVT', 'purchase', 'CONFIRMED'), ('EVT', 'signup', 'OPEN'),
  ('EVT', 'view', 'OPEN'), ('EVT', 'click', 'OPEN')
) AS t(source_system, raw_code, canonical_status)""",
    "status_seen": """
SELECT DISTINCT 'ORD' AS source_system, o_orderstatus AS raw_code FROM {orders}
UNION SELECT 'LINE', l_linestatus FROM {lineitem}
UNION SELECT 'RET', l_returnflag FROM {lineitem}
UNION SELECT 'EVT', event_type FROM {events}""",
}


def base(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _tables(text: str) -> set[str]:
    return {field for _, field, _, _ in string.Formatter().parse(text) if field}


def view(spark: SparkSession, name: str, table: Callable[[str], DataFrame]) -> DataFrame:
    """A view as a DataFrame over the frames that ``table`` gives."""
    text = VIEWS[name]
    return spark.sql(text, **{t: table(t) for t in _tables(text)})


def view_sql(name: str) -> str:
    """A view as text over the plain table names."""
    text = VIEWS[name]
    return text.format(**{t: t for t in _tables(text)})


def with_views(query: str, *names: str) -> str:
    """``query`` with the named views (``v_<name>``) in front of it."""
    parts = ",\n".join(f"v_{n} AS ({view_sql(n)})" for n in names)
    for start in ("WITH RECURSIVE ", "WITH "):
        if query.lstrip().upper().startswith(start):
            return f"{start}{parts},\n{query.lstrip()[len(start):]}"
    return f"WITH {parts}\n{query}"
