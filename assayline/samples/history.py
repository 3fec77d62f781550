"""Dimension histories, as-of lookups and running balances."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.operators.asof import as_of_join
from assayline.operators.balances import oversell_rule, running_balance
from assayline.operators.history import check_history, merge_history
from assayline.operators.quality import add_anomaly_columns, flag_all
from assayline.plans import lookups
from assayline.plans.dimensions import build_dim_listing_condition, build_dim_product, key_facts
from assayline.samples.registry import Source, query
from assayline.sources.scratch import stored

DAYS = ["1996-01-01", "1998-01-01", "2000-01-01"]

# versions from all snapshots at once: runs of days on which a product looks the same
_VERSIONS = """
v_days AS (SELECT day, lag(day) OVER (ORDER BY day) AS prev_day, lead(day) OVER (ORDER BY day) AS next_day
           FROM (SELECT DISTINCT day FROM v_product_days)),
v_seen AS (SELECT s.*, prev_day, next_day, lag(s.day) OVER w AS had, lag(product_name) OVER w AS had_name,
                  lag(rrp) OVER w AS had_rrp
           FROM v_product_days s JOIN v_days USING (day) WINDOW w AS (PARTITION BY sku ORDER BY s.day)),
v_runs AS (SELECT *, sum(CASE WHEN had = prev_day AND had_name IS NOT DISTINCT FROM product_name AND had_rrp = rrp
                              THEN 0 ELSE 1 END) OVER (PARTITION BY sku ORDER BY day) AS run FROM v_seen),
v_versions AS (SELECT sku, min(day) AS valid_from, arg_max(next_day, day) AS closed, max(next_day) AS furthest,
                      arg_max(product_name, day) AS a_name, first(product_name) AS product_name, first(rrp) AS rrp,
                      arg_max(brand_id, day) AS brand_id, max(day) AS last_day
               FROM v_runs GROUP BY sku, run),
v_dim AS (SELECT sku, product_name, rrp, brand_id, valid_from,
                 (SELECT next_day FROM v_days WHERE day = last_day) AS valid_to FROM v_versions)"""


def _snapshots(t: Source) -> list[DataFrame]:
    rows = t.v("product_days")
    return [rows.where(F.col("day") == F.lit(day).cast("date")).drop("day") for day in DAYS]


def _dim(t: Source) -> DataFrame:
    """The three snapshots merged one after the other; a change of the brand makes no version."""
    history = None
    for day, snapshot in zip(DAYS, _snapshots(t)):
        history = stored(build_dim_product(history, snapshot, day, ["product_name", "rrp"]), "dim_product")
    return history


@query(
    f"""
WITH {_VERSIONS}
SELECT sha256(sku || '|' || CAST(valid_from AS VARCHAR)) AS version_key, sku, product_name, rrp, brand_id, valid_from,
       valid_to, valid_to IS NULL AS is_current FROM v_dim""",
    "product_days",
)
def dim_product_history(t: Source) -> DataFrame:
    return _dim(t).drop("row_hash")


@query(
    f"""
WITH {_VERSIONS}
SELECT sku, product_name, rrp, brand_id, valid_from, valid_to FROM v_dim""",
    "product_days",
)
def dim_product_rerun(t: Source) -> DataFrame:
    """A wrong last snapshot, then the right one, then the right one again."""
    first, second, third = _snapshots(t)
    wrong = third.where("brand_id <> 'Brand#1'").withColumn("rrp", F.col("rrp") + 1)
    history = None
    for day, rows in zip([*DAYS, DAYS[2], DAYS[2]], [first, second, wrong, third, third]):
        history = stored(merge_history(history, rows, ["sku"], day, ["product_name", "rrp"]), "dim_product")
    return history.select("sku", "product_name", "rrp", "brand_id", "valid_from", "valid_to")


@query(
    f"""
WITH {_VERSIONS}
SELECT 'dim_product' AS history, count(*) AS versions, count(*) FILTER (valid_to IS NULL) AS open_versions,
       CAST(0 AS BIGINT) AS several_open, CAST(0 AS BIGINT) AS overlaps, CAST(0 AS BIGINT) AS empty_intervals
FROM v_dim""",
    "product_days",
)
def dim_product_checks(t: Source) -> DataFrame:
    return check_history(_dim(t), "dim_product", ["sku"])


@query(
    """
SELECT sha256(code) AS listing_condition_key, code, description, code <> 'UNKNOWN' AS is_known
FROM (SELECT code, description FROM v_condition_codes UNION ALL SELECT 'UNKNOWN', 'not a registered code')""",
    "condition_codes",
)
def dim_listing_condition(t: Source) -> DataFrame:
    return build_dim_listing_condition(lookups.build_condition_codes(t.v("condition_codes")))


_LINES = """
v_lines AS (SELECT l_orderkey, l_linenumber, 'SKU-' || CAST(l_partkey AS VARCHAR) AS sku,
                   CASE WHEN l_orderkey % 31 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS ship_day
            FROM lineitem)"""


@query(
    f"""
WITH {_VERSIONS}, {_LINES}
SELECT l.l_orderkey, l.l_linenumber, l.sku, l.ship_day,
       CASE WHEN d.sku IS NOT NULL THEN sha256(d.sku || '|' || CAST(d.valid_from AS VARCHAR)) END AS product_version_key,
       d.rrp, d.product_name, d.sku IS NULL AS anomaly_flag,
       CASE WHEN d.sku IS NULL THEN 'ORPHAN_FK' END AS anomaly_reason_code,
       CASE WHEN d.sku IS NULL THEN 'FLAGGED_ANOMALY' ELSE 'CLEAN' END AS data_quality_status,
       CASE WHEN d.sku IS NULL THEN 'UNRELIABLE' ELSE 'CONFIRMED' END AS metric_certainty_level
FROM v_lines l LEFT JOIN v_dim d ON l.sku = d.sku AND d.valid_from <= l.ship_day
     AND (d.valid_to IS NULL OR l.ship_day < d.valid_to)""",
    "product_days",
)
def fact_lines_versioned(t: Source) -> DataFrame:
    """Order lines with the product version of their day; the versions are broadcast."""
    return key_facts(_lines(t), _dim(t), "sku", "ship_day", ["rrp", "product_name"])


def _lines(t: Source) -> DataFrame:
    day = F.when(F.col("l_orderkey") % 31 != 0, F.col("l_shipdate").cast("date"))
    sku = F.concat(F.lit("SKU-"), F.col("l_partkey").cast("string"))
    return add_anomaly_columns(t.lineitem.select("l_orderkey", "l_linenumber", sku.alias("sku"), day.alias("ship_day")))


@query(
    f"""
WITH {_VERSIONS}, {_LINES}
SELECT d.sku, d.valid_from, count(*) AS lines, min(l.ship_day) AS first_day
FROM v_lines l JOIN v_dim d ON l.sku = d.sku AND d.valid_from <= l.ship_day
     AND (d.valid_to IS NULL OR l.ship_day < d.valid_to)
GROUP BY d.sku, d.valid_from""",
    "product_days",
)
def version_lines(t: Source) -> DataFrame:
    """The same lookup laid out by key and time, counted by version."""
    dim = _dim(t).withColumn("since", F.col("valid_from"))
    found = as_of_join(_lines(t), dim, "sku", "ship_day", "valid_from", ["since"], "valid_to", broadcast_bytes=0)
    return (
        found.where("since IS NOT NULL")
        .groupBy("sku", F.col("since").alias("valid_from"))
        .agg(F.count(F.lit(1)).alias("lines"), F.min("ship_day").alias("first_day"))
    )


@query(
    """
SELECT e.event_id, e.event_type, r.value AS rate
FROM events e ASOF LEFT JOIN (SELECT event_type, ts, value FROM events WHERE event_id % 50 = 0) r
     ON e.event_type = r.event_type AND e.ts >= r.ts"""
)
def event_rates(t: Source) -> DataFrame:
    """The last rate of an event's type: five keys hold all rows, so they are cut by time."""
    events = t.events.select("event_id", "event_type", "ts")
    rates = t.events.where("event_id % 50 = 0").select("event_type", F.col("ts").alias("since"), F.col("value").alias("rate"))
    return as_of_join(events, rates, "event_type", "ts", "since", ["rate"], broadcast_bytes=0).select(
        "event_id", "event_type", "rate"
    )


# stock of a product: deliveries that its size sets, then what order lines take or bring back
_MOVES = """
SELECT 'SKU-' || CAST(p_partkey AS STRING) AS sku, CAST(DATE '1995-01-01' AS DATE) AS day, CAST(-1 AS BIGINT) AS order_key,
       0 AS line, CAST(p_size * 12 AS BIGINT) AS quantity
FROM {part}
UNION ALL
SELECT 'SKU-' || CAST(l_partkey AS STRING), CAST(l_shipdate AS DATE), l_orderkey, l_linenumber,
       CAST(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE -l_quantity END AS BIGINT)
FROM {lineitem}"""


def _moves(t: Source) -> DataFrame:
    return t.spark.sql(_MOVES, part=t.part, lineitem=t.lineitem)


_MOVES_SQL = _MOVES.format(part="part", lineitem="lineitem")


@query(
    f"""
WITH moves AS ({_MOVES_SQL}),
rows AS (SELECT *, CAST(sum(quantity) OVER (PARTITION BY sku ORDER BY day, order_key, line, quantity) AS BIGINT) AS balance
         FROM (SELECT sku, day, order_key, line, sum(quantity) AS quantity FROM moves GROUP BY ALL))
SELECT sku, day, order_key, line, balance, balance < 0 AND quantity < 0 AS anomaly_flag,
       CASE WHEN balance < 0 AND quantity < 0 THEN 'OVERSELL' END AS anomaly_reason_code,
       CASE WHEN balance < 0 AND quantity < 0 THEN 'FLAGGED_ANOMALY' ELSE 'CLEAN' END AS data_quality_status,
       CASE WHEN balance < 0 AND quantity < 0 THEN 'ESTIMATED' ELSE 'CONFIRMED' END AS metric_certainty_level
FROM rows"""
)
def oversell(t: Source) -> DataFrame:
    """Stock after every movement of a product; sales below zero are flagged."""
    moves = _moves(t).groupBy("sku", "day", "order_key", "line").agg(F.sum("quantity").alias("quantity"))
    balances = running_balance(moves, ["sku"], ["day", "order_key", "line"], "quantity")
    return flag_all(add_anomaly_columns(balances), [oversell_rule()]).drop("quantity")


@query(
    f"""
WITH moves AS ({_MOVES_SQL}),
rows AS (SELECT day, order_key, line, quantity,
                CAST(sum(quantity) OVER (ORDER BY day, order_key, line, sku ROWS UNBOUNDED PRECEDING) AS BIGINT) AS balance
         FROM moves)
SELECT day, count(*) AS movements, min(balance) AS lowest, max(balance) AS highest FROM rows GROUP BY day"""
)
def warehouse_balance(t: Source) -> DataFrame:
    """All movements as one key: the balance of the whole warehouse, by day."""
    moves = _moves(t).withColumn("place", F.lit("all"))
    rows = running_balance(moves, ["place"], ["day", "order_key", "line", "sku"], "quantity")
    return rows.groupBy("day").agg(
        F.count(F.lit(1)).alias("movements"), F.min("balance").alias("lowest"), F.max("balance").alias("highest")
    )
