"""Status mapping, quality suites, Bronze bookkeeping and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.functions import composite_business_key
from assayline.operators import aggregates
from assayline.operators.quality import Rule, add_anomaly_columns, standardise_date
from assayline.plans import bronze_checks as bronze
from assayline.plans import lookups
from assayline.plans import silver_checks as silver
from assayline.plans import status
from assayline.registry import BRONZE_METADATA, EXPECTED_BRONZE_ROWS, REASON_CODES, STATUS_MAPPINGS
from assayline.samples.products import sku_mismatch
from assayline.samples.registry import Source, query
from assayline.sources.bronze import ingestion_log as log_of
from assayline.sources.bronze import with_bronze_metadata
from assayline.sources.literals import expected_counts, literal_table
from assayline.sources.scratch import new_scratch
from assayline.sources.tables import Medallion

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# ---- status mapping ---------------------------------------------------------

_UNMAPPED = """
v_unmapped AS (
  SELECT s.source_system, s.raw_code, 'UNMAPPED' AS canonical_status,
         CAST(0.0 AS DOUBLE) AS mapping_confidence
  FROM v_status_seen s LEFT JOIN v_status_map m
    ON m.source_system = s.source_system AND m.raw_code = s.raw_code
  WHERE m.raw_code IS NULL AND s.raw_code IS NOT NULL)"""


def _seen(t: Source) -> DataFrame:
    return status.statuses_seen(
        [
            ("ORD", t.orders, "o_orderstatus"),
            ("LINE", t.lineitem, "l_linestatus"),
            ("RET", t.lineitem, "l_returnflag"),
            ("EVT", t.events, "event_type"),
        ]
    )


@query("SELECT source_system, raw_code FROM v_status_seen WHERE raw_code IS NOT NULL", "status_seen")
def status_seen(t: Source) -> DataFrame:
    return _seen(t)


@query(f"WITH {_UNMAPPED} SELECT * FROM v_unmapped", "status_seen", "status_map")
def status_unmapped(t: Source) -> DataFrame:
    return status.unmapped_statuses(t.v("status_map"), _seen(t))


@query(
    f"""WITH {_UNMAPPED},
v_all AS (SELECT * FROM v_status_map UNION ALL SELECT * FROM v_unmapped)
SELECT *, canonical_status = 'UNMAPPED' AS anomaly_flag,
       CASE WHEN canonical_status = 'UNMAPPED' THEN 'STATUS_UNMAPPED' END AS anomaly_reason_code,
       CASE WHEN canonical_status = 'UNMAPPED' THEN 'FLAGGED_ANOMALY' ELSE 'CLEAN' END AS data_quality_status,
       CASE WHEN canonical_status = 'UNMAPPED' THEN 'UNRELIABLE' ELSE 'CONFIRMED' END AS metric_certainty_level
FROM v_all""",
    "status_seen",
    "status_map",
)
def status_mapping(t: Source) -> DataFrame:
    return status.status_code_mapping(t.v("status_map"), _seen(t))


_CURATED = ", ".join(str(row) for row in STATUS_MAPPINGS)


@query(
    f"""WITH v_curated AS (
  SELECT source_system, raw_code, canonical_status FROM (VALUES {_CURATED})
    AS c(source_system, raw_code, canonical_status)),
v_used AS (SELECT 'EC' AS source_system, CASE event_type WHEN 'purchase' THEN 'confirmed'
             WHEN 'view' THEN 'pending' ELSE event_type END AS raw_code FROM events)
SELECT source_system, raw_code, canonical_status, CAST(1.0 AS DOUBLE) AS mapping_confidence,
       (SELECT min(upper(event_type)) FROM events
        WHERE source_system = 'EC' AND raw_code = CASE event_type WHEN 'purchase' THEN 'confirmed'
             WHEN 'view' THEN 'pending' ELSE event_type END) AS raw_description,
       FALSE AS anomaly_flag, CAST(NULL AS VARCHAR) AS anomaly_reason_code,
       'CLEAN' AS data_quality_status, 'CONFIRMED' AS metric_certainty_level
FROM v_curated
UNION ALL
SELECT source_system, raw_code, 'UNMAPPED', 0.0, upper(raw_code), TRUE, 'STATUS_UNMAPPED',
       'FLAGGED_ANOMALY', 'UNRELIABLE'
FROM (SELECT DISTINCT * FROM v_used) u
WHERE NOT EXISTS (SELECT 1 FROM v_curated c
                  WHERE c.source_system = u.source_system AND c.raw_code = u.raw_code)"""
)
def status_seed(t: Source) -> DataFrame:
    event = F.col("event_type")
    code = F.when(event == "purchase", "confirmed").when(event == "view", "pending").otherwise(event)
    used = t.events.select(code.alias("status_code"), event)
    described = used.groupBy("status_code").agg(F.min(F.upper("event_type")).alias("description"))
    return status.seed_status_mapping(
        t.spark, [("EC", used, "status_code")], lookups={"EC": described}
    )


@query(
    """
SELECT o_orderkey, status, coalesce(canonical_status, 'UNMAPPED') AS canonical_status,
       canonical_status IS NULL AS anomaly_flag,
       CASE WHEN canonical_status IS NULL THEN 'STATUS_UNMAPPED' END AS anomaly_reason_code
FROM v_order_facts LEFT JOIN v_status_map ON source_system = 'ORD' AND raw_code = status""",
    "order_facts",
    "status_map",
)
def apply_status_mapping(t: Source) -> DataFrame:
    facts = add_anomaly_columns(t.v("order_facts").select("o_orderkey", "status"))
    mapped = status.apply_status_mapping(facts, t.v("status_map"), "ORD", "status")
    return mapped.select(
        "o_orderkey", "status", "canonical_status", "anomaly_flag", "anomaly_reason_code"
    )


# ---- Silver suite -----------------------------------------------------------


@query(
    """
SELECT 'silver_orders' AS silver_table, count(*) AS total_rows,
       count(*) FILTER (WHERE anomaly_flag IS NULL) AS null_anomaly_flag,
       count(*) FILTER (WHERE data_quality_status IS NULL) AS null_status,
       count(*) FILTER (WHERE metric_certainty_level IS NULL) AS null_certainty
FROM v_bad_reasons""",
    "bad_reasons",
)
def completeness(t: Source) -> DataFrame:
    return silver.union_checks(
        [
            silver.check_completeness(t.v("bad_reasons"), "silver_orders"),
            silver.check_completeness(add_anomaly_columns(t.customer), "silver_customers"),
        ]
    )


@query(
    """
SELECT 'silver_orders' AS silver_table, data_quality_status, count(*) AS row_count
FROM v_bad_reasons GROUP BY data_quality_status""",
    "bad_reasons",
)
def status_distribution(t: Source) -> DataFrame:
    return silver.status_distribution(t.v("bad_reasons"), "silver_orders")


@query(
    """
SELECT 'silver_orders' AS silver_table, 'DATE_PARSE_FAIL' AS anomaly_reason_code,
       count(*) AS row_count
FROM v_raw_dates
WHERE order_date IS NOT NULL AND try_strptime(order_date, '%d/%m/%Y') IS NULL""",
    "raw_dates",
)
def reason_distribution(t: Source) -> DataFrame:
    dated = standardise_date(add_anomaly_columns(t.v("raw_dates")), "order_date", "ddmmyyyy")
    return silver.reason_distribution(dated, "silver_orders")


_REGISTERED = ", ".join(f"('{code}')" for code in REASON_CODES)


@query(
    f"""
SELECT 'silver_orders' AS silver_table, raw_code, count(*) AS row_count
FROM (SELECT trim(unnest(string_split(anomaly_reason_code, ','))) AS raw_code FROM v_bad_reasons)
WHERE raw_code NOT IN (SELECT code FROM (VALUES {_REGISTERED}) AS r(code))
GROUP BY raw_code""",
    "bad_reasons",
)
def unregistered_codes(t: Source) -> DataFrame:
    return silver.unregistered_codes(t.v("bad_reasons"), "silver_orders")


@query(
    """
SELECT 'orders.buyer_id' AS fk_check, count(*) AS orphan_count
FROM v_order_facts LEFT JOIN customer ON c_custkey = buyer_id WHERE c_custkey IS NULL""",
    "order_facts",
)
def fk_integrity(t: Source) -> DataFrame:
    return silver.check_fk(
        t.v("order_facts"), "buyer_id", t.customer, "c_custkey", "orders.buyer_id", False
    )


@query(
    """
SELECT 'orders.buyer_id' AS fk_check, count(*) AS orphan_count
FROM v_order_facts LEFT JOIN customer ON c_custkey = buyer_id
WHERE c_custkey IS NULL AND buyer_id IS NOT NULL""",
    "order_facts",
)
def fk_integrity_ignore_null(t: Source) -> DataFrame:
    return silver.check_fk(
        t.v("order_facts"), "buyer_id", t.customer, "c_custkey", "orders.buyer_id"
    )


@query(
    """
SELECT 'order_facts' AS silver_table, count(*) AS total, count(DISTINCT buyer_id) AS distinct_keys
FROM v_order_facts HAVING count(*) <> count(DISTINCT buyer_id)""",
    "order_facts",
)
def grain_single(t: Source) -> DataFrame:
    return silver.check_grain(t.v("order_facts"), "order_facts", "buyer_id")


@query(
    """
SELECT 'lineitem' AS silver_table, count(*) AS total,
       count(DISTINCT l_orderkey || '|' || l_linenumber) AS distinct_keys
FROM lineitem HAVING count(*) <> count(DISTINCT l_orderkey || '|' || l_linenumber)"""
)
def grain_composite(t: Source) -> DataFrame:
    return silver.check_grain(t.lineitem, "lineitem", "l_orderkey", "l_linenumber")


@query(
    """
SELECT 'orders.order_date' AS check_name, count(*) AS violations,
       min(order_date) AS min_date, max(order_date) AS max_date
FROM v_order_facts WHERE order_date < DATE '1996-03-01' OR order_date > DATE '1998-09-14'
UNION ALL
SELECT 'events.ts', count(*), CAST(min(ts) AS DATE), CAST(max(ts) AS DATE)
FROM events WHERE CAST(ts AS DATE) < DATE '2024-03-01' OR CAST(ts AS DATE) > DATE '2024-09-14'""",
    "order_facts",
)
def date_window(t: Source) -> DataFrame:
    return silver.union_checks(
        [
            silver.check_date_window(
                t.v("order_facts"), "order_date", "orders.order_date", "1996-03-01", "1998-09-14"
            ),
            silver.check_date_window(t.events, "ts", "events.ts"),
        ]
    )


@query(
    """
SELECT 'events.value' AS check_name, count(*) AS violations
FROM events WHERE value IS NULL OR value NOT BETWEEN 0 AND 20"""
)
def range_check(t: Source) -> DataFrame:
    return silver.check_range(t.events, "value", "events.value", 0, 20)


@query(
    """
SELECT 'amount' AS check_name, count(*) FILTER (WHERE amount < 0) AS violations FROM v_order_facts
UNION ALL SELECT 'buyer', count(*) FILTER (WHERE buyer_id IS NULL) FROM v_order_facts
UNION ALL SELECT 'status', count(*) FILTER (WHERE status = 'P') FROM v_order_facts""",
    "order_facts",
)
def violations_in_one_pass(t: Source) -> DataFrame:
    return silver.count_violations(
        t.v("order_facts"),
        {
            "amount": F.col("amount") < 0,
            "buyer": F.col("buyer_id").isNull(),
            "status": F.col("status") == "P",
        },
    )


@query(
    """
WITH v_pairs AS (SELECT listing_id FROM v_listings JOIN v_catalogue ON sku = sku_ref)
SELECT 'catalogue name wins' AS check_name, CAST(0 AS BIGINT) * count(*) AS violations FROM v_pairs
UNION ALL
SELECT 'with changed names', count(*) FILTER (WHERE listing_id % 10 = 3) FROM v_pairs""",
    "catalogue",
    "listings",
)
def catalogue_name(t: Source) -> DataFrame:
    """On the match table, where every name is the catalogue's, and on a copy with some names changed."""
    catalogue = t.v("catalogue")
    pairs = sku_mismatch(t)
    changed = pairs.withColumn(
        "product_name",
        F.when(F.col("match_source_listing_id") % 10 == 3, F.concat("product_name", F.lit(" x"))).otherwise(
            F.col("product_name")
        ),
    )
    return silver.union_checks(
        [
            silver.check_catalogue_name(pairs, catalogue),
            silver.check_catalogue_name(changed, catalogue, "with changed names"),
        ]
    )


_SUITE = """
v AS (
  SELECT 'amounts' AS check_name, count(*) FILTER (WHERE amount IS NULL OR amount < 0 OR amount > 1e9) AS violations
  FROM v_order_facts
  UNION ALL
  SELECT 'buyers', count(*) FILTER (WHERE c_custkey IS NULL AND buyer_id IS NOT NULL)
  FROM v_order_facts LEFT JOIN customer ON c_custkey = buyer_id
  UNION ALL
  SELECT 'grain', count(*) FROM (SELECT 1 FROM v_order_facts HAVING count(*) <> count(DISTINCT o_orderkey)))"""


@query(
    f"""
WITH {_SUITE}
SELECT check_name, violations, violations = 0 AS passed FROM v""",
    "order_facts",
)
def suite_results(t: Source) -> DataFrame:
    return silver.check_results(_suite(t))


@query(
    f"""
WITH {_SUITE}
SELECT 'silver_quality_check' AS suite,
       CASE WHEN bool_and(violations = 0) THEN 'COMPLETE' ELSE 'FAILED' END AS status,
       count(*) AS checks, count(*) FILTER (WHERE violations > 0) AS failed_checks FROM v""",
    "order_facts",
)
def suite_summary(t: Source) -> DataFrame:
    return silver.run_suite(_suite(t)).drop("run_at")


def _suite(t: Source) -> dict[str, DataFrame]:
    facts = t.v("order_facts")
    return {
        "amounts": silver.check_range(facts, "amount", "amounts", 0, 1e9),
        "buyers": silver.check_fk(facts, "buyer_id", t.customer, "c_custkey", "buyers"),
        "grain": silver.check_grain(facts, "order_facts", "o_orderkey"),
    }


@query(
    """
WITH v AS (
  SELECT 'reasons' AS silver_table, unnest(['flag is filled', 'status is filled', 'codes are registered']) AS check_name,
         unnest([count(*) FILTER (WHERE anomaly_flag IS NULL), count(*) FILTER (WHERE data_quality_status IS NULL),
                 count(*) FILTER (WHERE contains(anomaly_reason_code, 'FOO') OR contains(anomaly_reason_code, 'BAR'))]) AS violations
  FROM v_bad_reasons
  UNION ALL
  SELECT 'orders', unnest(['amount in range', 'date in window', 'buyer is filled']),
         unnest([count(*) FILTER (WHERE amount IS NULL OR amount < 0 OR amount > 1e9),
                 count(*) FILTER (WHERE order_date < DATE '1995-01-01' OR order_date > DATE '1997-12-31'),
                 count(*) FILTER (WHERE buyer_id IS NULL)])
  FROM v_order_facts
  UNION ALL
  SELECT 'lines', 'quantity in range', count(*) FILTER (WHERE l_quantity IS NULL OR l_quantity < 1 OR l_quantity > 45) FROM lineitem)
SELECT *, violations = 0 AS passed FROM v""",
    "bad_reasons",
    "order_facts",
)
def suite_by_table(t: Source) -> DataFrame:
    """Fused checks of three tables: one scan and one aggregate each."""
    return silver.check_tables(_table_rules(t))


def _table_rules(t: Source) -> dict[str, tuple[DataFrame, dict]]:
    return {
        "reasons": (
            t.v("bad_reasons"),
            {
                "flag is filled": F.col("anomaly_flag").isNull(),
                "status is filled": F.col("data_quality_status").isNull(),
                "codes are registered": silver.has_unregistered_code(),
            },
        ),
        "orders": (
            t.v("order_facts"),
            {
                "amount in range": silver.outside_range("amount", 0, 1e9),
                "date in window": silver.outside_window("order_date", "1995-01-01", "1997-12-31"),
                "buyer is filled": F.col("buyer_id").isNull(),
            },
        ),
        "lines": (t.lineitem, {"quantity in range": silver.outside_range("l_quantity", 1, 45)}),
    }


# ---- Bronze suite -----------------------------------------------------------

_COUNTS = " UNION ALL ".join(
    f"SELECT '{table}' AS source_table, count(*) AS row_count FROM {table}" for table in TABLES
)


def _log(t: Source) -> DataFrame:
    """A log of two runs: an older, wrong one (one row short) and the current one."""
    counted = log_of({table: getattr(t, table) for table in TABLES} | {"_ingestion_log": t.region})
    current = F.struct(F.lit("2024-05-11").cast("timestamp").alias("at"), F.lit(0).alias("short"))
    older = F.struct(F.lit("2024-05-10").cast("timestamp").alias("at"), F.lit(1).alias("short"))
    own = F.col("source_table") == "_ingestion_log"
    runs = counted.withColumn("run", F.explode(F.when(own, F.array(current)).otherwise(F.array(older, current))))
    return runs.select(
        "source_table", (F.col("row_count") - F.col("run.short")).alias("row_count"), F.col("run.at").alias("_ingestion_timestamp")
    )


@query(_COUNTS)
def ingestion_log(t: Source) -> DataFrame:
    return log_of({table: getattr(t, table) for table in TABLES}).drop("_ingestion_timestamp")


@query(
    f"""
SELECT CAST(sum(row_count) AS BIGINT) AS total_bronze_rows, count(*) AS table_count
FROM ({_COUNTS})"""
)
def bronze_totals(t: Source) -> DataFrame:
    return bronze.bronze_totals(_log(t))


_EXPECTED = ", ".join(str(row) for row in EXPECTED_BRONZE_ROWS)


@query(
    f"""
WITH expected AS (
  SELECT source_table, expected_rows FROM (VALUES {_EXPECTED}) AS e(source_table, expected_rows)
  UNION ALL VALUES ('region', 5), ('nation', 26), ('orders', 15000)),
log AS ({_COUNTS})
SELECT source_table, CAST(expected_rows AS BIGINT) AS expected_rows,
       coalesce(row_count, -1) AS actual_rows,
       coalesce(row_count, 0) - CAST(expected_rows AS BIGINT) AS diff,
       CASE WHEN row_count IS NULL THEN 'MISSING_FROM_BRONZE' ELSE 'COUNT_MISMATCH' END AS reason
FROM expected LEFT JOIN log USING (source_table)
WHERE row_count IS NULL OR row_count <> expected_rows"""
)
def reconcile_counts(t: Source) -> DataFrame:
    own = literal_table(
        t.spark,
        [("region", 5), ("nation", 26), ("orders", 15000)],
        "source_table string, expected_rows bigint",
    )
    return bronze.reconcile_counts(_log(t), expected_counts(t.spark).unionByName(own))


@query(
    """
WITH v AS (
  SELECT 'silver_customers' AS source_table, CAST(2501 AS BIGINT) AS expected_rows, count(*) AS actual_rows FROM customer
  UNION ALL SELECT 'silver_nations', 25, count(*) FROM nation)
SELECT *, actual_rows - expected_rows AS diff, 'COUNT_MISMATCH' AS reason FROM v WHERE actual_rows <> expected_rows"""
)
def build_counts(t: Source) -> DataFrame:
    built = {
        "silver_customers": lookups.build_lookup(t.customer, "c_custkey", "customer_key", ["c_name"]),
        "silver_nations": lookups.build_lookup(t.nation, "n_nationkey", "nation_key", ["n_name"]),
    }
    expected = literal_table(
        t.spark,
        [("silver_customers", 2501), ("silver_nations", 25)],
        "source_table string, expected_rows bigint",
    )
    return bronze.check_build_counts(built, expected)


@query(
    """
SELECT s_suppkey, 'supplier' AS _source_table,
       row_number() OVER (ORDER BY s_acctbal, s_suppkey) AS _source_row_number
FROM supplier"""
)
def bronze_row_numbers(t: Source) -> DataFrame:
    rows = with_bronze_metadata(t.supplier, "supplier", order_by=["s_acctbal", "s_suppkey"])
    return rows.select("s_suppkey", "_source_table", "_source_row_number")


@query(
    """
SELECT count(*) AS total_rows, count(*) AS distinct_numbers, 'orders' AS source_table FROM orders"""
)
def bronze_row_ids(t: Source) -> DataFrame:
    return with_bronze_metadata(t.orders, "orders").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("_source_row_number").alias("distinct_numbers"),
        F.max("_source_table").alias("source_table"),
    )


@query(
    """
WITH v_required AS (
  SELECT unnest(['_ingestion_timestamp', '_source_row_number', '_source_table']) AS column_name)
SELECT 'orders' AS source_table, column_name, 'present' AS state, (SELECT count(o_orderkey) FROM orders) AS filled_rows
FROM v_required
UNION ALL
SELECT 'customer', column_name, 'missing', 0 FROM v_required r
WHERE NOT EXISTS (SELECT 1 FROM duckdb_columns() c WHERE c.table_name = 'customer' AND c.column_name = r.column_name)"""
)
def metadata_columns(t: Source) -> DataFrame:
    """Which lineage columns two tables have, and in how many rows they are filled."""
    complete = with_bronze_metadata(t.orders, "orders")
    present = bronze.present_metadata_columns(complete, "orders")
    missing = bronze.missing_metadata_columns(t.customer, "customer")
    columns = [F.struct(F.lit(c).alias("column_name"), F.count(c).alias("n")) for c in BRONZE_METADATA]
    filled = complete.agg(F.array(*columns).alias("counts")).select(F.inline("counts"))
    states = silver.union_checks(
        [present.withColumn("state", F.lit("present")), missing.withColumn("state", F.lit("missing"))]
    )
    filled_rows = F.when(F.col("state") == "present", F.col("n")).otherwise(0).cast("long")
    return states.join(filled, "column_name").select(
        "source_table", "column_name", "state", filled_rows.alias("filled_rows")
    )


@query(
    """
SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_run,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS latest_run,
       count(DISTINCT ts) AS distinct_runs
FROM (SELECT date_trunc('hour', ts) AS ts FROM events)"""
)
def ingestion_runs(t: Source) -> DataFrame:
    batches = t.events.select(F.date_trunc("hour", "ts").alias("_ingestion_timestamp"))
    runs = bronze.ingestion_runs(batches)
    shown = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first_run", "latest_run")}
    return runs.withColumns(shown)


# ---- aggregates and sets ----------------------------------------------------


@query(
    """
SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
)
def duplicate_keys(t: Source) -> DataFrame:
    return aggregates.duplicate_keys(t.lineitem, "l_orderkey", "l_linenumber")


@query(
    """
SELECT l_returnflag, l_linestatus, count(*) AS row_count FROM lineitem
GROUP BY l_returnflag, l_linestatus"""
)
def distribution(t: Source) -> DataFrame:
    return aggregates.distribution(t.lineitem, "l_returnflag", "l_linestatus").orderBy(
        F.desc("row_count"), "l_returnflag"
    )


@query(
    """
SELECT count(DISTINCT CASE WHEN buyer_id IS NOT NULL THEN CAST(buyer_id AS VARCHAR) || '|' || status END)
  AS distinct_keys FROM v_order_facts""",
    "order_facts",
)
def distinct_key_count(t: Source) -> DataFrame:
    return aggregates.distinct_count(t.v("order_facts"), "buyer_id", "status")


@query(
    """
SELECT c_custkey AS party_id, c_mktsegment AS segment, CAST(NULL AS INT) AS nation FROM customer
UNION ALL SELECT s_suppkey, NULL, s_nationkey FROM supplier"""
)
def union_missing_columns(t: Source) -> DataFrame:
    customers = t.customer.select(
        F.col("c_custkey").alias("party_id"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = t.supplier.select(
        F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("party_id")
    )
    return customers.unionByName(suppliers, allowMissingColumns=True)


@query("SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def distinct_rows(t: Source) -> DataFrame:
    return t.customer.select("c_nationkey", "c_mktsegment").distinct()


# ---- sinks ------------------------------------------------------------------


def _layers(t: Source) -> Medallion:
    return Medallion(t.spark, new_scratch(t.spark, "layers"))


@query(
    f"""
SELECT sha256(CAST(s_suppkey AS VARCHAR)) AS supplier_key, s_suppkey, s_name,
       FALSE AS anomaly_flag, CAST(NULL AS VARCHAR) AS anomaly_reason_code,
       'CLEAN' AS data_quality_status, 'CONFIRMED' AS metric_certainty_level,
       (SELECT count(*) FROM supplier) AS written
FROM supplier WHERE s_suppkey >= 4"""
)
def sink_overwrite(t: Source) -> DataFrame:
    layers = _layers(t)
    built = lookups.build_lookup(t.supplier, "s_suppkey", "supplier_key", ["s_suppkey", "s_name"])
    layers.write_silver(built, "Suppliers")
    written = layers.write_and_verify(built, "suppliers")  # a rerun replaces the table
    back = layers.read_silver("suppliers", where="s_suppkey >= 4")
    return back.withColumn("written", F.lit(written).cast("long"))


@query(
    """
SELECT n_name, n_regionkey FROM nation UNION ALL SELECT n_name, n_regionkey FROM nation WHERE n_regionkey < 2"""
)
def sink_append(t: Source) -> DataFrame:
    layers = _layers(t)
    rows = t.nation.select("n_name", "n_regionkey")
    layers.write_gold(rows, "dim_nation", partition_by=["n_regionkey"])
    layers.write_gold(
        rows.where("n_regionkey < 2"), "dim_nation", overwrite=False, partition_by=["n_regionkey"]
    )
    return layers.read_table("dim_nation", "gold")


@query(
    """
SELECT l_returnflag, CAST(year(l_shipdate) AS INT) AS ship_year, count(*) AS row_count,
       count(DISTINCT l_orderkey || '|' || l_linenumber) AS distinct_keys,
       count(*) FILTER (WHERE l_quantity > 45) AS flagged,
       (SELECT count(*) FROM lineitem) AS written
FROM lineitem GROUP BY ALL"""
)
def sink_largest_table(t: Source) -> DataFrame:
    """Build, write and re-read the largest table, as a Silver job would."""
    layers = _layers(t)
    line_id = composite_business_key(F.col("l_orderkey"), F.col("l_linenumber"))
    built = lookups.build_lookup(
        t.lineitem.withColumn("line_id", line_id),
        "line_id",
        "line_key",
        ["l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", F.year("l_shipdate").alias("ship_year")],
        [Rule(F.col("l_quantity") > 45, "OVERSELL")],
    )
    written = layers.write_silver(built, "lines", partition_by=["l_returnflag"])
    return (
        layers.read_silver("lines")
        .groupBy("l_returnflag", "ship_year")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct("line_key").alias("distinct_keys"),
            F.count_if("anomaly_flag").alias("flagged"),
        )
        .withColumn("written", F.lit(written).cast("long"))
    )
