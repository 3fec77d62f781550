"""Quality columns and rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.operators.quality import (
    Rule,
    add_anomaly_columns,
    cancelled_with_revenue_rule,
    flag,
    flag_all,
    flag_orphan_fk as orphan_fk,
    negative_amount_rule,
    standardise_date as standardise,
)
from assayline.operators.joins import lookup_join
from assayline.samples.registry import Source, query

QUALITY = ["anomaly_flag", "anomaly_reason_code", "data_quality_status", "metric_certainty_level"]


@query(
    """
SELECT s_suppkey, FALSE AS anomaly_flag, CAST(NULL AS VARCHAR) AS anomaly_reason_code,
       'RECONSTRUCTED' AS data_quality_status, 'INFERRED' AS metric_certainty_level
FROM supplier"""
)
def anomaly_defaults(t: Source) -> DataFrame:
    return add_anomaly_columns(t.supplier.select("s_suppkey"), "RECONSTRUCTED", "INFERRED")


@query(
    """
SELECT c_custkey, c_acctbal < 0 AS anomaly_flag,
       CASE WHEN c_acctbal < 0 THEN 'NEGATIVE_AMOUNT' END AS anomaly_reason_code,
       CASE WHEN c_acctbal < 0 THEN 'FLAGGED_ANOMALY' ELSE 'CLEAN' END AS data_quality_status,
       'CONFIRMED' AS metric_certainty_level
FROM customer"""
)
def flag_single(t: Source) -> DataFrame:
    customers = add_anomaly_columns(t.customer.select("c_custkey", "c_acctbal"))
    return flag(customers, F.col("c_acctbal") < 0, "NEGATIVE_AMOUNT").drop("c_acctbal")


# a: balance under 2000, b: nation under 10, c: name contains 5; in that order
_MERGED = """
SELECT c_custkey, a OR b OR c AS anomaly_flag,
       NULLIF(concat_ws(',', CASE WHEN a THEN 'MISSING_REQUIRED_FIELD' END,
                             CASE WHEN b THEN 'IDENTITY_AMBIGUOUS' END,
                             CASE WHEN c THEN 'EMAIL_MALFORMED' END), '') AS anomaly_reason_code,
       CASE WHEN a THEN 'EXCLUDED_WITH_REASON' WHEN c THEN 'FLAGGED_ANOMALY'
            WHEN b THEN 'FLAGGED_AMBIGUOUS' ELSE 'CLEAN' END AS data_quality_status,
       CASE WHEN b THEN 'UNRELIABLE' WHEN a THEN 'ESTIMATED' ELSE 'CONFIRMED' END AS metric_certainty_level
FROM (SELECT c_custkey, c_acctbal < 2000 AS a, c_nationkey < 10 AS b, contains(c_name, '5') AS c
      FROM customer)"""


def _rules() -> list[Rule]:
    return [
        Rule(
            F.col("c_acctbal") < 2000, "MISSING_REQUIRED_FIELD", "EXCLUDED_WITH_REASON", "ESTIMATED"
        ),
        Rule(F.col("c_nationkey") < 10, "IDENTITY_AMBIGUOUS", "FLAGGED_AMBIGUOUS", "UNRELIABLE"),
        Rule(F.col("c_name").contains("5"), "EMAIL_MALFORMED"),
    ]


@query(_MERGED)
def flag_merge(t: Source) -> DataFrame:
    df = add_anomaly_columns(t.customer)
    for rule in [*_rules(), _rules()[0]]:  # a repeated rule changes nothing
        df = flag(df, rule.condition, rule.reason_code, rule.status, rule.certainty)
    return df.select("c_custkey", *QUALITY)


@query(_MERGED)
def flag_all_rules(t: Source) -> DataFrame:
    return flag_all(add_anomaly_columns(t.customer), _rules()).select("c_custkey", *QUALITY)


@query(
    """
SELECT o_orderkey, coalesce(status = 'P', FALSE) AS anomaly_flag,
       CASE WHEN status = 'P' THEN 'DUPLICATE_CASE' END AS anomaly_reason_code,
       CASE WHEN status = 'P' THEN 'FLAGGED_AMBIGUOUS' ELSE 'CLEAN' END AS data_quality_status,
       CASE WHEN status = 'P' THEN 'ESTIMATED' ELSE 'CONFIRMED' END AS metric_certainty_level
FROM v_order_facts""",
    "order_facts",
)
def flag_null_condition(t: Source) -> DataFrame:
    facts = add_anomaly_columns(t.v("order_facts").select("o_orderkey", "status"))
    rule = F.col("status") == "P"  # NULL where the status is NULL
    return flag(facts, rule, "DUPLICATE_CASE", "FLAGGED_AMBIGUOUS", "ESTIMATED").drop("status")


@query(
    """
SELECT o_orderkey, order_date AS order_date_raw, d AS order_date,
       f AS anomaly_flag, CASE WHEN f THEN 'DATE_PARSE_FAIL' END AS anomaly_reason_code,
       CASE WHEN f THEN 'FLAGGED_ANOMALY' ELSE 'CLEAN' END AS data_quality_status,
       CASE WHEN f THEN 'UNRELIABLE' ELSE 'CONFIRMED' END AS metric_certainty_level
FROM (SELECT *, order_date IS NOT NULL AND d IS NULL AS f
      FROM (SELECT *, CAST(try_strptime(order_date, '%d/%m/%Y') AS DATE) AS d FROM v_raw_dates))""",
    "raw_dates",
)
def standardise_date(t: Source) -> DataFrame:
    return standardise(add_anomaly_columns(t.v("raw_dates")), "order_date", "ddmmyyyy")


@query(
    """
SELECT o_orderkey, buyer_id, c_custkey IS NULL AS anomaly_flag,
       CASE WHEN c_custkey IS NULL THEN 'ORPHAN_FK' END AS anomaly_reason_code,
       CASE WHEN c_custkey IS NULL THEN 'FLAGGED_ANOMALY' ELSE 'CLEAN' END AS data_quality_status,
       CASE WHEN c_custkey IS NULL THEN 'UNRELIABLE' ELSE 'CONFIRMED' END AS metric_certainty_level
FROM v_order_facts LEFT JOIN customer ON c_custkey = buyer_id""",
    "order_facts",
)
def flag_orphan_fk(t: Source) -> DataFrame:
    return orphan_fk(_buyers(t), "found").drop("found")


@query(
    """
SELECT o_orderkey, buyer_id, c_custkey IS NULL AND buyer_id IS NOT NULL AS anomaly_flag
FROM v_order_facts LEFT JOIN customer ON c_custkey = buyer_id""",
    "order_facts",
)
def flag_orphan_fk_given(t: Source) -> DataFrame:
    flagged = orphan_fk(_buyers(t), "found", source_fk="buyer_id")
    return flagged.select("o_orderkey", "buyer_id", "anomaly_flag")


def _buyers(t: Source) -> DataFrame:
    customers = t.customer.select(F.col("c_custkey").alias("buyer_id"), F.lit(True).alias("found"))
    facts = t.v("order_facts").select("o_orderkey", "buyer_id")
    joined = lookup_join(facts, customers, "buyer_id", spread_by=["o_orderkey"])
    return add_anomaly_columns(joined.select("o_orderkey", "buyer_id", "found"))


@query(
    """
SELECT o_orderkey, amount, amount < 0 AS anomaly_flag,
       CASE WHEN amount < 0 THEN 'NEGATIVE_AMOUNT' END AS anomaly_reason_code,
       CASE WHEN amount < 0 THEN 'UNRELIABLE' ELSE 'CONFIRMED' END AS metric_certainty_level
FROM v_order_facts""",
    "order_facts",
)
def negative_amount(t: Source) -> DataFrame:
    facts = add_anomaly_columns(t.v("order_facts").select("o_orderkey", "amount"))
    return flag_all(facts, [negative_amount_rule("amount")]).drop("data_quality_status")


@query(
    """
SELECT o_orderkey, order_state = 'CANCELLED' AND amount > 0 AS anomaly_flag,
       CASE WHEN order_state = 'CANCELLED' AND amount > 0
            THEN 'CANCELLED_WITH_REVENUE' END AS anomaly_reason_code
FROM v_order_facts""",
    "order_facts",
)
def cancelled_with_revenue(t: Source) -> DataFrame:
    facts = add_anomaly_columns(t.v("order_facts").select("o_orderkey", "order_state", "amount"))
    flagged = flag_all(facts, [cancelled_with_revenue_rule("order_state", "amount")])
    return flagged.select("o_orderkey", "anomaly_flag", "anomaly_reason_code")
