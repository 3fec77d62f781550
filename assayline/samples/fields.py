"""Scans, projections, keys and dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.functions import (
    composite_business_key,
    identity_key,
    is_parse_failure,
    parse_date,
    parse_pg_timestamp,
    surrogate_key,
)
from assayline.functions.dates import PARSERS
from assayline.samples.registry import Source, query
from assayline.sources.tables import read_path


@query(
    """
SELECT o_orderkey, o_custkey, o_totalprice AS total_price FROM orders
WHERE o_totalprice > 400000 AND o_orderstatus IN ('O', 'F')"""
)
def scan_project_filter(t: Source) -> DataFrame:
    return read_path(
        t.spark,
        f"{t.sf_dir}/orders.parquet",
        select="o_orderkey, O_CUSTKEY, o_totalprice AS Total_Price",
        where="o_totalprice > 400000 AND o_orderstatus IN ('O', 'F')",
    )


@query(
    """
SELECT c_custkey,
       CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS band,
       c_mktsegment IN ('BUILDING', 'MACHINERY') AS listed,
       contains(c_name, '7') AS has_seven,
       NOT (c_mktsegment LIKE '\\_%' ESCAPE '\\') AS is_public,
       CAST(NULL AS VARCHAR) AS note
FROM customer WHERE c_acctbal IS NOT NULL AND (c_nationkey < 12 OR c_acctbal < 0)"""
)
def conditional_columns(t: Source) -> DataFrame:
    balance = F.col("c_acctbal")
    return t.customer.where(balance.isNotNull() & ((F.col("c_nationkey") < 12) | (balance < 0))).select(
        "c_custkey",
        F.when(balance < 0, "debt").when(balance < 5000, "low").otherwise("high").alias("band"),
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY").alias("listed"),
        F.col("c_name").contains("7").alias("has_seven"),
        (~F.col("c_mktsegment").startswith("_")).alias("is_public"),
        F.lit(None).cast("string").alias("note"),
    )


@query(
    """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20"""
)
def preview_largest_orders(t: Source) -> DataFrame:
    return (
        t.orders.select("o_orderkey", "o_totalprice")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(20)
    )


@query(
    """
SELECT n_nationkey, n_name, sha256(coalesce(CAST(n_name AS VARCHAR), '~NULL~')) AS nation_key
FROM nation"""
)
def surrogate_key_single(t: Source) -> DataFrame:
    return t.nation.select(
        "n_nationkey", "n_name", surrogate_key(F.col("n_name")).alias("nation_key")
    )


@query(
    """
SELECT l_orderkey, l_linenumber,
       sha256(coalesce(CAST(l_orderkey AS VARCHAR), '~NULL~') || '|' ||
              coalesce(CAST(l_linenumber AS VARCHAR), '~NULL~') || '|' ||
              coalesce(CAST(NULLIF(l_suppkey, 7) AS VARCHAR), '~NULL~')) AS line_key
FROM lineitem"""
)
def surrogate_key_composite(t: Source) -> DataFrame:
    supplier = F.nullif(F.col("l_suppkey"), F.lit(7))
    key = surrogate_key(F.col("l_orderkey"), F.col("l_linenumber"), supplier)
    return t.lineitem.select("l_orderkey", "l_linenumber", key.alias("line_key"))


@query(
    """
SELECT n_nationkey,
       coalesce(n_name, '~NULL~') || '|' ||
       coalesce(CAST(NULLIF(n_regionkey, 3) AS VARCHAR), '~NULL~') AS natural_key
FROM nation"""
)
def composite_key_text(t: Source) -> DataFrame:
    region = F.nullif(F.col("n_regionkey"), F.lit(3))
    return t.nation.select(
        "n_nationkey", composite_business_key(F.col("n_name"), region).alias("natural_key")
    )


@query(
    """
SELECT c_custkey,
       CASE WHEN CASE WHEN c_nationkey = 5 THEN NULL WHEN c_acctbal < 0 THEN 0.5 ELSE 0.9 END < 0.70
            THEN sha256('__ANON_BUCKET__')
            ELSE sha256(c_name || '|' || c_mktsegment) END AS customer_master_key
FROM customer"""
)
def anonymous_routing(t: Source) -> DataFrame:
    confidence = F.when(
        F.col("c_nationkey") != 5, F.when(F.col("c_acctbal") < 0, 0.5).otherwise(0.9)
    )
    key = identity_key(confidence, F.col("c_name"), F.col("c_mktsegment"))
    return t.customer.select("c_custkey", key.alias("customer_master_key"))


@query(
    """
SELECT o_orderkey, order_date AS raw,
       CAST(try_strptime(order_date, '%d/%m/%Y') AS DATE) AS parsed
FROM v_raw_dates""",
    "raw_dates",
)
def parse_ddmmyyyy(t: Source) -> DataFrame:
    return _parsed(t, "raw_dates", "o_orderkey", "order_date", "ddmmyyyy")


@query(
    """
SELECT o_orderkey, iso_date AS raw, CAST(try_strptime(iso_date, '%Y-%m-%d') AS DATE) AS parsed
FROM v_date_texts""",
    "date_texts",
)
def parse_iso_date(t: Source) -> DataFrame:
    return _parsed(t, "date_texts", "o_orderkey", "iso_date", "iso_date")


@query(
    """
SELECT o_orderkey, ddmonyyyy AS raw, CAST(try_strptime(ddmonyyyy, '%d-%b-%Y') AS DATE) AS parsed
FROM v_date_texts""",
    "date_texts",
)
def parse_ddmonyyyy(t: Source) -> DataFrame:
    return _parsed(t, "date_texts", "o_orderkey", "ddmonyyyy", "ddmonyyyy")


@query(
    """
SELECT event_id, iso_timestamp AS raw,
       strftime(try_strptime(iso_timestamp, '%Y-%m-%dT%H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed
FROM v_time_texts""",
    "time_texts",
)
def parse_iso_timestamp(t: Source) -> DataFrame:
    return _parsed(t, "time_texts", "event_id", "iso_timestamp", "iso_timestamp")


@query(
    """
SELECT event_id, slash_datetime AS raw,
       strftime(try_strptime(slash_datetime, '%Y/%m/%d %H:%M'), '%Y-%m-%d %H:%M:%S') AS parsed
FROM v_time_texts""",
    "time_texts",
)
def parse_slash_datetime(t: Source) -> DataFrame:
    return _parsed(t, "time_texts", "event_id", "slash_datetime", "slash_datetime")


@query(
    """
SELECT event_id, epoch AS raw, TRY_CAST(epoch AS BIGINT) AS parsed FROM v_time_texts""",
    "time_texts",
)
def parse_unix_epoch(t: Source) -> DataFrame:
    seconds = F.unix_seconds(parse_date(F.col("epoch"), "unix_epoch"))
    return t.v("time_texts").select("event_id", F.col("epoch").alias("raw"), seconds.alias("parsed"))


@query(
    """
SELECT event_id, TRY_CAST(epoch AS BIGINT) AS from_epoch,
       strftime(try_strptime(pg_text, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS from_text
FROM v_time_texts""",
    "time_texts",
)
def parse_pg_time(t: Source) -> DataFrame:
    text = parse_pg_timestamp(F.col("pg_text"), pg_format="string")
    return t.v("time_texts").select(
        "event_id",
        F.unix_seconds(parse_date(F.col("epoch"), "pg_timestamp")).alias("from_epoch"),
        _shown(text).alias("from_text"),
    )


@query(
    """
SELECT o_orderkey,
       order_date IS NOT NULL AND try_strptime(order_date, '%d/%m/%Y') IS NULL AS failed
FROM v_raw_dates""",
    "raw_dates",
)
def parse_failure(t: Source) -> DataFrame:
    raw = F.col("order_date")
    return t.v("raw_dates").select(
        "o_orderkey", is_parse_failure(parse_date(raw, "ddmmyyyy"), raw).alias("failed")
    )


def _shown(timestamp):
    return F.date_format(timestamp, "yyyy-MM-dd HH:mm:ss")


def _parsed(t: Source, view: str, key: str, col: str, hint: str) -> DataFrame:
    parsed = PARSERS[hint](F.col(col))
    shown = parsed if hint in ("ddmmyyyy", "iso_date", "ddmonyyyy") else _shown(parsed)
    return t.v(view).select(key, F.col(col).alias("raw"), shown.alias("parsed"))
