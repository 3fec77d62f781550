"""Small dimension tables: surrogate key first, quality columns last."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from assayline.functions.keys import surrogate_key
from assayline.operators.aggregates import unique_rows
from assayline.operators.quality import Rule, add_anomaly_columns, flag_all, negative_amount_rule
from assayline.sources.tables import empty_table


def build_lookup(
    df: DataFrame,
    natural_key: str,
    surrogate: str,
    columns: Sequence[str | Column],
    rules: Sequence[Rule] = (),
    unique: bool = False,
) -> DataFrame:
    """Key a lookup table on its natural key and give it quality columns.

    With ``unique`` the job that uses the table fails if a natural key is repeated.
    """
    df = unique_rows(df, natural_key) if unique else df
    keyed = df.select(surrogate_key(F.col(natural_key)).alias(surrogate), *columns)
    return flag_all(add_anomaly_columns(keyed), rules)


def build_brands(brands: DataFrame) -> DataFrame:
    columns = ["brand_id", "brand_name", "brand_country", "brand_segment"]
    return build_lookup(brands, "brand_id", "brand_key", columns, unique=True)


def build_categories(categories: DataFrame) -> DataFrame:
    """Categories with the key of their parent; a root has none."""
    parent = F.col("parent_category_id")
    parent_key = F.when(parent.isNotNull(), surrogate_key(parent)).alias("parent_category_key")
    columns = ["category_id", "category_name", "parent_category_id", parent_key, "level"]
    return build_lookup(categories, "category_id", "category_key", columns, unique=True)


def build_condition_codes(codes: DataFrame) -> DataFrame:
    return build_lookup(codes, "code", "condition_code_key", ["code", "description"], unique=True)


def build_loyalty_tiers(tiers: DataFrame) -> DataFrame:
    """All tier columns; a negative earning rate is flagged."""
    rules = [negative_amount_rule("points_per_currency")]
    return build_lookup(tiers, "tier_id", "loyalty_tier_key", tiers.columns, rules, unique=True)


# ---- fixed values: columns of the price-history table
PRICE_HISTORY_SCHEMA = StructType(
    [
        StructField("price_history_key", StringType(), False),
        StructField("history_id", LongType()),
        StructField("sku", StringType()),
        StructField("product_key", StringType()),
        StructField("effective_date", DateType()),
        StructField("rrp", DoubleType()),
        StructField("standard_cost", DoubleType()),
        StructField("change_reason", StringType()),
        StructField("anomaly_flag", BooleanType(), False),
        StructField("anomaly_reason_code", StringType()),
        StructField("data_quality_status", StringType(), False),
        StructField("metric_certainty_level", StringType(), False),
    ]
)


def price_history(spark: SparkSession) -> DataFrame:
    """The price-history table before its first row: typed, empty."""
    return empty_table(spark, PRICE_HISTORY_SCHEMA)
