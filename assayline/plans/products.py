"""Product dimension: dates, key, three foreign keys, quality columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.functions.dates import parse_iso_date
from assayline.functions.keys import surrogate_key
from assayline.operators.aggregates import unique_rows
from assayline.operators.joins import BROADCAST_BYTES, resolve_fks
from assayline.operators.quality import Rule, add_anomaly_columns, date_parse_rule, flag_all


def build_products(
    products: DataFrame,
    brands: DataFrame,
    categories: DataFrame,
    condition_codes: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """18 product columns plus the quality columns.

    A creation date counts as a parse failure only where a text was there.
    Each input product stays one row; an unknown foreign key stays NULL. A repeated
    SKU or a repeated key of a dimension fails the job instead of multiplying rows.
    """
    dated = add_anomaly_columns(
        unique_rows(products, "sku").withColumns(
            {
                "product_key": surrogate_key(F.col("sku")),
                "__created": parse_iso_date(F.col("created_date")),
                "__updated": parse_iso_date(F.col("last_updated")),
            }
        )
    )
    rules: list[Rule] = [date_parse_rule("__created", "created_date")]
    keyed = resolve_fks(
        flag_all(dated, rules),
        [
            (unique_rows(brands.select("brand_id", "brand_key"), "brand_id"), "brand_id", "brand_id", "brand_key"),
            (
                unique_rows(categories.select("category_id", "category_key"), "category_id"),
                "category_id",
                "category_id",
                "category_key",
            ),
            (
                unique_rows(condition_codes.select("code", "condition_code_key"), "code"),
                "condition_code",
                "code",
                "condition_code_key",
            ),
        ],
        broadcast_bytes,
    )
    # fixed values: the columns of the product table
    return keyed.select(
        "product_key",
        "product_id",
        "sku",
        "product_name",
        "category_id",
        "category_key",
        "brand_id",
        "brand_key",
        "condition_code",
        "condition_code_key",
        "standard_cost",
        "rrp",
        "weight_kg",
        "is_campaign_product",
        "is_active",
        F.col("__created").alias("created_date"),
        F.col("__updated").alias("last_updated"),
        "supplier_code",
        "anomaly_flag",
        "anomaly_reason_code",
        "data_quality_status",
        "metric_certainty_level",
    )
