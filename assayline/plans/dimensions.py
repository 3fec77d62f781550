"""Gold dimensions: the product history and the static listing conditions; facts keyed by the version of their day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.functions.keys import surrogate_key
from assayline.operators.aggregates import unique_rows
from assayline.operators.asof import as_of_join
from assayline.operators.history import VERSION_KEY, merge_history
from assayline.operators.joins import BROADCAST_BYTES
from assayline.operators.quality import Rule, flag_all

#: Columns whose change makes a new version; other columns of the snapshot follow the open version.
PRODUCT_TRACKED = ("product_name", "category_id", "brand_id", "condition_code", "standard_cost", "rrp", "is_active")
UNKNOWN = "UNKNOWN"


def build_dim_product(
    history: DataFrame | None, products: DataFrame, as_of: str | dt.date, tracked: Sequence[str] = PRODUCT_TRACKED
) -> DataFrame:
    """``dim_product`` after one more product snapshot; a change of a tracked column makes a version."""
    return merge_history(history, products, ["sku"], as_of, [c for c in tracked if c in products.columns])


def build_dim_listing_condition(condition_codes: DataFrame) -> DataFrame:
    """The listing conditions, which do not change, and one member for codes that are not among them."""
    known = unique_rows(condition_codes.select("code", "description"), "code").where("code IS NOT NULL")
    unknown = known.sparkSession.range(1).select(F.lit(UNKNOWN).alias("code"), F.lit("not a registered code").alias("description"))
    return known.where(F.col("code") != UNKNOWN).unionByName(unknown).select(
        surrogate_key(F.col("code")).alias("listing_condition_key"), "code", "description", (F.col("code") != UNKNOWN).alias("is_known")
    )


def key_facts(
    facts: DataFrame,
    dim_product: DataFrame,
    sku: str,
    day: str,
    columns: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Facts with ``product_version_key`` of the version valid on their day, and more of its columns if asked for.

    The facts carry the quality columns; a fact with a SKU but no version on its day is
    an orphan of the dimension.
    """
    versions = dim_product.withColumnsRenamed({"sku": sku, VERSION_KEY: "product_version_key"})
    keyed = as_of_join(
        facts, versions, sku, day, "valid_from", ["product_version_key", *columns], "valid_to", broadcast_bytes
    )
    orphan = F.col("product_version_key").isNull() & F.col(sku).isNotNull()
    return flag_all(keyed, [Rule(orphan, "ORPHAN_FK", certainty="UNRELIABLE")])
