"""Grouping, counting and key summaries.

All are plain aggregates: Spark combines rows map-side, so a key with a third of
the table reaches the shuffle as one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their ``count``."""
    return df.groupBy(*keys).count().where("count > 1")


def distribution(df: DataFrame, *cols: str, name: str = "row_count") -> DataFrame:
    """Rows per combination of columns."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def distinct_count(df: DataFrame, *cols: str, name: str = "distinct_keys") -> DataFrame:
    """Distinct non-NULL key values; a NULL part drops the whole key."""
    return df.agg(F.count_distinct(*map(F.col, cols)).alias(name))


def require_unique(df: DataFrame, *keys: str) -> DataFrame:
    """Return ``df`` if the keys are unique, else raise (brings one row back)."""
    found = duplicate_keys(df, *keys).head(1)
    if found:
        raise ValueError(f"duplicate key {dict(found[0].asDict())}")
    return df


def unique_rows(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` with a guard in its plan: the job that uses it fails on a repeated key.

    One aggregate instead of a job of its own; a NULL counts as a value. Meant for
    dimension tables.
    """
    others = [c for c in df.columns if c not in keys]
    row = F.any_value(F.struct(*(others or [F.lit(0)]))).alias("__row")
    grouped = df.groupBy(*keys).agg(row, F.count(F.lit(1)).alias("__rows"))
    told = F.concat_ws(", ", *[F.ifnull(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    checked = grouped.where(
        F.when(F.col("__rows") == 1, True).otherwise(F.raise_error(F.concat(F.lit("duplicate key "), told)))
    )
    return checked.select(*[c if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])
