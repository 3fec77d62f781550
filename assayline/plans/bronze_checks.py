"""Bronze reconciliation suite."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.registry import BRONZE_METADATA
from assayline.sources.bronze import ingestion_log, latest_counts
from assayline.sources.literals import literal_table


def bronze_totals(log: DataFrame) -> DataFrame:
    """Total rows and number of tables by the newest log rows.

    Tables whose name starts with an underscore are bookkeeping and left out.
    """
    tables = log.where(~F.col("source_table").startswith("_"))
    return latest_counts(tables).agg(
        F.sum("row_count").alias("total_bronze_rows"), F.count(F.lit(1)).alias("table_count")
    )


def reconcile_counts(log: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected tables whose newest count differs or is missing; empty = pass.

    A missing table shows -1 actual rows while its difference counts from 0.
    Logged tables nobody expects are not reported.
    """
    actual = F.col("row_count")
    return (
        expected.join(latest_counts(log), "source_table", "left")
        .where(actual.isNull() | (actual != F.col("expected_rows")))
        .select(
            "source_table",
            "expected_rows",
            F.ifnull(actual, F.lit(-1).cast("long")).alias("actual_rows"),
            (F.ifnull(actual, F.lit(0).cast("long")) - F.col("expected_rows")).alias("diff"),
            F.when(actual.isNull(), "MISSING_FROM_BRONZE").otherwise("COUNT_MISMATCH").alias("reason"),
        )
        .orderBy("source_table")
    )


def check_build_counts(tables: Mapping[str, DataFrame], expected: DataFrame) -> DataFrame:
    """Built tables whose row count is not the expected one; empty = pass."""
    return reconcile_counts(ingestion_log(tables), expected)


def missing_metadata_columns(
    df: DataFrame, table: str, required: Sequence[str] = BRONZE_METADATA
) -> DataFrame:
    """Lineage columns the table lacks; empty = pass. Reads no rows."""
    held = {c.lower() for c in df.columns}
    missing = [(table, c) for c in required if c.lower() not in held]
    return literal_table(df.sparkSession, missing, "source_table string, column_name string")


def present_metadata_columns(
    df: DataFrame, table: str, required: Sequence[str] = BRONZE_METADATA
) -> DataFrame:
    """Lineage columns the table has, by name; a complete table gives all three."""
    held = {c.lower() for c in df.columns}
    found = sorted((table, c) for c in required if c.lower() in held)
    return literal_table(df.sparkSession, found, "source_table string, column_name string")


def ingestion_runs(df: DataFrame, at: str = "_ingestion_timestamp") -> DataFrame:
    """First and latest ingestion of a table and the number of distinct runs."""
    return df.agg(
        F.min(at).alias("first_run"),
        F.max(at).alias("latest_run"),
        F.count_distinct(at).alias("distinct_runs"),
    )
