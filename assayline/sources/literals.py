"""Literal reference tables with explicit schemas."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from assayline.registry import EXPECTED_BRONZE_ROWS, REASON_CODES, STATUS_MAPPINGS


def literal_table(
    spark: SparkSession, rows: Sequence[Sequence], schema: StructType | str
) -> DataFrame:
    """A few literal rows as a local relation of known size.

    Going through Arrow keeps Catalyst's size estimate (a list of Python rows
    has none, which rules out broadcasting it) and needs no job to load.
    """
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = {f.name: [row[i] for row in rows] for i, f in enumerate(declared.fields)}
    return spark.createDataFrame(pa.table(columns), declared)


def status_mappings(spark: SparkSession) -> DataFrame:
    """The 28 curated status rows, all with confidence 1.0."""
    rows = [(*mapping, 1.0) for mapping in STATUS_MAPPINGS]
    return literal_table(
        spark,
        rows,
        "source_system string, raw_code string, canonical_status string, mapping_confidence double",
    )


def expected_counts(spark: SparkSession) -> DataFrame:
    """Row count each of the 61 Bronze tables must have."""
    schema = "source_table string, expected_rows bigint"
    return literal_table(spark, EXPECTED_BRONZE_ROWS, schema)


def registered_codes(spark: SparkSession) -> DataFrame:
    """The 40 reason codes a Silver table may use."""
    return literal_table(spark, [(code,) for code in REASON_CODES], "code string")
