"""Bronze lineage columns and the ingestion log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from assayline.registry import BRONZE_METADATA
from assayline.sources.literals import literal_table
from assayline.sources.scratch import stored

_TABLE, _TIME, _ROW = BRONZE_METADATA


def with_bronze_metadata(
    df: DataFrame,
    source_table: str,
    order_by: Sequence[str] = (),
    ingested_at: Column | None = None,
) -> DataFrame:
    """Add the three lineage columns.

    The row number is unique but has gaps, which needs no shuffle. With
    ``order_by`` it is dense, 1..n in that order (``numbered``).
    """
    rows = numbered(df, order_by, _ROW) if order_by else df.withColumn(
        _ROW, F.monotonically_increasing_id() + 1
    )
    return rows.select(
        *df.columns,
        F.lit(source_table).alias(_TABLE),
        (F.current_timestamp() if ingested_at is None else ingested_at).alias(_TIME),
        _ROW,
    )


def numbered(df: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """Dense row numbers in a total order, without one task seeing all rows.

    Rows are range-partitioned and sorted, with a hash of the whole row behind
    the order columns so that one order value can span partitions. The result
    is stored: ranges come from a sample, so numbering a second evaluation
    could differ. What is summed up in order is one count per partition. Only
    rows alike in every column are bound to stay in one partition.
    """
    tie = F.xxhash64(*df.columns)
    spread = df.withColumn("__tie", tie).repartitionByRange(*order_by, "__tie")
    placed = stored(
        spread.sortWithinPartitions(*order_by, "__tie")
        .drop("__tie")
        .withColumn("__at", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright("__at", 33)
    inside = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    placed = placed.withColumn("__part", part).withColumn("__inside", inside)
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(  # one row per partition
        "__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start")
    )
    return placed.join(F.broadcast(starts), "__part").select(
        *df.columns, (F.col("__start") + F.col("__inside") + 1).alias(name)
    )


def ingestion_log(tables: Mapping[str, DataFrame], ingested_at: Column | None = None) -> DataFrame:
    """One row per table: ``source_table``, ``row_count`` and when it was taken.

    All tables are counted by one aggregate, so there is one shuffle of a few
    partial counts however many tables there are. No column is read.
    """
    spark = next(iter(tables.values())).sparkSession
    zeros = literal_table(spark, [(name, 0) for name in tables], "source_table string, n bigint")
    rows = [
        df.select(F.lit(name).alias("source_table"), F.lit(1).cast("long").alias("n"))
        for name, df in tables.items()
    ]
    when = F.current_timestamp() if ingested_at is None else ingested_at
    return (
        reduce(DataFrame.unionByName, rows, zeros)  # the zeros keep empty tables
        .groupBy("source_table")
        .agg(F.sum("n").alias("row_count"))
        .withColumn(_TIME, when)
    )


def latest_counts(log: DataFrame) -> DataFrame:
    """The newest row count of each table in an append-only log."""
    return log.groupBy("source_table").agg(F.max_by("row_count", _TIME).alias("row_count"))
