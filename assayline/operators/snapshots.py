"""Daily snapshots with missing days: where the gaps are, and the rows that fill them.

A key has one row a day, so all rows of a key are at most as many as there are days:
windows over a key are small however large the table is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayline.operators.aggregates import unique_rows
from assayline.operators.quality import Rule, flag_all


def missing_days(snapshots: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Gaps between a key's first and last day: keys, gap_from, gap_to (both missing), n_days.

    Rows without a day are ignored; a NULL key is a key.
    """
    days = snapshots.where(F.col(day).isNotNull()).select(*keys, F.col(day).cast("date").alias("__day")).distinct()
    following = F.lead("__day").over(Window.partitionBy(*keys).orderBy("__day"))
    gap = days.withColumn("__next", following).where(F.col("__next") > F.date_add("__day", 1))
    return gap.select(
        *keys,
        F.date_add("__day", 1).alias("gap_from"),
        F.date_sub("__next", 1).alias("gap_to"),
        (F.date_diff("__next", "__day") - 1).alias("n_days"),
    )


def reconstruct(snapshots: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """``snapshots`` (quality columns, one row per key and day) with a row for every missing day.

    A missing day between a key's first and last has the values of the last one before it,
    ``observed_on`` tells which, and it is flagged as MISSING_SNAPSHOT_DAY and
    RECONSTRUCTED_SNAPSHOT. Repeated days of a key fail the job; rows without a day stay.
    """
    dated = unique_rows(snapshots.where(F.col(day).isNotNull()), *keys, day)
    following = F.lead(day).over(Window.partitionBy(*keys).orderBy(day))
    last = F.ifnull(F.date_sub("__next", 1), F.col("observed_on"))
    filled = (
        dated.withColumn("__next", following)
        .withColumnRenamed(day, "observed_on")
        .withColumn(day, F.explode(F.sequence("observed_on", last)))
        .select(*snapshots.columns, "observed_on")
    )
    undated = snapshots.where(F.col(day).isNull()).withColumn("observed_on", F.col(day))
    made = F.col(day) > F.col("observed_on")
    rules = [
        Rule(made, "MISSING_SNAPSHOT_DAY", "RECONSTRUCTED", "INFERRED"),
        Rule(made, "RECONSTRUCTED_SNAPSHOT", "RECONSTRUCTED", "INFERRED"),
    ]
    return flag_all(filled.unionByName(undated), rules)
