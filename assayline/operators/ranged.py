"""Windows over keys of any size: rows are cut by key and order, and what a key carries over a cut is added.

Rows are range-partitioned by the keys and an order, so a key with a third of all rows
spans many partitions. Each partition is worked on alone; only a key that goes on from
one partition into the next needs something from before. There is at most one such key
a partition, so what is carried over is a table of that many rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from assayline.sources.scratch import stored

PART = "__part"


def ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "ranged") -> DataFrame:
    """``df`` with the number of its partition in the order of ``keys`` and ``order``.

    Written once: ranges come from a sample, so a second evaluation could cut elsewhere.
    Rows alike in all of these columns stay in one partition; end ``order`` with a
    column that tells rows apart.
    """
    return stored(df.repartitionByRange(*keys, *order).withColumn(PART, F.spark_partition_id()), name)


def inside(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    """All rows of a key up to this one, within its partition."""
    return Window.partitionBy(PART, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def _met(rows: DataFrame, few: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
    """``rows`` with a broadcast table of a few rows on columns of one name, NULL equal to NULL."""
    few = few.withColumnsRenamed({c: f"__few_{c}" for c in columns})
    same = [F.col(c).eqNullSafe(F.col(f"__few_{c}")) for c in columns]
    return rows.join(F.broadcast(few), reduce(lambda a, b: a & b, same), how).drop(*[f"__few_{c}" for c in columns])


def carried(
    placed: DataFrame,
    keys: Sequence[str],
    in_part: Column,
    combine: Callable[[str], Column],
    name: str,
) -> DataFrame:
    """(part, keys, ``name``): what a key brings from the partitions before, where there is anything.

    ``in_part`` sums up a key within a partition, ``combine`` sums those up in order.
    """
    ends = placed.groupBy(PART).agg(F.min(F.struct(*keys)).alias("first"), F.max(F.struct(*keys)).alias("last"))
    # from here on a few rows a partition
    before = F.lag("last").over(Window.orderBy(PART))
    cut = ends.withColumn("before", before).where(F.col("first").eqNullSafe(F.col("before")))
    cut = cut.select("first.*").distinct()
    parts = _met(placed, cut, keys, "left_semi").groupBy(PART, *keys).agg(in_part.alias(name))
    so_far = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn(name, combine(name).over(so_far)).where(F.col(name).isNotNull())


def with_carried(placed: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``placed`` with the carried column (NULL where a key begins in its partition)."""
    return _met(placed, carry, [PART, *keys], "left")
