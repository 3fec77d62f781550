"""Clocks that are off: the median delay of each source against the median of all sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.operators.balances import running_balance
from assayline.operators.joins import lookup_join
from assayline.operators.quality import Rule, flag_all
from assayline.sources.scratch import stored

#: Median absolute deviations beyond which a source counts as off.
DEVIATIONS = 5.0
#: The rank of a sketched median is off by at most rows / ACCURACY.
ACCURACY = 10_000


def medians(rows: DataFrame, keys: Sequence[str], value: str, exact: bool = True, accuracy: int = ACCURACY) -> DataFrame:
    """keys, n and the lower median of ``value`` (NULLs do not count).

    Exact: rows are counted per value first and the counts are summed up in order, a key
    being cut wherever its values are many. Otherwise one sketch a key and task, whose
    rank is off by at most n / ``accuracy``.
    """
    there = rows.where(F.col(value).isNotNull())
    if not exact:
        middle = F.percentile_approx(value, 0.5, accuracy).alias("median")
        return there.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), middle)
    counts = stored(there.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n")), "counts")
    upto = running_balance(counts, keys, [value], "__n", "__upto")
    total = counts.groupBy(*keys).agg(F.sum("__n").alias("n"))
    # the totals are one row a key; the smallest value that reaches half of them is the median
    met = lookup_join(upto, total, list(keys), "inner") if keys else upto
    return met.where(2 * F.col("__upto") >= F.col("n")).groupBy(*keys, "n").agg(F.min(value).alias("median"))


def clock_drift(
    rows: DataFrame,
    source: str,
    delay: str,
    deviations: float = DEVIATIONS,
    least: float = 0.0,
    exact: bool = True,
) -> DataFrame:
    """One row per source: n, median, overall (median of all medians), mad, offset, drifts.

    A source drifts if its median is further from the overall one than ``deviations``
    median absolute deviations, and than ``least`` (in units of ``delay``), which keeps a
    spread of nothing from flagging everything.
    """
    each = stored(medians(rows, [source], delay, exact), "medians").withColumn("__all", F.lit(1))
    overall = medians(each, ["__all"], "median").select("__all", F.col("median").alias("overall"))
    # one row; read as a number so that it is no join
    middle = overall.first()
    middle = F.lit(middle["overall"] if middle else None)
    away = each.withColumn("overall", middle.cast(each.schema["median"].dataType)).withColumn(
        "offset", F.col("median") - F.col("overall")
    )
    spread = medians(away.withColumn("__away", F.abs("offset")), ["__all"], "__away").first()
    mad = F.lit(spread["median"] if spread else None).cast(each.schema["median"].dataType)
    far = F.abs("offset")
    return away.withColumn("mad", mad).select(
        source, "n", "median", "overall", "mad", "offset", ((far > deviations * F.col("mad")) & (far > least)).alias("drifts")
    )


def flag_drift(rows: DataFrame, drift: DataFrame, source: str) -> DataFrame:
    """``rows`` (quality columns) of drifting sources flagged as COURIER_CLOCK_DRIFT, with their clock_offset."""
    off = drift.where("drifts").select(source, F.col("offset").alias("clock_offset"))
    met = lookup_join(rows, off, source)
    return flag_all(met, [Rule(F.col("clock_offset").isNotNull(), "COURIER_CLOCK_DRIFT", certainty="ESTIMATED")])
