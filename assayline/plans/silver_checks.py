"""Silver quality suite: each check is a DataFrame, the suite one summary row.

Shapes follow the checks' purpose: completeness, grain and registry checks
return rows only where something is wrong; foreign-key and range checks always
return their one count row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline.operators.aggregates import distribution
from assayline.operators.joins import lookup_join
from assayline.registry import REASON_CODES, WINDOW_END, WINDOW_START


def union_checks(checks: Sequence[DataFrame]) -> DataFrame:
    """One check over many tables, or many checks of one shape, as one frame."""
    return reduce(DataFrame.unionByName, checks)


def check_completeness(df: DataFrame, table: str) -> DataFrame:
    """NULLs in flag, status or certainty. The reason may be NULL."""
    counts = {
        "null_anomaly_flag": "anomaly_flag",
        "null_status": "data_quality_status",
        "null_certainty": "metric_certainty_level",
    }
    return (
        df.agg(
            F.count(F.lit(1)).alias("total_rows"),
            *[F.count_if(F.col(c).isNull()).alias(name) for name, c in counts.items()],
        )
        .where(" OR ".join(f"{name} > 0" for name in counts))
        .select(F.lit(table).alias("silver_table"), "total_rows", *counts)
    )


def status_distribution(df: DataFrame, table: str) -> DataFrame:
    """Rows per quality status, most frequent first."""
    return (
        distribution(df, "data_quality_status")
        .select(F.lit(table).alias("silver_table"), "data_quality_status", "row_count")
        .orderBy(F.desc("row_count"))
    )


def reason_distribution(df: DataFrame, table: str) -> DataFrame:
    """Flagged rows per reason text, most frequent first."""
    return (
        distribution(df.where("anomaly_flag"), "anomaly_reason_code")
        .select(F.lit(table).alias("silver_table"), "anomaly_reason_code", "row_count")
        .orderBy(F.desc("row_count"))
    )


def unregistered_codes(
    df: DataFrame, table: str, registered: Sequence[str] = REASON_CODES
) -> DataFrame:
    """Reason codes in use that are not registered, with their rows.

    Rows are counted per reason text first; only the distinct texts are split.
    """
    texts = distribution(df.where("anomaly_reason_code IS NOT NULL"), "anomaly_reason_code", name="n")
    return (
        texts.select(F.explode(F.split("anomaly_reason_code", ",")).alias("raw_code"), "n")
        .withColumn("raw_code", F.trim("raw_code"))
        .where(~F.col("raw_code").isin(*registered))
        .groupBy("raw_code")
        .agg(F.sum("n").alias("row_count"))
        .select(F.lit(table).alias("silver_table"), "raw_code", "row_count")
    )


def check_fk(
    child: DataFrame,
    fk: str,
    parent: DataFrame,
    pk: str,
    name: str,
    ignore_null_fk: bool = True,
) -> DataFrame:
    """Child rows whose key the parent lacks, as one count.

    Child rows are counted per key before they meet the parent, so a key (or
    NULL) on a third of the rows is one row there. The count and the anti join
    share one partitioning by key.
    """
    rows = child.where(F.col(fk).isNotNull()) if ignore_null_fk else child
    per_key = rows.groupBy(F.col(fk).alias("__key")).agg(F.count(F.lit(1)).alias("__rows"))
    return (
        per_key.join(parent.select(F.col(pk).alias("__key")), "__key", "left_anti")
        .agg(F.ifnull(F.sum("__rows"), F.lit(0)).alias("orphan_count"))
        .select(F.lit(name).alias("fk_check"), "orphan_count")
    )


def check_grain(df: DataFrame, table: str, *keys: str) -> DataFrame:
    """One row if the keys do not tell all rows apart.

    A key with a NULL part has no value, so it counts as a violation. Rows are
    counted per key map-side, and two sums over that give both totals.
    """
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .agg(
            F.ifnull(F.sum("__rows"), F.lit(0)).alias("total"),
            F.count_if(complete).alias("distinct_keys"),
        )
        .where("total != distinct_keys")
        .select(F.lit(table).alias("silver_table"), "total", "distinct_keys")
    )


def outside_window(col: str, start: str = WINDOW_START, end: str = WINDOW_END) -> Column:
    """A date before ``start`` or after ``end``; a NULL is neither."""
    day = F.col(col).cast("date")
    return (day < F.lit(start).cast("date")) | (day > F.lit(end).cast("date"))


def has_unregistered_code(
    col: str = "anomaly_reason_code", registered: Sequence[str] = REASON_CODES
) -> Column:
    """A reason text with at least one code that is not registered."""
    return F.exists(F.split(col, ","), lambda code: ~F.trim(code).isin(*registered))


def check_date_window(
    df: DataFrame, col: str, name: str, start: str = WINDOW_START, end: str = WINDOW_END
) -> DataFrame:
    """Dates outside [start, end], with their extremes. Times are cut off first."""
    day = F.col(col).cast("date")
    return (
        df.where(outside_window(col, start, end))
        .agg(
            F.count(F.lit(1)).alias("violations"),
            F.min(day).alias("min_date"),
            F.max(day).alias("max_date"),
        )
        .select(F.lit(name).alias("check_name"), "violations", "min_date", "max_date")
    )


def count_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows violating each named condition, all counted in one pass."""
    counted = df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("check_name"), F.col(f"`{n}`").alias("violations"))
                    for n in rules
                ]
            )
        )
    )


def outside_range(col: str, low: float = 0.0, high: float = 1.0) -> Column:
    """Not within [low, high]; a NULL is outside too."""
    return F.ifnull(~F.col(col).between(low, high), F.lit(True))


def check_range(df: DataFrame, col: str, name: str, low: float = 0.0, high: float = 1.0) -> DataFrame:
    return count_violations(df, {name: outside_range(col, low, high)})


def check_catalogue_name(
    pairs: DataFrame, catalogue: DataFrame, name: str = "catalogue name wins"
) -> DataFrame:
    """Matched rows whose name is not the catalogue's name for their SKU.

    Match rows are counted per (SKU, name) before they meet the catalogue.
    """
    named = (
        pairs.where("match_confidence > 0")
        .groupBy("sku", "product_name")
        .agg(F.count(F.lit(1)).alias("__rows"))
    )
    right = catalogue.select("sku", F.col("product_name").alias("__name"))
    return (
        lookup_join(named, right, "sku", "inner", spread_by=["product_name"])
        .where(~F.col("product_name").eqNullSafe(F.col("__name")))
        .agg(F.ifnull(F.sum("__rows"), F.lit(0)).alias("violations"))
        .select(F.lit(name).alias("check_name"), "violations")
    )


# ---- the suite --------------------------------------------------------------

_COUNTERS = ("violations", "orphan_count")


def check_results(checks: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check: its name, number of violations and whether it passed.

    A check with a counter column fails when that is above 0; any other check
    fails when it returns rows. One job evaluates them all.
    """
    parts = []
    for name, check in checks.items():
        counter = next((c for c in _COUNTERS if c in check.columns), None)
        found = F.sum(counter) if counter else F.count(F.lit(1))
        parts.append(
            check.agg(F.ifnull(found, F.lit(0)).alias("violations")).select(
                F.lit(name).alias("check_name"),
                "violations",
                (F.col("violations") == 0).alias("passed"),
            )
        )
    return union_checks(parts)


def run_suite(checks: Mapping[str, DataFrame], suite: str = "silver_quality_check") -> DataFrame:
    """The suite's summary row; its status is computed, not assumed."""
    return check_results(checks).agg(
        F.lit(suite).alias("suite"),
        F.current_timestamp().alias("run_at"),
        F.when(F.bool_and("passed"), "COMPLETE").otherwise("FAILED").alias("status"),
        F.count(F.lit(1)).alias("checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
    )


# ---- all rules of a table in one scan ---------------------------------------


def check_tables(tables: Mapping[str, tuple[DataFrame, Mapping[str, Column]]]) -> DataFrame:
    """One row per table and rule: violations and whether it passed.

    ``tables`` gives each table its frame and its rules (conditions of a violating
    row: completeness, registry, ranges, windows). All rules of a table are counted
    by one aggregate over one scan; grain and foreign keys need a shuffle of their
    own and stay separate checks.
    """
    return union_checks(
        [
            count_violations(df, rules).select(
                F.lit(table).alias("silver_table"),
                "check_name",
                "violations",
                (F.col("violations") == 0).alias("passed"),
            )
            for table, (df, rules) in tables.items()
        ]
    )


def accept(tables: Mapping[str, tuple[DataFrame, Mapping[str, Column]]]) -> DataFrame:
    """The results if every rule of every table holds, else an error that names the broken ones."""
    results = check_tables(tables)
    broken = [f"{r.silver_table}: {r.check_name} ({r.violations})" for r in results.where("NOT passed").collect()]
    if broken:
        raise ValueError("not accepted: " + "; ".join(sorted(broken)))
    return results
