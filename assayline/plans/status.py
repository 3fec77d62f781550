"""Canonical status codes: curated mapping, detection of gaps, use on facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayline.operators.joins import BROADCAST_BYTES, lookup_join
from assayline.operators.quality import Rule, add_anomaly_columns, flag_all
from assayline.registry import STATUS_UNMAPPED
from assayline.sources.literals import status_mappings

PAIR = ["source_system", "raw_code"]


def unmapped_rule(canonical: str = "canonical_status") -> Rule:
    unmapped = F.col(canonical) == STATUS_UNMAPPED
    return Rule(unmapped, "STATUS_UNMAPPED", certainty="UNRELIABLE")


def statuses_seen(sources: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Distinct non-NULL (source_system, raw_code) over (system, table, column) sources.

    Sources of one table (the same plan, also in different objects) are scanned once.
    Pairs are made row by row and reduced to the distinct ones map-side, before
    anything else, so the union handles a few codes per table rather than the tables.
    """
    tables: list[tuple[DataFrame, list[tuple[str, str]]]] = []
    for system, table, column in sources:
        same = (w for t, w in tables if t is table or t.columns == table.columns and t.sameSemantics(table))
        wanted = next(same, None)
        if wanted is None:
            tables.append((table, wanted := []))
        wanted.append((system, column))
    parts = []
    for table, wanted in tables:
        pairs = [
            F.struct(F.lit(system).alias(PAIR[0]), F.col(column).cast("string").alias(PAIR[1]))
            for system, column in wanted
        ]
        parts.append(table.select(F.inline(F.array(*pairs))).distinct())
    return reduce(DataFrame.unionByName, parts).na.drop(subset=[PAIR[1]]).distinct()


def unmapped_statuses(mapping: DataFrame, seen: DataFrame) -> DataFrame:
    """Seen pairs the mapping lacks, as mapping rows with confidence 0.0."""
    return seen.join(mapping, PAIR, "left_anti").select(
        *PAIR,
        F.lit(STATUS_UNMAPPED).alias("canonical_status"),
        F.lit(0.0).alias("mapping_confidence"),
    )


def status_code_mapping(
    mapping: DataFrame, seen: DataFrame, lookups: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Mapped and unmapped pairs with quality columns, the unmapped ones flagged.

    ``lookups`` (system -> table of ``status_code``, ``description``) adds the
    ``raw_description`` of each code that has one.
    """
    rows = mapping.unionByName(unmapped_statuses(mapping, seen), allowMissingColumns=True)
    if lookups:
        described = reduce(
            DataFrame.unionByName,
            [
                table.select(
                    F.lit(system).alias(PAIR[0]),
                    F.col("status_code").cast("string").alias(PAIR[1]),
                    F.col("description").alias("raw_description"),
                )
                for system, table in lookups.items()
            ],
        )
        rows = rows.join(described, PAIR, "left")
    return flag_all(add_anomaly_columns(rows), [unmapped_rule()])


def seed_status_mapping(
    spark: SparkSession,
    sources: Sequence[tuple[str, DataFrame, str]],
    lookups: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """The curated mapping completed with whatever the given sources use."""
    return status_code_mapping(status_mappings(spark), statuses_seen(sources), lookups)


def apply_status_mapping(
    facts: DataFrame,
    mapping: DataFrame,
    source_system: str | Column,
    raw_status: str,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``canonical_status`` to facts that carry the quality columns.

    ``source_system`` is a column, or the one system name all facts share.
    A status without a mapping becomes UNMAPPED and is flagged.
    """
    system = F.lit(source_system) if isinstance(source_system, str) else source_system
    codes = mapping.select(
        F.col(PAIR[0]).alias("__system"), F.col(PAIR[1]).alias("__code"), "canonical_status"
    )
    keyed = facts.withColumns({"__system": system, "__code": F.col(raw_status).cast("string")})
    joined = lookup_join(
        keyed, codes, ["__system", "__code"], "left", broadcast_bytes=broadcast_bytes
    ).drop("__system", "__code")
    filled = joined.fillna(STATUS_UNMAPPED, subset=["canonical_status"])
    return flag_all(filled, [unmapped_rule()])
