"""Match tables: one row per pair, and one row per canonical product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.functions.words import sorted_words, title_similarity, word_overlap_ratio
from assayline.operators.joins import BROADCAST_BYTES, lookup_join, lookup_sizes
from assayline.operators.matching import (
    CATALOGUE_COLUMNS,
    EXACT,
    FUZZY,
    PAIRS_PER_TASK,
    UNKNOWN,
    catalogue_by_sku,
    exact_sku_pairs,
    fuzzy_candidates,
    fuzzy_confidence,
    listings_without_sku,
    match_rows,
    pair_columns,
    with_catalogue,
    without_catalogue,
)
from assayline.operators.quality import Rule, add_anomaly_columns, flag_all, level_at, severity
from assayline.registry import CERTAINTIES, FUZZY_PERCENT, OVERLAP_BELOW, STATUSES


def match_rules(overlap_below: float = OVERLAP_BELOW, similarity_below: int | None = None) -> list[Rule]:
    """What a match row is flagged for.

    An exact SKU whose seller title shares too few words with the catalogue
    name is a mismatch (with ``similarity_below``: whose titles are less than
    that many percent alike). Unknown SKUs are anomalies, fuzzy matches merely
    ambiguous.
    """
    names = F.col("product_name"), F.col("seller_product_name_raw")
    if similarity_below is None:
        differs = word_overlap_ratio(*names) < overlap_below
    else:
        differs = title_similarity(*names) < similarity_below
    by = F.col("match_pass")
    return [
        Rule((by == EXACT) & differs, "SKU_PRODUCT_MISMATCH", certainty="UNRELIABLE"),
        Rule(by == UNKNOWN, "SKU_NOT_IN_CATALOGUE", certainty="UNRELIABLE"),
        Rule(by == FUZZY, "PRODUCT_FUZZY_MATCH", status="FLAGGED_AMBIGUOUS"),
    ]


def product_match_pairs(
    catalogue: DataFrame, listings: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Exact pairs and unknown SKUs, unflagged: 13 match and 4 quality columns."""
    return add_anomaly_columns(match_rows(catalogue, listings, broadcast_bytes))


def flag_matches(
    pairs: DataFrame, overlap_below: float = OVERLAP_BELOW, similarity_below: int | None = None
) -> DataFrame:
    """Apply ``match_rules`` to rows that carry the quality columns."""
    return flag_all(pairs, match_rules(overlap_below, similarity_below))


def mismatch_summary(flagged: DataFrame) -> DataFrame:
    """Rows per pass, flag and reason."""
    return flagged.groupBy("match_pass", "anomaly_flag", "anomaly_reason_code").count()


def rows_flagged_with(flagged: DataFrame, reason_code: str = "SKU_PRODUCT_MISMATCH") -> DataFrame:
    """The rows carrying one reason code, with both names."""
    return flagged.where(F.col("anomaly_reason_code").contains(reason_code)).select(
        "sku", "product_name", "seller_product_name_raw", "match_confidence", "anomaly_reason_code"
    )


def sku_coverage(pairs: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Catalogue SKUs with an exact match against the catalogue's size; fuzzy matches do not count."""
    certain = (F.col("match_pass") == EXACT) & (F.col("match_confidence") == 1.0)
    matched = pairs.where(certain).select("sku", F.lit(0).alias("listed"))
    offered = catalogue.select(F.lit(None).cast("string").alias("sku"), F.lit(1).alias("listed"))
    return (
        matched.unionByName(offered)
        .agg(
            F.count_distinct("sku").alias("matched_skus"),
            F.ifnull(F.sum("listed"), F.lit(0)).alias("catalogue_skus"),
        )
        .withColumn("covered", F.col("matched_skus") == F.col("catalogue_skus"))
    )


def all_match_rows(
    catalogue: DataFrame,
    listings: DataFrame,
    block: str,
    percent: int = FUZZY_PERCENT,
    pairs_per_task: int = PAIRS_PER_TASK,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Exact, then fuzzy, then unknown: one row per listing and catalogue row.

    ``block`` names the listing and catalogue column inside which titles are
    compared. A listing matched by title takes the key of the catalogue SKU, so
    it leaves the unknown rows. If the matched titles fit a broadcast, both
    lookups are joined to the listings in one pass. Otherwise only the listings
    without a catalogue SKU are shuffled for their title.
    """
    (size,) = lookup_sizes([catalogue_by_sku(catalogue)], broadcast_bytes)
    alone = listings_without_sku(listings, catalogue, broadcast_bytes, size)
    best = fuzzy_candidates(
        catalogue, alone, block, percent=percent, pairs_per_task=pairs_per_task
    )
    by_title = lookup_join(
        best, catalogue.select(*CATALOGUE_COLUMNS), "sku", "inner", None, size, broadcast_bytes
    ).select(
        F.col("block").alias(block),
        F.col("t").alias("__t"),
        fuzzy_confidence().alias("__confidence"),
        *[F.col(c).alias(f"__{c}") for c in CATALOGUE_COLUMNS],
    )
    (title_bytes,) = lookup_sizes([by_title], broadcast_bytes)

    def matched(rows: DataFrame) -> DataFrame:
        title = F.when(F.col("sku").isNull(), sorted_words(F.col("seller_product_name")))
        exact, fuzzy = F.col("__exact"), F.col("__confidence").isNotNull()
        joined = lookup_join(
            rows.withColumns({"__exact": F.col("sku").isNotNull(), "__t": title}),
            by_title,
            [block, "__t"],
            "left",
            ["listing_id"],
            title_bytes,
            broadcast_bytes,
        )
        # a row has catalogue columns from one of the two joins at most
        return joined.withColumns({c: F.coalesce(c, f"__{c}") for c in CATALOGUE_COLUMNS}).select(
            pair_columns(
                F.when(exact, 1.0).when(fuzzy, F.col("__confidence")).otherwise(0.0),
                F.when(exact, EXACT).when(fuzzy, FUZZY).otherwise(UNKNOWN),
            )
        )

    if title_bytes <= broadcast_bytes:
        return matched(with_catalogue(listings, catalogue, "left", broadcast_bytes, size))
    return exact_sku_pairs(catalogue, listings, "inner", broadcast_bytes, size).unionByName(
        matched(without_catalogue(alone, catalogue))
    )


def one_per_product(flagged: DataFrame) -> DataFrame:
    """One row per ``canonical_product_key``.

    The best pair (an exact one before a fuzzy one before an unknown SKU, then
    highest confidence, then lowest listing id) supplies the business columns.
    Flag, status and certainty are the worst of the key's pairs and the reason
    codes their sorted union. Everything is one aggregate with map-side combining:
    a key with a third of all listings reaches the shuffle as one partial row per
    task, and what is collected per key are distinct reason texts, never rows.
    """
    key = "canonical_product_key"
    quality = {"anomaly_flag", "anomaly_reason_code", "data_quality_status", "metric_certainty_level"}
    rest = [
        c
        for c in flagged.columns
        if c not in quality | {key, "match_confidence", "match_source_listing_id"}
    ]
    by = F.when(F.col("match_pass") == EXACT, 0).when(F.col("match_pass") == FUZZY, 1).otherwise(2)
    best = F.struct(
        by.alias("pass"),
        (-F.col("match_confidence")).alias("order"),
        "match_source_listing_id",
        "match_confidence",
        *rest,
    )
    grouped = flagged.groupBy(key).agg(
        F.min(best).alias("best"),
        F.bool_or("anomaly_flag").alias("anomaly_flag"),
        F.collect_set("anomaly_reason_code").alias("reasons"),
        F.max(severity(F.col("data_quality_status"), STATUSES)).alias("status"),
        F.max(severity(F.col("metric_certainty_level"), CERTAINTIES)).alias("certainty"),
    )
    codes = F.sort_array(F.array_distinct(F.split(F.concat_ws(",", "reasons"), ",")))
    columns = [c for c in flagged.columns if c not in quality and c != key]
    return grouped.select(
        key,
        *[F.col(f"best.{c}").alias(c) for c in columns],
        "anomaly_flag",
        F.when(F.size("reasons") > 0, F.concat_ws(",", codes)).alias("anomaly_reason_code"),
        level_at(F.col("status"), STATUSES).alias("data_quality_status"),
        level_at(F.col("certainty"), CERTAINTIES).alias("metric_certainty_level"),
    )


def product_master(
    catalogue: DataFrame,
    listings: DataFrame,
    block: str,
    percent: int = FUZZY_PERCENT,
    overlap_below: float = OVERLAP_BELOW,
    pairs_per_task: int = PAIRS_PER_TASK,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Exact, fuzzy and unknown matches reduced to one row per product."""
    rows = all_match_rows(catalogue, listings, block, percent, pairs_per_task, broadcast_bytes)
    return one_per_product(flag_matches(add_anomaly_columns(rows), overlap_below))
