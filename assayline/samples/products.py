"""Lookups, foreign keys, product table and matching."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.functions import surrogate_key, word_overlap_ratio
from assayline.operators import matching
from assayline.operators.aggregates import duplicate_keys
from assayline.operators.joins import resolve_fk as resolve
from assayline.plans import lookups, product_master as master, products
from assayline.registry import FREE_TEXT_PERCENT
from assayline.samples.registry import Source, query
from assayline.sources.scratch import stored

_CLEAN = """FALSE AS anomaly_flag, CAST(NULL AS VARCHAR) AS anomaly_reason_code,
       'CLEAN' AS data_quality_status, 'CONFIRMED' AS metric_certainty_level"""


def _brands(t: Source) -> DataFrame:
    return lookups.build_brands(t.v("brands"))


def _categories(t: Source) -> DataFrame:
    return lookups.build_categories(t.v("part_categories"))


def _codes(t: Source) -> DataFrame:
    return lookups.build_condition_codes(t.v("condition_codes"))


def _products(t: Source) -> DataFrame:
    return products.build_products(t.v("catalogue"), _brands(t), _categories(t), _codes(t))


def _stored_products(t: Source) -> DataFrame:
    """The product table written once, for builds that read it several times."""
    return stored(_products(t), "products")


def _listings(t: Source) -> DataFrame:
    return matching.listing_columns(t.v("listings"))


def _listings_by_category(t: Source) -> DataFrame:
    return matching.listing_columns(t.v("listings"), extra=["category_id"])


@query(
    f"""
SELECT sha256(brand_id) AS brand_key, brand_id, brand_name, brand_country, brand_segment, {_CLEAN}
FROM v_brands""",
    "brands",
)
def lookup_brands(t: Source) -> DataFrame:
    return _brands(t)


@query(
    f"""
SELECT sha256(CAST(category_id AS VARCHAR)) AS category_key, category_id, category_name,
       parent_category_id,
       CASE WHEN parent_category_id IS NOT NULL
            THEN sha256(CAST(parent_category_id AS VARCHAR)) END AS parent_category_key,
       level, {_CLEAN}
FROM v_categories""",
    "categories",
)
def lookup_categories_parent(t: Source) -> DataFrame:
    return lookups.build_categories(t.v("categories"))


@query(
    f"""
SELECT sha256(code) AS condition_code_key, code, description, {_CLEAN} FROM v_condition_codes""",
    "condition_codes",
)
def lookup_conditions(t: Source) -> DataFrame:
    return _codes(t)


@query(
    """
SELECT sha256(tier_id) AS loyalty_tier_key, tier_id, tier_name, points_per_currency,
       points_per_currency < 0 AS anomaly_flag,
       CASE WHEN points_per_currency < 0 THEN 'NEGATIVE_AMOUNT' END AS anomaly_reason_code,
       CASE WHEN points_per_currency < 0 THEN 'FLAGGED_ANOMALY' ELSE 'CLEAN' END AS data_quality_status,
       CASE WHEN points_per_currency < 0 THEN 'UNRELIABLE' ELSE 'CONFIRMED' END AS metric_certainty_level
FROM v_loyalty_tiers""",
    "loyalty_tiers",
)
def lookup_loyalty_tiers(t: Source) -> DataFrame:
    return lookups.build_loyalty_tiers(t.v("loyalty_tiers"))


@query(
    """
SELECT product_id, c.brand_id, CASE WHEN b.brand_id IS NOT NULL THEN sha256(b.brand_id) END AS brand_key
FROM v_catalogue c LEFT JOIN v_brands b ON b.brand_id = c.brand_id""",
    "catalogue",
    "brands",
)
def resolve_fk(t: Source) -> DataFrame:
    catalogue = t.v("catalogue").select("product_id", "brand_id")
    return resolve(catalogue, _brands(t), "brand_id", "brand_key")


@query(
    """
SELECT product_id, condition_code,
       CASE WHEN condition_code <> 'ZZ' THEN sha256(condition_code) END AS condition_code_key
FROM v_catalogue""",
    "catalogue",
)
def resolve_fk_renamed(t: Source) -> DataFrame:
    catalogue = t.v("catalogue").select("product_id", "condition_code")
    return resolve(catalogue, _codes(t), "condition_code", "condition_code_key", dim_key="code")


_PRODUCTS = """
v_products AS (
  SELECT sha256(sku) AS product_key, product_id, sku, product_name,
         category_id, sha256(category_id) AS category_key, brand_id, sha256(brand_id) AS brand_key,
         condition_code,
         CASE WHEN condition_code <> 'ZZ' THEN sha256(condition_code) END AS condition_code_key,
         standard_cost, rrp, weight_kg, is_campaign_product, is_active,
         CAST(try_strptime(created_date, '%Y-%m-%d') AS DATE) AS created_date,
         CAST(try_strptime(last_updated, '%Y-%m-%d') AS DATE) AS last_updated, supplier_code,
         created_date IS NOT NULL AND try_strptime(created_date, '%Y-%m-%d') IS NULL AS bad
  FROM v_catalogue)"""


@query(
    f"""WITH {_PRODUCTS}
SELECT * EXCLUDE (bad), bad AS anomaly_flag,
       CASE WHEN bad THEN 'DATE_PARSE_FAIL' END AS anomaly_reason_code,
       CASE WHEN bad THEN 'FLAGGED_ANOMALY' ELSE 'CLEAN' END AS data_quality_status,
       CASE WHEN bad THEN 'UNRELIABLE' ELSE 'CONFIRMED' END AS metric_certainty_level
FROM v_products""",
    "catalogue",
)
def silver_products(t: Source) -> DataFrame:
    return _products(t)


_EXACT = """
  SELECT sha256(p.sku) AS canonical_product_key, p.sku, p.product_name, p.brand_key, p.category_key,
         p.condition_code_key, p.standard_cost AS cogs, p.rrp AS list_price,
         listing_id AS match_source_listing_id, seller_id AS match_source_seller_id,
         seller_product_title AS seller_product_name_raw,
         CAST(1.0 AS DOUBLE) AS match_confidence, 'EXACT_SKU' AS match_pass
  FROM v_listings l JOIN v_products p ON p.sku = l.sku_ref"""
_UNKNOWN = """
  SELECT sha256(coalesce(sku_ref, '~NULL~')) AS canonical_product_key, sku_ref AS sku,
         seller_product_title AS product_name, CAST(NULL AS VARCHAR) AS brand_key,
         CAST(NULL AS VARCHAR) AS category_key, CAST(NULL AS VARCHAR) AS condition_code_key,
         CAST(NULL AS DOUBLE) AS cogs, asking_price AS list_price,
         listing_id AS match_source_listing_id, seller_id AS match_source_seller_id,
         seller_product_title AS seller_product_name_raw,
         CAST(0.0 AS DOUBLE) AS match_confidence, 'SKU_NOT_IN_CATALOGUE' AS match_pass
  FROM v_listings l WHERE NOT EXISTS (SELECT 1 FROM v_products p WHERE p.sku = l.sku_ref)"""


def _words(col: str) -> str:
    return f"regexp_split_to_array(trim(regexp_replace(lower({col}), '[—-]', ' ', 'g')), '\\s+')"


def _overlap(catalogue: str, seller: str) -> str:
    a, b = _words(catalogue), _words(seller)
    return f"coalesce(len(list_distinct(list_intersect({a}, {b}))) / len({a}), 0.0)"


def _sorted(col: str) -> str:
    return f"array_to_string(list_sort({_words(col)}), ' ')"


_PAIRS = f"""{_PRODUCTS},
v_pairs AS ({_EXACT} UNION ALL {_UNKNOWN})"""
_FLAGGED = f"""{_PAIRS},
v_scored AS (
  SELECT *, match_pass = 'EXACT_SKU'
            AND {_overlap('product_name', 'seller_product_name_raw')} < 0.35 AS differs,
         match_pass = 'SKU_NOT_IN_CATALOGUE' AS unknown
  FROM v_pairs),
v_flagged AS (
  SELECT * EXCLUDE (differs, unknown), differs OR unknown AS anomaly_flag,
         CASE WHEN differs THEN 'SKU_PRODUCT_MISMATCH'
              WHEN unknown THEN 'SKU_NOT_IN_CATALOGUE' END AS anomaly_reason_code,
         CASE WHEN differs OR unknown THEN 'FLAGGED_ANOMALY' ELSE 'CLEAN' END AS data_quality_status,
         CASE WHEN differs OR unknown THEN 'UNRELIABLE' ELSE 'CONFIRMED' END AS metric_certainty_level
  FROM v_scored)"""


@query(f"WITH {_PRODUCTS} {_EXACT}", "catalogue", "listings")
def exact_sku_pairs(t: Source) -> DataFrame:
    return matching.exact_sku_pairs(_products(t), _listings(t))


@query(
    f"""WITH {_PRODUCTS} {_EXACT}
UNION ALL
  SELECT sha256(sku), sku, product_name, brand_key, category_key, condition_code_key,
         standard_cost, rrp, NULL, NULL, NULL, CAST(0.0 AS DOUBLE), NULL
  FROM v_products p WHERE NOT EXISTS (SELECT 1 FROM v_listings l WHERE l.sku_ref = p.sku)""",
    "catalogue",
    "listings",
)
def exact_sku_pairs_left(t: Source) -> DataFrame:
    return matching.exact_sku_pairs(_products(t), _listings(t), how="left")


@query(f"WITH {_PRODUCTS} {_UNKNOWN}", "catalogue", "listings")
def unknown_skus(t: Source) -> DataFrame:
    return matching.unknown_skus(_products(t), _listings(t))


@query(
    f"""WITH {_PAIRS}
SELECT *, {_CLEAN} FROM v_pairs""",
    "catalogue",
    "listings",
)
def match_pairs(t: Source) -> DataFrame:
    return master.product_match_pairs(_products(t), _listings(t))


@query(
    f"""
SELECT listing_id, {_overlap('product_name', 'seller_product_title')} AS overlap
FROM v_listings JOIN v_catalogue ON sku = sku_ref""",
    "catalogue",
    "listings",
)
def word_overlap(t: Source) -> DataFrame:
    pairs = matching.exact_sku_pairs(_products(t), _listings(t))
    ratio = word_overlap_ratio(F.col("product_name"), F.col("seller_product_name_raw"))
    return pairs.select(F.col("match_source_listing_id").alias("listing_id"), ratio.alias("overlap"))


@query(f"WITH {_FLAGGED} SELECT * FROM v_flagged", "catalogue", "listings")
def sku_mismatch(t: Source) -> DataFrame:
    return master.flag_matches(master.product_match_pairs(_products(t), _listings(t)))


@query(
    f"""WITH {_PRODUCTS}
SELECT listing_id, coalesce(100 * (greatest(length(a), length(b)) - levenshtein(a, b))
                            < 50 * greatest(length(a), length(b)), TRUE) AS anomaly_flag
FROM (SELECT listing_id, {_sorted('product_name')} AS a, {_sorted('seller_product_title')} AS b
      FROM v_listings JOIN v_products ON sku = sku_ref)""",
    "catalogue",
    "listings",
)
def sku_mismatch_by_similarity(t: Source) -> DataFrame:
    pairs = master.product_match_pairs(_products(t), _listings(t)).where("match_pass = 'EXACT_SKU'")
    flagged = master.flag_matches(pairs, similarity_below=50)
    return flagged.select(F.col("match_source_listing_id").alias("listing_id"), "anomaly_flag")


@query(
    f"""WITH {_FLAGGED}
SELECT match_pass, anomaly_flag, anomaly_reason_code, count(*) AS count
FROM v_flagged GROUP BY ALL""",
    "catalogue",
    "listings",
)
def mismatch_summary(t: Source) -> DataFrame:
    return master.mismatch_summary(sku_mismatch(t))


@query(
    f"""WITH {_FLAGGED}
SELECT sku, product_name, seller_product_name_raw, match_confidence, anomaly_reason_code
FROM v_flagged WHERE contains(anomaly_reason_code, 'SKU_PRODUCT_MISMATCH')""",
    "catalogue",
    "listings",
)
def mismatch_rows(t: Source) -> DataFrame:
    return master.rows_flagged_with(sku_mismatch(t))


@query(
    f"""WITH {_PAIRS}
SELECT count(DISTINCT sku) FILTER (WHERE match_pass = 'EXACT_SKU') AS matched_skus,
       (SELECT count(*) FROM v_products) AS catalogue_skus,
       count(DISTINCT sku) FILTER (WHERE match_pass = 'EXACT_SKU')
         = (SELECT count(*) FROM v_products) AS covered
FROM v_pairs""",
    "catalogue",
    "listings",
)
def sku_coverage(t: Source) -> DataFrame:
    catalogue = _stored_products(t)
    return master.sku_coverage(master.product_match_pairs(catalogue, _listings(t)), catalogue)


def _fuzzy(percent: int, alone: str) -> str:
    """Every title against every name of its category: the brute-force answer."""
    return f"""
v_alone AS ({alone}),
v_titles AS (SELECT DISTINCT category_id, {_sorted('seller_product_title')} AS t
             FROM v_alone WHERE {_sorted('seller_product_title')} <> ''),
v_names AS (SELECT category_id, {_sorted('product_name')} AS n, min(sku) AS sku
            FROM v_catalogue WHERE {_sorted('product_name')} <> '' GROUP BY ALL),
v_near AS (SELECT category_id, t, sku, levenshtein(t, n) AS d, greatest(length(t), length(n)) AS m
           FROM v_titles JOIN v_names USING (category_id)
           WHERE 100 * (greatest(length(t), length(n)) - levenshtein(t, n))
                 >= {percent} * greatest(length(t), length(n))),
v_best AS (SELECT * FROM v_near
           QUALIFY row_number() OVER (PARTITION BY category_id, t ORDER BY d / m, sku) = 1)"""


_ALONE = """SELECT * FROM v_listings l
  WHERE NOT EXISTS (SELECT 1 FROM v_catalogue c WHERE c.sku = l.sku_ref)"""


@query(
    f"""WITH {_fuzzy(70, _ALONE)}
SELECT listing_id, b.sku, CASE WHEN m > 0 THEN least((m - d) / m, 0.99) END AS match_confidence
FROM v_alone a JOIN v_best b
  ON a.category_id = b.category_id AND {_sorted('seller_product_title')} = b.t""",
    "catalogue",
    "listings",
)
def fuzzy_match(t: Source) -> DataFrame:
    catalogue = t.v("catalogue").select("sku", "product_name", "category_id")
    alone = matching.listings_without_sku(_listings_by_category(t), catalogue)
    matched = matching.fuzzy_match(catalogue, alone, block="category_id")
    return matched.select("listing_id", "sku", "match_confidence")


@query(
    f"""WITH {_fuzzy(FREE_TEXT_PERCENT, "SELECT * FROM v_listings")}
SELECT listing_id, b.sku, CASE WHEN m > 0 THEN least((m - d) / m, 0.99) END AS match_confidence
FROM v_alone a LEFT JOIN v_best b
  ON a.category_id = b.category_id AND {_sorted('seller_product_title')} = b.t""",
    "catalogue",
    "listings",
)
def fuzzy_free_text(t: Source) -> DataFrame:
    catalogue = t.v("catalogue").select("sku", "product_name", "category_id")
    matched = matching.fuzzy_match(
        catalogue,
        _listings_by_category(t),
        block="category_id",
        percent=FREE_TEXT_PERCENT,
        how="left",
    )
    return matched.select("listing_id", "sku", "match_confidence")


_MASTER = f"""{_PRODUCTS},
{_fuzzy(70, _ALONE)},
v_rows AS (
  {_EXACT}
  UNION ALL
  SELECT sha256(p.sku), p.sku, p.product_name, p.brand_key, p.category_key, p.condition_code_key,
         p.standard_cost, p.rrp, listing_id, seller_id, seller_product_title, least((m - d) / m, 0.99), 'FUZZY'
  FROM v_alone a JOIN v_best b ON a.category_id = b.category_id AND {_sorted('seller_product_title')} = b.t
  JOIN v_products p ON p.sku = b.sku
  UNION ALL
  SELECT sha256(coalesce(sku_ref, '~NULL~')), sku_ref, seller_product_title, NULL, NULL, NULL,
         NULL, asking_price, listing_id, seller_id, seller_product_title, 0.0, 'SKU_NOT_IN_CATALOGUE'
  FROM v_alone a LEFT JOIN v_best b
    ON a.category_id = b.category_id AND {_sorted('seller_product_title')} = b.t
  WHERE b.sku IS NULL)"""


@query(f"WITH {_MASTER} SELECT * FROM v_rows", "catalogue", "listings")
def all_match_rows(t: Source) -> DataFrame:
    return master.all_match_rows(_stored_products(t), _listings_by_category(t), "category_id")


@query(
    f"""WITH {_MASTER},
v_codes AS (
  SELECT canonical_product_key AS k, CASE
    WHEN match_pass = 'FUZZY' THEN 'PRODUCT_FUZZY_MATCH'
    WHEN match_pass = 'SKU_NOT_IN_CATALOGUE' THEN 'SKU_NOT_IN_CATALOGUE'
    WHEN {_overlap('product_name', 'seller_product_name_raw')} < 0.35 THEN 'SKU_PRODUCT_MISMATCH'
    END AS code FROM v_rows),
v_quality AS (
  SELECT k, string_agg(DISTINCT code, ',' ORDER BY code) AS codes,
         max(CASE WHEN code = 'PRODUCT_FUZZY_MATCH' THEN 2 WHEN code IS NOT NULL THEN 3 ELSE 0 END) AS worst
  FROM v_codes GROUP BY k)
SELECT r.*, codes IS NOT NULL AS anomaly_flag, codes AS anomaly_reason_code,
       CASE worst WHEN 0 THEN 'CLEAN' WHEN 2 THEN 'FLAGGED_AMBIGUOUS'
                  ELSE 'FLAGGED_ANOMALY' END AS data_quality_status,
       CASE worst WHEN 3 THEN 'UNRELIABLE' ELSE 'CONFIRMED' END AS metric_certainty_level
FROM (SELECT * FROM v_rows QUALIFY row_number() OVER (PARTITION BY canonical_product_key
        ORDER BY CASE match_pass WHEN 'EXACT_SKU' THEN 0 WHEN 'FUZZY' THEN 1 ELSE 2 END,
                 match_confidence DESC, match_source_listing_id) = 1) r
JOIN v_quality ON k = canonical_product_key""",
    "catalogue",
    "listings",
)
def product_master(t: Source) -> DataFrame:
    return master.product_master(_stored_products(t), _listings_by_category(t), "category_id")


@query(
    f"""WITH {_PRODUCTS}
SELECT sha256(sku) AS product_key, count(*) AS count FROM
  (SELECT sku FROM v_products UNION ALL SELECT sku FROM v_products WHERE product_id % 50 = 3)
GROUP BY sku HAVING count(*) > 1""",
    "catalogue",
)
def duplicate_product_keys(t: Source) -> DataFrame:
    rows = t.v("catalogue").select("product_id", surrogate_key(F.col("sku")).alias("product_key"))
    return duplicate_keys(rows.unionByName(rows.where("product_id % 50 = 3")), "product_key")


# names and titles that are all different: as many as there are products, compared within a brand
_GROWN = f"""
v_model AS (SELECT p_partkey, p_brand AS category_id,
                   p_name || ' ' || p_type || ' m' || CAST(p_partkey * 7919 % 10007 AS VARCHAR) || 'x' || CAST(p_partkey AS VARCHAR) AS name
            FROM part),
v_catalogue AS (SELECT p_partkey AS sku, name AS product_name, category_id FROM v_model),
v_listings AS (SELECT p_partkey AS listing_id, category_id,
                      CASE p_partkey % 4 WHEN 0 THEN replace(name, 'e', '') WHEN 1 THEN upper(name) || ' new'
                           WHEN 2 THEN substr(name, 4) ELSE reverse(name) END AS seller_product_title
               FROM v_model)"""


@query(
    f"""WITH {_GROWN}, {_fuzzy(70, "SELECT * FROM v_listings")}
SELECT listing_id, b.sku, CASE WHEN m > 0 THEN least((m - d) / m, 0.99) END AS match_confidence
FROM v_alone a JOIN v_best b ON a.category_id = b.category_id AND {_sorted('seller_product_title')} = b.t"""
)
def fuzzy_growing_titles(t: Source) -> DataFrame:
    """A catalogue in which every name and every title is its own: the work of the join grows with the data."""
    code = F.concat(F.lit(" m"), (F.col("p_partkey") * 7919 % 10007).cast("string"), F.lit("x"), F.col("p_partkey").cast("string"))
    name = F.concat("p_name", F.lit(" "), "p_type", code)
    models = t.part.select(F.col("p_partkey").alias("sku"), name.alias("product_name"), F.col("p_brand").alias("category_id"))
    kind, text = F.col("sku") % 4, F.col("product_name")
    title = (
        F.when(kind == 0, F.replace(text, F.lit("e"), F.lit("")))
        .when(kind == 1, F.concat(F.upper(text), F.lit(" new")))
        .when(kind == 2, F.substring(text, 4, 1000))
        .otherwise(F.reverse(text))
    )
    listings = models.select(F.col("sku").alias("listing_id"), "category_id", title.alias("seller_product_name"))
    matched = matching.fuzzy_match(models, listings, block="category_id")
    return matched.select("listing_id", "sku", "match_confidence")
