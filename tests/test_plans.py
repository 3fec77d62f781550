import datetime as dt

import pytest
from pyspark.sql import functions as F

from assayline.operators.aggregates import distinct_count, duplicate_keys, require_unique
from assayline.operators.quality import add_anomaly_columns
from assayline.plans import lookups, silver_checks as checks, status
from assayline.plans.products import build_products
from assayline.sources.literals import literal_table, status_mappings


def test_lookup_builds(spark):
    brands = lookups.build_brands(
        literal_table(
            spark, [(1, "A", "PK", "x"), (2, "B", "AE", "y")],
            "brand_id int, brand_name string, brand_country string, brand_segment string",
        )
    )
    assert brands.columns[0] == "brand_key" and require_unique(brands, "brand_key").count() == 2
    with pytest.raises(ValueError):
        require_unique(brands.unionByName(brands), "brand_key")
    categories = lookups.build_categories(
        literal_table(
            spark, [(1, "root", None, 1), (2, "leaf", 1, 2)],
            "category_id int, category_name string, parent_category_id int, level int",
        )
    ).collect()
    keys = {r.category_id: r for r in categories}
    assert keys[1].parent_category_key is None
    assert keys[2].parent_category_key == keys[1].category_key
    tiers = lookups.build_loyalty_tiers(
        literal_table(
            spark, [("g", "Gold", 2.0), ("d", "Debt", -1.0)],
            "tier_id string, tier_name string, points_per_currency double",
        )
    )
    assert {r.tier_id: r.anomaly_reason_code for r in tiers.collect()} == {
        "g": None, "d": "NEGATIVE_AMOUNT",
    }


def test_products_flag_only_dates_that_were_given(spark):
    schema = (
        "product_id int, sku string, product_name string, category_id int, brand_id int, "
        "condition_code string, standard_cost double, rrp double, weight_kg double, "
        "is_campaign_product boolean, is_active boolean, created_date string, "
        "last_updated string, supplier_code string"
    )
    rest = ("n", 1, 1, "NEW", 1.0, 2.0, 0.5, True, True)
    products = literal_table(
        spark,
        [
            (1, "s1", *rest, "2024-01-02", "bad", "x"),
            (2, "s2", *rest, None, None, "x"),
            (3, "s3", *rest[:3], "ZZ", *rest[4:], "2024-02-31", "2024-01-01", "x"),
        ],
        schema,
    )
    brands = literal_table(spark, [(1, "bk")], "brand_id int, brand_key string")
    categories = literal_table(spark, [(1, "ck")], "category_id int, category_key string")
    codes = literal_table(spark, [("NEW", "nk")], "code string, condition_code_key string")
    for limit in (1 << 26, 0):
        out = build_products(products, brands, categories, codes, broadcast_bytes=limit)
        assert len(out.columns) == 22
        rows = {r.product_id: r for r in out.collect()}
        assert rows[1].created_date == dt.date(2024, 1, 2) and rows[1].last_updated is None
        assert [rows[i].anomaly_reason_code for i in (1, 2, 3)] == [None, None, "DATE_PARSE_FAIL"]
        assert [rows[i].condition_code_key for i in (1, 2, 3)] == ["nk", "nk", None]
        assert rows[3].brand_key == "bk" and rows[3].category_key == "ck"


def test_status_mapping_end_to_end(spark):
    pos = literal_table(
        spark, [("OPN",), ("???",), (None,), ("OPN",)], "status_code string"
    )
    ec = literal_table(spark, [("shipped", "new")], "order_status string, other string")
    sources = [("POS", pos, "status_code"), ("EC", ec, "order_status"), ("EC", ec, "other")]
    table = status.seed_status_mapping(spark, sources)
    assert table.count() == 30
    bad = table.where("anomaly_flag").orderBy("source_system").collect()
    assert [(r.source_system, r.raw_code, r.canonical_status, r.mapping_confidence) for r in bad] == [
        ("EC", "new", "UNMAPPED", 0.0), ("POS", "???", "UNMAPPED", 0.0),
    ]
    assert {r.anomaly_reason_code for r in bad} == {"STATUS_UNMAPPED"}
    facts = add_anomaly_columns(pos)
    for limit in (1 << 26, 0):
        out = status.apply_status_mapping(facts, status_mappings(spark), "POS", "status_code", limit)
        assert sorted((r.status_code or "", r.canonical_status, r.anomaly_flag) for r in out.collect()) == [
            ("", "UNMAPPED", True), ("???", "UNMAPPED", True),
            ("OPN", "OPEN", False), ("OPN", "OPEN", False),
        ]


def test_passing_checks_return_nothing_or_zero(spark):
    clean = add_anomaly_columns(spark.range(10).withColumn("d", F.lit("2024-03-01").cast("date")))
    assert checks.check_completeness(clean, "t").count() == 0
    assert checks.unregistered_codes(clean, "t").count() == 0
    assert checks.check_grain(clean, "t", "id").count() == 0
    assert tuple(checks.check_date_window(clean, "d", "d").first()) == ("d", 0, None, None)
    suite = checks.run_suite(
        {
            "complete": checks.check_completeness(clean, "t"),
            "window": checks.check_date_window(clean, "d", "d"),
            "fk": checks.check_fk(clean, "id", clean, "id", "fk"),
        },
        "mine",
    ).first()
    assert (suite.suite, suite.status, suite.checks, suite.failed_checks) == ("mine", "COMPLETE", 3, 0)
    assert suite.run_at is not None


def test_date_window_bounds_are_inclusive_and_cut_times(spark):
    times = literal_table(
        spark,
        [("2024-02-29 23:59:59",), ("2024-03-01 00:00:00",), ("2024-09-14 23:59:59",), ("2024-09-15 00:00:00",), (None,)],
        "s string",
    ).select(F.col("s").cast("timestamp").alias("ts"))
    assert tuple(checks.check_date_window(times, "ts", "x").first()) == (
        "x", 2, dt.date(2024, 2, 29), dt.date(2024, 9, 15),
    )


def test_unregistered_codes_trim_and_count(spark):
    df = literal_table(
        spark, [("DATE_PARSE_FAIL, FOO",), ("DATE_PARSE_FAIL",), ("FOO",), (None,)],
        "anomaly_reason_code string",
    )
    assert [tuple(r) for r in checks.unregistered_codes(df, "t").collect()] == [("t", "FOO", 2)]


def test_range_counts_missing_values(spark):
    df = literal_table(spark, [(0.0,), (1.0,), (1.1,), (None,), (-0.1,)], "c double")
    assert checks.check_range(df, "c", "c").first().violations == 3


def test_key_helpers(spark):
    df = literal_table(spark, [(1, "a"), (1, "a"), (None, "a"), (2, None)], "a int, b string")
    assert [tuple(r) for r in duplicate_keys(df, "a", "b").collect()] == [(1, "a", 2)]
    assert distinct_count(df, "a", "b").first().distinct_keys == 1


def test_repeated_lookup_keys_fail_the_job(spark):
    from pyspark.errors import PySparkException

    from assayline.operators.aggregates import unique_rows

    rows = literal_table(spark, [(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    assert sorted(unique_rows(rows, "k").collect(), key=repr) == sorted(rows.collect(), key=repr)
    with pytest.raises(PySparkException, match="duplicate key 2"):
        unique_rows(rows.unionByName(rows.where("k = 2")), "k").collect()
    brands = literal_table(
        spark, [(1, "A", "PK", "x"), (1, "B", "AE", "y")],
        "brand_id int, brand_name string, brand_country string, brand_segment string",
    )
    with pytest.raises(PySparkException, match="duplicate key 1"):
        lookups.build_brands(brands).collect()


def test_one_scan_per_table_for_fused_checks(spark, tmp_path):
    spark.range(20).selectExpr("id", "IF(id % 4 = 0, NULL, 'DATE_PARSE_FAIL') AS anomaly_reason_code").write.parquet(f"{tmp_path}/a")
    table = spark.read.parquet(f"{tmp_path}/a")
    rules = {
        "range": checks.outside_range("id", 0, 9),
        "codes": checks.has_unregistered_code(),
        "window": F.lit(False),
    }
    out = checks.check_tables({"a": (table, rules)})
    assert {r.check_name: (r.violations, r.passed) for r in out.collect()} == {
        "range": (10, False), "codes": (0, True), "window": (0, True),
    }
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    with pytest.raises(ValueError, match="a: range"):
        checks.accept({"a": (table, rules)})
    assert checks.accept({"a": (table, {"codes": rules["codes"]})}).count() == 1


def test_statuses_of_one_table_are_read_once(spark, tmp_path):
    spark.range(6).selectExpr("CAST(id % 2 AS STRING) AS a", "CAST(id % 3 AS STRING) AS b").write.parquet(f"{tmp_path}/s")
    read = lambda: spark.read.parquet(f"{tmp_path}/s")
    seen = status.statuses_seen([("X", read(), "a"), ("Y", read(), "b")])
    assert seen.count() == 5
    assert seen._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
