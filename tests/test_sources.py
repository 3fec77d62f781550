import pytest
from pyspark.sql import functions as F

from assayline.plans.bronze_checks import (
    bronze_totals,
    ingestion_runs,
    missing_metadata_columns,
    present_metadata_columns,
    reconcile_counts,
)
from assayline.plans.lookups import PRICE_HISTORY_SCHEMA, price_history
from assayline.registry import BRONZE_METADATA, EXPECTED_BRONZE_ROWS
from assayline.sources import scratch
from assayline.sources.bronze import ingestion_log, numbered, with_bronze_metadata
from assayline.sources.literals import (
    expected_counts,
    literal_table,
    registered_codes,
    status_mappings,
)
from assayline.sources.tables import Medallion


@pytest.fixture
def layers(spark, tmp_path):
    return Medallion(spark, str(tmp_path))


def test_literal_tables(spark):
    assert sum(n for _, n in EXPECTED_BRONZE_ROWS) == 843_304 and len(EXPECTED_BRONZE_ROWS) == 61
    assert expected_counts(spark).count() == 61
    assert registered_codes(spark).distinct().count() == 40
    seeds = status_mappings(spark)
    assert {r.source_system: r["count"] for r in seeds.groupBy("source_system").count().collect()} == {
        "POS": 6, "EC": 9, "PG": 8, "MARKETPLACE": 5,
    }
    assert "LocalTableScan" in seeds._jdf.queryExecution().executedPlan().toString()


def test_price_history_is_empty_but_typed(spark, layers):
    table = price_history(spark)
    assert table.schema == PRICE_HISTORY_SCHEMA and len(table.columns) == 12
    assert layers.write_and_verify(table, "price_history") == 0
    assert [f.dataType for f in layers.read_silver("price_history").schema.fields] == [
        f.dataType for f in PRICE_HISTORY_SCHEMA.fields
    ]


def test_overwrite_is_idempotent_and_append_adds(spark, layers):
    df = spark.range(10).withColumnRenamed("id", "ID")
    assert layers.write_silver(df, "T") == layers.write_silver(df, "t") == 10
    back = layers.read_silver("T")
    assert back.columns == ["id"] and back.count() == 10
    assert layers.write_silver(df.where("ID < 3"), "T", overwrite=False) == 3
    assert layers.read_silver("T").count() == 13
    assert layers.write_and_verify(df, "again", "gold") == 10


def test_where_and_select_see_the_source_columns(spark, layers):
    layers.write_table(
        spark.range(100).select("id", (F.col("id") % 7).alias("Grp"), F.lit("x").alias("wide")),
        "t", "bronze",
    )
    out = layers.read_bronze("t", select="id + 1 AS Next", where="grp = 3 AND id > 50")
    assert out.columns == ["next"]
    assert sorted(r.next for r in out.collect()) == [i + 1 for i in range(51, 100) if i % 7 == 3]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(Grp,3)" in plan and "GreaterThan(id,50)" in plan
    assert "wide" not in plan


def test_partitioned_write_prunes(spark, layers):
    df = spark.range(100).select("id", (F.col("id") % 4).alias("day"))
    assert layers.write_silver(df, "p", partition_by=["day"], max_records_per_file=10) == 100
    out = layers.read_silver("p", where="day = 2")
    assert out.count() == 25
    assert "PartitionFilters: [isnotnull(day" in out._jdf.queryExecution().executedPlan().toString()


def test_row_numbers_are_dense_and_ordered_even_with_a_hot_key(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"))
    out = numbered(df.repartition(6), ["k"], "n")
    got = out.orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 5001))
    keys = [r.k for r in got]
    assert keys == sorted(keys)
    assert {r.id for r in got} == set(range(5000))


def test_bronze_metadata(spark):
    rows = with_bronze_metadata(spark.range(100).repartition(5), "t")
    assert tuple(rows.columns[-3:]) == BRONZE_METADATA
    assert rows.select("_source_row_number").distinct().count() == 100
    assert missing_metadata_columns(rows, "t").count() == 0
    assert present_metadata_columns(rows, "t").count() == 3
    lost = missing_metadata_columns(rows.drop("_source_table"), "t").collect()
    assert [(r.source_table, r.column_name) for r in lost] == [("t", "_source_table")]
    runs = ingestion_runs(rows).first()
    assert runs.first_run == runs.latest_run and runs.distinct_runs == 1


def test_log_takes_the_newest_run_and_skips_bookkeeping(spark):
    def at(day):
        return F.lit(f"2024-05-{day}").cast("timestamp")

    older = ingestion_log({"a": spark.range(5), "b": spark.range(9)}, at(10))
    newer = ingestion_log({"a": spark.range(6), "_log": spark.range(100)}, at(11))
    log = older.unionByName(newer)
    assert tuple(bronze_totals(log).first()) == (15, 2)
    expected = literal_table(
        spark, [("a", 6), ("b", 8), ("c", 4)], "source_table string, expected_rows bigint"
    )
    assert [tuple(r) for r in reconcile_counts(log, expected).collect()] == [
        ("b", 8, 9, 1, "COUNT_MISMATCH"),
        ("c", 4, -1, -4, "MISSING_FROM_BRONZE"),
    ]
    assert reconcile_counts(log, expected.where("source_table = 'a'")).count() == 0


def test_scratch_folder_comes_from_the_session(spark, monkeypatch):
    class Conf(dict):
        pass

    class Session:
        conf = Conf({"spark.checkpoint.dir": "/shared/x/", "spark.master": "yarn"})

    assert scratch.scratch_dir(Session) == "/shared/x"
    Session.conf = Conf({"spark.master": "yarn", "spark.sql.warehouse.dir": "s3a://lake/w/"})
    assert scratch.scratch_dir(Session) == "s3a://lake/w/_scratch"
    Session.conf = Conf({"spark.master": "yarn", "spark.sql.warehouse.dir": "file:/opt/w"})
    with pytest.raises(RuntimeError):
        scratch.scratch_dir(Session)
    Session.conf = Conf({"spark.master": "local[2]", "spark.sql.warehouse.dir": "file:/opt/w"})
    assert scratch.scratch_dir(Session) == "file:/opt/w/_scratch"


def test_scratch_tables_go_when_their_result_is_written(spark):
    with scratch.scratch_tables(spark):
        path = scratch.new_scratch(spark, "gone")
        spark.range(5).write.parquet(path)
        assert scratch.stored(spark.range(3), "x").count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_braces_in_sql_text(spark, layers):
    layers.write_silver(spark.createDataFrame([("A", "{x}"), ("BB", "y")], "s string, t string"), "braces")
    assert layers.read_silver("braces", where="s rlike '^[A-Z]{1}$'").count() == 1
    assert layers.read_silver("braces", select="t, '{x}' AS c", where="t = '{x}'").first() == ("{x}", "{x}")


def test_partitioned_write_makes_few_files(spark, layers):
    rows = spark.range(0, 4000, 1, 40).selectExpr("id", "id % 50 AS day")
    assert layers.write_silver(rows, "days", partition_by=["day"]) == 4000
    files = layers.read_silver("days").select(F.input_file_name()).distinct().count()
    assert 50 <= files <= 60
