import collections

import pytest
from pyspark.sql import functions as F

from assayline.operators import joins
from assayline.plans.silver_checks import check_fk, check_grain
from assayline.sources.literals import literal_table

# a third of the rows on one key, a sixth on NULL, some keys without a match
FACTS = [(i, None if i % 6 == 5 else ("hot" if i % 3 == 0 else f"k{i % 40}")) for i in range(3000)]
LOOKUP = [("hot", "H"), (None, "N")] + [(f"k{i}", f"v{i}") for i in range(30)]


@pytest.fixture(scope="module")
def frames(spark):
    return (
        literal_table(spark, FACTS, "id bigint, key string"),
        literal_table(spark, LOOKUP, "key string, value string"),
    )


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_sliced_join_equals_plain_join(frames, how):
    facts, lookup = frames
    hot = joins.hot_keys(facts, ["key"], slice_rows=200)
    assert {r.key: r["__slices"] for r in hot.keys.collect()} == {"hot": 5} and hot.null_slices == 3
    sliced = joins.sliced_join(facts, lookup, ["key"], how, hot=hot)
    assert rows(sliced) == rows(facts.join(lookup, "key", how))
    # rows of the hot key and of NULL end up on several (key, slice) groups
    assert rows(joins.sliced_join(facts, lookup, ["key"], how, ["id"], hot=joins.HotKeys(None, 1))) == rows(sliced)


def test_every_heavy_key_is_sliced(spark):
    """3,000 keys above the slice limit, all of them spread, none left out."""
    facts = spark.range(3000 * 12 + 500).selectExpr(
        "id", "CASE WHEN id < 36000 THEN concat('k', id % 3000) WHEN id % 2 = 0 THEN concat('r', id) END AS key"
    )
    lookup = spark.range(3000).selectExpr("concat('k', id) AS key", "id AS v")
    hot = joins.hot_keys(facts, ["key"], slice_rows=10)
    assert hot.keys.count() == 3000 and hot.keys.where("__slices <> 2").count() == 0
    assert hot.null_slices == 25
    sliced = joins.sliced_join(facts, lookup, ["key"], "left", ["id"], hot)
    assert rows(sliced) == rows(facts.join(lookup, "key", "left"))


def test_repeated_lookup_keys_multiply_as_in_a_plain_join(spark, frames):
    facts, lookup = frames
    double = lookup.unionByName(lookup)
    hot = joins.hot_keys(facts, ["key"], slice_rows=200)
    assert rows(joins.sliced_join(facts, double, ["key"], "left", hot=hot)) == rows(
        facts.join(double, "key", "left")
    )


def test_lookup_join_broadcasts_only_what_fits(frames):
    facts, lookup = frames
    small = joins.lookup_join(facts, lookup, "key")
    assert "BroadcastHashJoin" in plan_of(small)
    large = joins.lookup_join(facts, lookup, "key", broadcast_bytes=0)
    assert "__slice" in large._jdf.queryExecution().analyzed().toString()
    assert rows(large) == rows(small)
    with pytest.raises(ValueError):
        joins.lookup_join(facts, lookup, "key", "full")


def test_measured_bytes_counts_every_value(spark):
    df = literal_table(spark, [("abcd", 1), (None, 2)], "s string, n int")
    empty = df.where("n > 5")
    assert joins.measured_bytes(df, empty) == [(4 + 16) + 16 + 2 * (16 + 48), 0]


def test_nested_values_count_in_full(spark):
    df = spark.range(100).selectExpr(
        "id", "sequence(1, 10000) AS many", "map('k', array('abcdefgh')) AS m", "struct(id, 'x' AS s) AS pair"
    )
    (size,) = joins.measured_bytes(df)
    assert size > 100 * 10_000 * 4
    # arrays made by a function are beyond the estimate's column width, exploded rows beyond any estimate
    assert joins._planned_bytes(spark.range(5).selectExpr("explode(array(1, 2)) AS x")) is None


def test_slices_spread_a_hot_key(spark):
    facts = spark.range(8000).select("id", F.lit("hot").alias("key"))
    lookup = literal_table(spark, [("hot", 1)], "key string, v int")
    hot = joins.hot_keys(facts, ["key"], slice_rows=500)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        joined = joins.sliced_join(facts, lookup, ["key"], "left", ["id"], hot)
        per_task = collections.Counter(
            r.p for r in joined.select(F.spark_partition_id().alias("p")).collect()
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(per_task.values()) == 8000
    assert hot.keys.first()['__slices'] == 16
    assert len(per_task) >= 4 and max(per_task.values()) < 4000


def test_resolve_fk_keeps_unresolved_rows(frames):
    facts, lookup = frames
    dim = lookup.na.drop().withColumnRenamed("key", "code").withColumnRenamed("value", "code_key")
    out = joins.resolve_fk(facts, dim, "key", "code_key", dim_key="code")
    assert out.count() == len(FACTS)
    assert set(out.columns) == {"id", "key", "code_key"}
    wanted = dict(LOOKUP)
    assert all(r.code_key == (wanted.get(r.key) if r.key else None) for r in out.collect())


def test_fk_and_grain_checks_on_skewed_keys(frames):
    facts, lookup = frames
    known = {k for k, _ in LOOKUP if k}
    orphans = sum(k not in known for _, k in FACTS)
    nulls = sum(k is None for _, k in FACTS)
    assert check_fk(facts, "key", lookup, "key", "x", False).first().orphan_count == orphans
    assert check_fk(facts, "key", lookup, "key", "x").first().orphan_count == orphans - nulls
    assert check_grain(facts, "facts", "id").count() == 0
    found = check_grain(facts, "facts", "key").first()
    assert (found.total, found.distinct_keys) == (3000, len({k for _, k in FACTS if k}))
    # a NULL part drops the key, so it is reported
    assert check_grain(facts, "facts", "id", "key").first().distinct_keys == 3000 - nulls
