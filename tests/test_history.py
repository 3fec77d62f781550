"""Histories, as-of lookups and running balances against plain versions; odd rows; keys cut by time."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from assayline.operators import asof, balances, history as h
from assayline.operators.ranged import PART, ranged
from assayline.plans.dimensions import build_dim_listing_condition, build_dim_product, key_facts
from assayline.sources.tables import Medallion

SNAPSHOT = "a string, b int, name string, price double, note string"


@pytest.fixture
def cut_small(spark):
    """Several partitions also for a few rows."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(n)


def snapshot(spark, rows):
    return spark.createDataFrame([(a, b, *rest) for (a, b), rest in rows.items()], SNAPSHOT)


def random_snapshots(rng, days):
    keys = [("x", 1), ("x", None), (None, 1), (None, None), ("y", 2), ("z|", 3), ("z", 4)]
    names = ["n", None, "", "n|m"]
    return [
        {k: (rng.choice(names), rng.choice([1.0, None]), "note") for k in keys if rng.random() < 0.75}
        for _ in range(days)
    ]


def plain_history(snapshots, close_missing):
    """{(key, from): (name, price, note, to)}, one snapshot a day."""
    out, open_ = {}, {}
    for d, rows in enumerate(snapshots):
        for key in set(open_) | set(rows):
            since = open_.get(key)
            if key not in rows:
                if close_missing:
                    out[key, since][3] = day(d)
                    del open_[key]
                continue
            if since is not None and out[key, since][:2] == list(rows[key][:2]):
                out[key, since][2] = rows[key][2]  # not tracked: overwritten
                continue
            if since is not None:
                out[key, since][3] = day(d)
            out[key, day(d)] = [*rows[key], None]
            open_[key] = day(d)
    return {(*k, tuple(v)) for k, v in out.items()}


def rows_of(history):
    return {((r.a, r.b), r.valid_from, (r.name, r.price, r.note, r.valid_to)) for r in history.collect()}


@pytest.mark.parametrize("close_missing", [True, False])
def test_history(spark, close_missing):
    rng = random.Random(1)
    days = random_snapshots(rng, 5)
    got = None
    for d, rows in enumerate(days):
        for again in (random_snapshots(rng, 1)[0], rows, rows) if d else (rows,):
            merged = h.merge_history(got, snapshot(spark, again), ["a", "b"], day(d), ["name", "price"], close_missing)
            got = h.stored(merged, "h")
    assert rows_of(got) == plain_history(days, close_missing)
    assert got.where("is_current <> (valid_to IS NULL)").count() == 0
    assert got.select("version_key").distinct().count() == got.count()
    assert h.check_history(got, "h", ["a", "b"]).select("several_open", "overlaps", "empty_intervals").first() == (0, 0, 0)


def test_columns_that_are_not_tracked(spark):
    got = None
    for d, note in enumerate(["first", "second", "third"]):
        rows = {("x", 1): ("n" if d < 2 else "m", 1.0, note)}
        got = h.stored(h.merge_history(got, snapshot(spark, rows), ["a", "b"], day(d), ["name"]), "h")
    assert rows_of(got) == {
        (("x", 1), day(0), ("n", 1.0, "second", day(2))),
        (("x", 1), day(2), ("m", 1.0, "third", None)),
    }


def test_history_guards(spark):
    one = {("x", 1): ("n", 1.0, "")}
    first = h.merge_history(None, snapshot(spark, one), ["a", "b"], "2024-02-01")
    with pytest.raises(Exception, match="older than a version"):
        h.merge_history(first, snapshot(spark, one), ["a", "b"], "2024-01-01").collect()
    twice = snapshot(spark, one).union(snapshot(spark, one))
    with pytest.raises(Exception, match="duplicate key"):
        h.merge_history(first, twice, ["a", "b"], "2024-03-01").collect()
    broken = first.union(first.withColumn("valid_from", F.lit("2024-01-05").cast("date")))
    checks = h.check_history(broken, "h", ["a", "b"]).first()
    assert (checks.versions, checks.several_open, checks.overlaps) == (2, 1, 1)
    empty = h.check_history(first.limit(0), "h", ["a", "b"]).first()
    assert tuple(empty)[1:] == (0, 0, 0, 0, 0)


def test_empty_snapshots(spark):
    none, one = snapshot(spark, {}), snapshot(spark, {("x", 1): ("n", 1.0, "")})
    start = h.stored(h.merge_history(None, none, ["a", "b"], day(0)), "h")
    assert start.count() == 0
    opened = h.stored(h.merge_history(start, one, ["a", "b"], day(1)), "h")
    closed = h.merge_history(opened, none, ["a", "b"], day(2))
    assert [(r.valid_from, r.valid_to, r.is_current) for r in closed.collect()] == [(day(1), day(2), False)]
    # opened and gone on the same day: it never was
    assert h.merge_history(opened, none, ["a", "b"], day(1)).count() == 0


def test_row_hash(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("", "x"), ("-", "x"), ("1:a", None), ("1", "a")]
    df = spark.createDataFrame(rows, "p string, q string").select(h.row_hash("p", "q").alias("r"))
    assert df.distinct().count() == len(rows)


def test_stored_history(spark, tmp_path):
    """Days of before are not rewritten; reruns and corrections of a day replace it, folders without rows go."""
    layers, rng = Medallion(spark, str(tmp_path)), random.Random(3)
    days = random_snapshots(rng, 4)
    for d, rows in enumerate(days):
        for again in (random_snapshots(rng, 1)[0], rows, rows) if d else (rows,):
            h.refresh_history(layers, "dim", snapshot(spark, again), ["a", "b"], day(d), ["name", "price"])
    assert rows_of(h.read_history(layers, "dim")) == plain_history(days, True)
    past = sorted((tmp_path / "gold" / "dim" / f"closed_on=on-{day(1)}").glob("*.parquet"))
    h.refresh_history(layers, "dim", snapshot(spark, {}), ["a", "b"], day(9))
    assert sorted((tmp_path / "gold" / "dim" / f"closed_on=on-{day(1)}").glob("*.parquet")) == past
    assert h.read_history(layers, "dim", only_open=True).count() == 0
    assert rows_of(h.read_history(layers, "dim")) == plain_history([*days, *[days[-1]] * 5, {}], True)
    with pytest.raises(Exception, match="older than a version"):
        h.refresh_history(layers, "dim", snapshot(spark, days[0]), ["a", "b"], day(0))


def test_dimensions(spark):
    products = spark.createDataFrame([("S1", "n", 1.0, "x"), ("S2", "m", 2.0, "y")], "sku string, product_name string, rrp double, supplier_code string")
    dim = h.stored(build_dim_product(None, products, "2024-01-01"), "dim")
    changed = products.withColumn("rrp", F.col("rrp") + (F.col("sku") == "S1").cast("int")).withColumn("supplier_code", F.lit("z"))
    dim = build_dim_product(dim, changed, "2024-02-01")
    assert sorted((r.sku, r.rrp, r.supplier_code, r.is_current) for r in dim.collect()) == [
        ("S1", 1.0, "x", False), ("S1", 2.0, "z", True), ("S2", 2.0, "z", True)
    ]
    codes = spark.createDataFrame([("NEW", "d"), (None, "e"), ("UNKNOWN", "f")], "code string, description string")
    conditions = build_dim_listing_condition(codes).collect()
    assert sorted((r.code, r.is_known) for r in conditions) == [("NEW", True), ("UNKNOWN", False)]


# -- as-of


def plain_as_of(facts, versions, until):
    out = []
    for f in facts:
        key, at = f[1], f[2]
        fits = [v for v in versions if v[0] == key and None not in (key, at, v[1]) and v[1] <= at]
        best = max(fits, key=lambda v: (v[1], v[2] is not None, v[2] or dt.datetime.min, v[3] is not None, v[3] or "")) if fits else None
        if best and until and best[2] is not None and at >= best[2]:
            best = None
        out.append((*f, best[3] if best else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("until", [None, "until"])
@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_as_of(spark, cut_small, limit, until):
    rng = random.Random(5)
    moment = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)
    keys = ["hot"] * 6 + ["k1", "k2", "none", None]
    facts = [(i, rng.choice(keys), rng.choice([moment(rng.randrange(300)), moment(7), None])) for i in range(800)]
    facts += [(900, "hot", moment(7))] * 50  # rows alike in all columns
    versions = [(rng.choice(keys[:-2] + [None]), moment(3 * rng.randrange(80)), None, f"v{i}") for i in range(60)]
    versions = [(k, a, rng.choice([None, a + dt.timedelta(hours=5)]), rng.choice([v, None])) for k, a, _, v in versions]
    versions += versions[:10] + [("k1", None, None, "x")]
    if until is None:  # the end is part of the order only where it is asked for
        versions = [(k, a, None, v) for k, a, _, v in versions]
    left = spark.createDataFrame(facts, "id int, k string, at timestamp").repartition(5)
    right = spark.createDataFrame(versions, "k string, since timestamp, until timestamp, v string").repartition(3)
    got = asof.as_of_join(left, right, "k", "at", "since", ["v"], until, limit)
    assert got.columns == ["id", "k", "at", "v"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_as_of(facts, versions, until)
    none = asof.as_of_join(left, right.limit(0), "k", "at", "since", ["v"], until, limit)
    assert none.where("v IS NULL").count() == len(facts)
    assert asof.as_of_join(left.limit(0), right, "k", "at", "since", ["v"], until, limit).count() == 0
    with pytest.raises(ValueError, match="already have"):
        asof.as_of_join(left, right, "k", "at", "since", ["id"])


def test_many_versions_are_laid_out(spark, monkeypatch):
    monkeypatch.setattr(asof, "MOST_VERSIONS", 3)
    facts = spark.range(50).select(F.lit("k").alias("k"), F.col("id").alias("at"))
    versions = spark.range(0, 50, 7).select(F.lit("k").alias("k"), F.col("id").alias("since"), F.col("id").alias("v"))
    got = asof.as_of_join(facts, versions, "k", "at", "since", ["v"])
    assert all(r.v == r["at"] // 7 * 7 for r in got.collect()) and "Window" in got._jdf.queryExecution().toString()


def test_hot_key_is_cut(spark, cut_small):
    """A key with nearly all rows spans the partitions, and so do rows of one moment."""
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("at"),
        "id",
    )
    sizes = [r["count"] for r in ranged(rows, ["k"], ["at", "id"]).groupBy(PART).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 8_000


def test_key_facts(spark):
    dim = h.merge_history(None, spark.createDataFrame([("S", 1.0)], "sku string, rrp double"), ["sku"], "2024-01-10")
    from assayline.operators.quality import add_anomaly_columns

    facts = spark.createDataFrame([("S", dt.date(2024, 1, 10)), ("S", dt.date(2024, 1, 9)), (None, dt.date(2024, 2, 1)), ("T", None)], "ref string, d date")
    got = key_facts(add_anomaly_columns(facts), dim, "ref", "d", ["rrp"]).collect()
    assert sorted(((r.ref, r.rrp, r.anomaly_reason_code) for r in got), key=repr) == sorted(
        [("S", 1.0, None), ("S", None, "ORPHAN_FK"), (None, None, None), ("T", None, "ORPHAN_FK")], key=repr
    )


# -- balances


def test_running_balance(spark, cut_small):
    rng = random.Random(7)
    rows = [(rng.choice(["hot"] * 8 + ["a", None]), rng.randrange(20), i, rng.choice([1, -2, 5, None])) for i in range(3000)]
    sums, want = {}, []
    for k, d, i, q in sorted(rows, key=lambda r: (r[1], r[2])):
        sums[k] = sums.get(k, 0) + (q or 0)
        want.append((k, d, i, q, sums[k]))
    df = spark.createDataFrame(rows, "k string, d int, i int, q long").repartition(7)
    got = balances.running_balance(df, ["k"], ["d", "i"], "q")
    assert got.columns == ["k", "d", "i", "q", "balance"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert balances.running_balance(df.limit(0), ["k"], ["d", "i"], "q").count() == 0
