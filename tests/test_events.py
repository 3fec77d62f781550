"""Identities, snapshots, event orders, sessions, clocks and image hashes against plain versions and odd rows."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from assayline.functions.keys import anonymous_key
from assayline.operators import drift, hamming, identity, sequences, sessions as s, snapshots
from assayline.operators.components import connected
from assayline.operators.quality import add_anomaly_columns
from assayline.sources.tables import Medallion
from assayline.streaming import append_sessions, stream_bronze


def plain_components(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_connected(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)]  # a path
    edges += [(500, i) for i in range(300, 340)]  # a star around a large number
    edges += [(rng.randrange(1000, 1080), rng.randrange(1000, 1080)) for _ in range(60)]
    edges = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in edges]
    df = spark.createDataFrame([*edges, *edges[:5], (7, 7), (None, 3), (3, None)], "a long, b long")
    assert dict(map(tuple, connected(df, "a", "b").collect())) == plain_components([e for e in edges if e[0] != e[1]])
    assert connected(df.limit(0), "a", "b").collect() == []


# -- identity

EVIDENCE = [
    identity.Evidence("email", ("email",), 0.9),
    identity.Evidence("both", ("phone", "zip"), 0.75),
    identity.Evidence("name", ("name",), 0.4),
]
PEOPLE = "id long, email string, phone string, zip int, name string, born string"


def plain_identities(rows, limit):
    values = {}
    for r in rows:
        email, phone, zip_, name = r[1:5]
        shown = {0: email, 1: (phone, zip_) if phone and zip_ is not None else None, 2: name}
        for rule, v in shown.items():
            if v is not None and (isinstance(v, tuple) or v.strip()):
                values.setdefault((rule, v), []).append(r[0])
    edges = [(ids[0], i) for (rule, _), ids in values.items() if rule < 2 and len(ids) <= limit for i in ids[1:]]
    groups = plain_components(edges)
    out = {}
    for r in rows:
        mine = [(rule, len(ids)) for (rule, _), ids in values.items() if r[0] in ids]
        left = 1.0
        for rule, n in mine:
            left *= 1 - EVIDENCE[rule].weight if n <= limit else 1
        out[r[0]] = [groups.get(r[0], r[0]), round(1 - left, 9), any(n > limit for _, n in mine)]
    born = {}
    for r in rows:
        born.setdefault(out[r[0]][0], set()).add(r[5])
    return {i: (*v, len(born[v[0]] - {None}) > 1) for i, v in out.items()}


def test_identities(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        email = rng.choice([f"e{rng.randrange(150)}", "shop", None, " "])
        phone = rng.choice([f"p{rng.randrange(60)}", None, ""])
        rows.append((i, email, phone, rng.choice([1, 2, None]), rng.choice([f"n{rng.randrange(300)}", None]), rng.choice(["x", "x", "y", None])))
    df = add_anomaly_columns(spark.createDataFrame(rows, PEOPLE).repartition(5))
    got = identity.resolve_identities(df, "id", EVIDENCE, ["born"], placeholder_above=12)
    anonymous = spark.range(1).select(anonymous_key()).first()[0]
    want = plain_identities(rows, 12)
    out = got.collect()
    assert len(out) == len(rows) and got.columns == [*df.columns, "identity_id", "identity_confidence", "customer_master_key"]
    for r in out:
        codes = (r.anomaly_reason_code or "").split(",")
        flags = ("PLACEHOLDER_ID_COLLISION" in codes, "IDENTITY_AMBIGUOUS" in codes)
        assert (r.identity_id, round(r.identity_confidence, 9), *flags) == want[r.id]
        assert (r.customer_master_key == anonymous) == (r.identity_confidence < 0.7)
    keys = {(r.identity_id, r.customer_master_key) for r in out if r.identity_confidence >= 0.7}
    assert len(keys) == len({k for _, k in keys}) == len({i for i, _ in keys})  # one key an identity
    assert any(r.identity_confidence == 0 for r in out) and any(w[2] for w in want.values())
    assert identity.resolve_identities(df.limit(0), "id", EVIDENCE, ["born"]).count() == 0
    with pytest.raises(ValueError, match="weight"):
        identity.Evidence("x", ("a",), 1.5)


# -- snapshots


def d(n):
    return dt.date(2024, 2, 26) + dt.timedelta(n)


def test_snapshots(spark):
    rows = [("a", d(0), 1), ("a", d(3), 2), ("a", d(4), None), ("b", d(9), 3), (None, d(1), 4), (None, d(3), 5), ("c", None, 6)]
    df = add_anomaly_columns(spark.createDataFrame(rows, "k string, day date, v int"))
    got = snapshots.reconstruct(df, ["k"], "day")
    want = {("a", d(0), 1, d(0)), ("a", d(1), 1, d(0)), ("a", d(2), 1, d(0)), ("a", d(3), 2, d(3)), ("a", d(4), None, d(4)),
            ("b", d(9), 3, d(9)), (None, d(1), 4, d(1)), (None, d(2), 4, d(1)), (None, d(3), 5, d(3)), ("c", None, 6, None)}
    assert {(r.k, r.day, r.v, r.observed_on) for r in got.collect()} == want and got.count() == len(want)
    made = got.where("data_quality_status = 'RECONSTRUCTED'")
    assert {(r.k, r.day) for r in made.collect()} == {("a", d(1)), ("a", d(2)), (None, d(2))}
    gaps = {tuple(r) for r in snapshots.missing_days(df.union(df), ["k"], "day").collect()}
    assert gaps == {("a", d(1), d(2), 2), (None, d(2), d(2), 1)}
    with pytest.raises(Exception, match="duplicate key"):
        snapshots.reconstruct(df.union(df), ["k"], "day").collect()
    assert snapshots.reconstruct(df.limit(0), ["k"], "day").count() == 0


# -- sequences


def test_sequences(spark):
    rows = [
        (1, "payment", d(5)), (1, "cancelled", d(4)), (2, "payment", d(4)), (2, "cancelled", d(4)),
        (3, "shipped", d(3)), (3, "delivered", d(2)), (3, "review", d(1)), (4, "delivered", d(2)), (4, "review", d(2)),
        (5, "bopis", d(1)), (6, "bopis", d(1)), (6, "picked_up", d(0)), (7, "other", d(1)), (8, "bopis", None),
        (9, None, d(1)), (None, "bopis", d(1)), (10, "payment", d(1)), (10, "payment", d(9)), (10, "cancelled", d(5)),
    ]
    log = spark.createDataFrame(rows, "o int, e string, day date").repartition(4)
    got = {r.o: r.anomaly_reason_code for r in sequences.check_sequences(log, "o", "e", "day").collect()}
    assert got == {1: "PAYMENT_AFTER_CANCEL", 2: None, 3: "DELIVERY_BEFORE_SHIP,REVIEW_BEFORE_DELIVERY", 4: None,
                   5: "BOPIS_NO_PICKUP_EVENT", 6: None, 7: None, 8: None, 9: None, 10: "PAYMENT_AFTER_CANCEL"}
    plan = sequences.check_sequences(log, "o", "e", "day")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert sequences.check_sequences(log.limit(0), "o", "e", "day").count() == 0


# -- sessions


def at(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


def test_sessions_and_bridge(spark):
    rows = [("u", at(0)), ("u", at(30)), ("u", at(61)), ("u", at(61)), ("v", at(5)), (None, at(1)), ("v", None)]
    events = spark.createDataFrame(rows, "who string, ts timestamp").repartition(3)
    found = s.sessions(events, "who", "ts")
    assert {tuple(r) for r in found.collect()} == {("u", at(0), at(30), 2), ("u", at(61), at(61), 2), ("v", at(5), at(5), 1)}
    orders = [(1, "u", at(-1)), (2, "u", at(0)), (3, "u", at(15)), (4, "u", at(45)), (5, "u", at(61)), (6, "u", at(121)),
              (7, "u", at(122)), (8, "v", at(6)), (9, "w", at(6)), (10, None, at(6)), (11, "u", None)]
    df = add_anomaly_columns(spark.createDataFrame(orders, "id int, who string, ts timestamp"))
    for limit in (0, 1 << 20):
        got = {r.id: (r.session_start, r.anomaly_reason_code) for r in s.bridge_orders(df, found, "who", "ts", "1 hour", limit).collect()}
        bridged = "ATTRIBUTION_SESSION_BRIDGE"
        assert got == {1: (None, None), 2: (at(0), None), 3: (at(0), None), 4: (at(0), bridged), 5: (at(61), None), 6: (at(61), bridged),
                       7: (None, None), 8: (at(5), bridged), 9: (None, None), 10: (None, None), 11: (None, None)}
    assert s.sessions(events.limit(0), "who", "ts").count() == 0


def test_stream_of_sessions(spark, tmp_path):
    """What the stream has given out is what a batch gives, once events of later show that all are over."""
    layers, rng = Medallion(spark, str(tmp_path)), random.Random(3)
    rows = sorted(((at(rng.randrange(3000)), rng.choice(["u", "v", "w", None])) for _ in range(600)), key=lambda r: r[0])
    for i in range(4):  # files in order of time, rows within the watermark shuffled
        part = rows[150 * i : 150 * (i + 1)]
        rng.shuffle(part)
        layers.write_table(spark.createDataFrame(part, "ts timestamp, who string").coalesce(1), "clicks", "bronze", overwrite=False)
        stream = stream_bronze(layers, "clicks")
        append_sessions(layers, stream, "who", "ts", "sessions", f"{tmp_path}/checkpoint").awaitTermination(120)
    last = spark.createDataFrame([(at(100_000), "end")], "ts timestamp, who string")
    layers.write_table(last, "clicks", "bronze", overwrite=False)
    append_sessions(layers, stream_bronze(layers, "clicks"), "who", "ts", "sessions", f"{tmp_path}/checkpoint").awaitTermination(120)
    batch = s.sessions(layers.read_bronze("clicks").where("who <> 'end'"), "who", "ts")
    out = layers.read_silver("sessions").select(batch.columns)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, batch.collect())) and out.count() > 10


# -- clocks


def test_medians(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["hot"] * 5 + ["b", None]), rng.choice([rng.randrange(50), rng.randrange(10_000), None])) for _ in range(5000)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(6)
    values = {}
    for k, v in rows:
        if v is not None:
            values.setdefault(k, []).append(v)
    want = {k: (len(v), sorted(v)[(len(v) - 1) // 2]) for k, v in values.items()}
    got = {r.k: (r.n, r.median) for r in drift.medians(df, ["k"], "v").collect()}
    assert {k: v for k, v in got.items() if k} == {k: v for k, v in want.items() if k}
    # the stated error of the sketch, in ranks
    for r in drift.medians(df, ["k"], "v", exact=False, accuracy=20).collect():
        rank = sorted(values[r.k]).index(r.median)
        assert abs(rank - want[r.k][0] / 2) <= want[r.k][0] / 20 + 1 + values[r.k].count(r.median)
    assert drift.medians(df.limit(0), ["k"], "v").count() == 0


def test_drift(spark):
    rng = random.Random(5)
    rows = [(f"c{c}", 10 * c % 4 + rng.randrange(5) + (90 if c == 3 else -70 if c == 8 else 0)) for c in range(12) for _ in range(200)]
    df = add_anomaly_columns(spark.createDataFrame(rows + [(None, 1), ("c1", None)], "c string, v long"))
    for exact in (True, False):
        found = drift.clock_drift(df.where("c IS NOT NULL"), "c", "v", exact=exact)
        assert {r.c for r in found.where("drifts").collect()} == {"c3", "c8"}
    flagged = drift.flag_drift(df, found, "c")
    assert flagged.count() == len(rows) + 2 and {r.c for r in flagged.where("anomaly_flag").collect()} == {"c3", "c8"}
    same = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "c string, v long")
    assert drift.clock_drift(same, "c", "v", least=1).where("drifts").count() == 0
    assert drift.clock_drift(same.limit(0), "c", "v").count() == 0


# -- images


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def near_hashes(rng, n, flips):
    out = []
    for _ in range(n):
        h = rng.choice(out) if out and rng.random() < 0.5 else rng.getrandbits(64)
        for bit in rng.sample(range(64), rng.randrange(flips + 1)):
            h ^= 1 << bit
        out.append(h)
    return out


@pytest.mark.parametrize(("distance", "pieces"), [(0, None), (1, 2), (3, None), (3, 4), (3, 6), (5, 7)])
def test_near_pairs(spark, distance, pieces):
    rng = random.Random(distance)
    values = [signed(h) for h in near_hashes(rng, 300, distance + 1)] + [0, -1, None, None]
    df = spark.createDataFrame([(v,) for v in values + values[:20]], "h long").repartition(4)
    distinct = sorted({v for v in values if v is not None})
    want = {(a, b): bin((a ^ b) & (2**64 - 1)).count("1") for a, b in itertools.combinations(distinct, 2)}
    want = {k: v for k, v in want.items() if v <= distance}
    for cell in (hamming.CELL, 5):  # also with hot files on a grid
        rows = hamming.near_pairs(df, "h", distance, pieces, cell).collect()
        assert {(r.a, r.b): r.distance for r in rows} == want and len(rows) == len(want)


def test_pieces():
    for m in range(1, 12):
        masks = hamming.piece_masks(m)
        assert sum(masks) == 2**64 - 1 and all(a & b == 0 for a, b in itertools.combinations(masks, 2))
    assert [hamming.choose_pieces(n, 3) for n in (0, 10**6, 10**8, 10**9, 10**12)] == [4, 4, 5, 5, 7]


def test_hot_piece_is_cut(spark):
    """Hashes that agree in three of four pieces: nearly one file, compared in many cells."""
    df = spark.range(3000).select((F.col("id") * 2**48).alias("h"))
    got = hamming.near_pairs(df, "h", 3, 4, cell=200)
    want = sum(bin(a ^ b).count("1") <= 3 for a, b in itertools.combinations(range(3000), 2))
    assert got.count() == want


def test_reused_images(spark):
    rows = [(1, "s", 7), (2, "s", 6), (3, "t", 7), (4, "t", 5 << 40), (5, None, 7), (6, "t", None), (7, "u", None), (8, "u", 5 << 40)]
    df = add_anomaly_columns(spark.createDataFrame(rows, "id long, seller string, h long"))
    out = {r.id: r for r in hamming.flag_reused_images(df, "id", "seller", "h", 1).collect()}
    assert len(out) == len(rows) and [i for i, r in sorted(out.items()) if r.anomaly_flag] == [3, 8]
    assert out[2].image == 6 and out[3].first_listing == 1 and out[6].image is None
    assert hamming.flag_reused_images(df.limit(0), "id", "seller", "h").count() == 0
    with pytest.raises(ValueError):
        hamming.near_pairs(df, "h", 3, 3)
