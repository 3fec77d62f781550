"""Identities, snapshots, event orders, sessions, clocks and images."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayline.operators.drift import clock_drift as drift_of, flag_drift, medians
from assayline.operators.hamming import flag_reused_images, near_pairs
from assayline.operators.identity import Evidence, resolve_identities
from assayline.operators.quality import add_anomaly_columns
from assayline.operators.sequences import check_sequences
from assayline.operators.sessions import bridge_orders, sessions
from assayline.operators.snapshots import missing_days, reconstruct
from assayline.samples.registry import Source, query
from assayline.sources.scratch import stored

EVIDENCE = (
    Evidence("email", ("email",), 0.9),
    Evidence("phone and segment", ("phone", "segment"), 0.75),
    Evidence("phone", ("phone",), 0.5),
    Evidence("name", ("full_name",), 0.45),
)


def _quality(fires: str, code: str, status: str = "FLAGGED_ANOMALY", certainty: str = "UNRELIABLE") -> str:
    return f"""{fires} AS anomaly_flag, CASE WHEN {fires} THEN '{code}' END AS anomaly_reason_code,
       CASE WHEN {fires} THEN '{status}' ELSE 'CLEAN' END AS data_quality_status,
       CASE WHEN {fires} THEN '{certainty}' ELSE 'CONFIRMED' END AS metric_certainty_level"""


@query(
    """
WITH RECURSIVE v_real AS (
  SELECT record_id, CASE WHEN trim(email) <> '' THEN email END AS email, phone, full_name, segment FROM v_contacts),
v_keys AS (
  SELECT record_id, 0 AS rule, email AS value FROM v_real WHERE email IS NOT NULL
  UNION ALL SELECT record_id, 1, phone || '/' || segment FROM v_real WHERE phone IS NOT NULL
  UNION ALL SELECT record_id, 2, phone FROM v_real WHERE phone IS NOT NULL
  UNION ALL SELECT record_id, 3, full_name FROM v_real WHERE full_name IS NOT NULL),
v_n AS (SELECT *, count(*) OVER (PARTITION BY rule, value) AS n FROM v_keys),
v_ties AS (SELECT DISTINCT a.record_id AS a, b.record_id AS b
           FROM v_n a JOIN v_n b ON a.rule = b.rule AND a.value = b.value AND a.record_id <> b.record_id
           WHERE a.rule <= 1 AND a.n <= 50),
v_reach(a, b) AS (SELECT a, b FROM v_ties UNION SELECT r.a, t.b FROM v_reach r JOIN v_ties t ON r.b = t.a),
v_first AS (SELECT a, min(least(a, b)) AS identity_id FROM v_reach GROUP BY a),
v_use AS (SELECT record_id, bool_or(rule = 0 AND n <= 50) AS u0, bool_or(rule = 1 AND n <= 50) AS u1,
                 bool_or(rule = 2 AND n <= 50) AS u2, bool_or(rule = 3 AND n <= 50) AS u3, bool_or(n > 50) AS many
          FROM v_n GROUP BY record_id),
v_all AS (SELECT c.record_id, c.segment, coalesce(identity_id, c.record_id) AS identity_id, coalesce(many, FALSE) AS many,
                 CAST(1.0 AS DOUBLE) - (((CAST(1.0 AS DOUBLE) * CASE WHEN u0 THEN CAST(1.0 AS DOUBLE) - CAST(0.9 AS DOUBLE) ELSE 1.0 END)
                 * CASE WHEN u1 THEN CAST(1.0 AS DOUBLE) - CAST(0.75 AS DOUBLE) ELSE 1.0 END)
                 * CASE WHEN u2 THEN CAST(1.0 AS DOUBLE) - CAST(0.5 AS DOUBLE) ELSE 1.0 END)
                 * CASE WHEN u3 THEN CAST(1.0 AS DOUBLE) - CAST(0.45 AS DOUBLE) ELSE 1.0 END AS identity_confidence
          FROM v_contacts c LEFT JOIN v_first ON a = c.record_id LEFT JOIN v_use USING (record_id)),
v_torn AS (SELECT *, min(segment) OVER (PARTITION BY identity_id) < max(segment) OVER (PARTITION BY identity_id) AS torn FROM v_all)
SELECT record_id, identity_id, identity_confidence,
       CASE WHEN identity_confidence < CAST(0.7 AS DOUBLE) THEN sha256('__ANON_BUCKET__') ELSE sha256(CAST(identity_id AS VARCHAR)) END
           AS customer_master_key,
       many OR torn AS anomaly_flag,
       NULLIF(concat_ws(',', CASE WHEN many THEN 'PLACEHOLDER_ID_COLLISION' END, CASE WHEN torn THEN 'IDENTITY_AMBIGUOUS' END), '')
           AS anomaly_reason_code,
       CASE WHEN many THEN 'FLAGGED_ANOMALY' WHEN torn THEN 'FLAGGED_AMBIGUOUS' ELSE 'CLEAN' END AS data_quality_status,
       CASE WHEN many OR torn THEN 'UNRELIABLE' ELSE 'CONFIRMED' END AS metric_certainty_level
FROM v_torn""",
    "contacts",
)
def customer_identities(t: Source) -> DataFrame:
    records = add_anomaly_columns(stored(t.v("contacts"), "contacts"))
    found = resolve_identities(records, "record_id", EVIDENCE, ["segment"], placeholder_above=50)
    return found.drop("email", "phone", "full_name", "segment")


@query(
    """
WITH d AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders),
n AS (SELECT *, lead(day) OVER (PARTITION BY o_custkey ORDER BY day) AS next_day FROM d)
SELECT o_custkey, CAST(day + 1 AS DATE) AS gap_from, CAST(next_day - 1 AS DATE) AS gap_to, CAST(next_day - day - 1 AS INTEGER) AS n_days
FROM n WHERE next_day > day + 1"""
)
def missing_order_days(t: Source) -> DataFrame:
    return missing_days(t.orders.withColumn("day", F.col("o_orderdate").cast("date")), ["o_custkey"], "day")


@query(
    """
WITH s AS (SELECT o_custkey % 25 AS store_id, CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1, 2),
n AS (SELECT *, lead(day) OVER (PARTITION BY store_id ORDER BY day) AS next_day FROM s),
f AS (SELECT store_id, CAST(unnest(generate_series(day::TIMESTAMP, (coalesce(next_day - 1, day))::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day,
             orders, day AS observed_on FROM n)
SELECT *, day > observed_on AS anomaly_flag,
       CASE WHEN day > observed_on THEN 'MISSING_SNAPSHOT_DAY,RECONSTRUCTED_SNAPSHOT' END AS anomaly_reason_code,
       CASE WHEN day > observed_on THEN 'RECONSTRUCTED' ELSE 'CLEAN' END AS data_quality_status,
       CASE WHEN day > observed_on THEN 'INFERRED' ELSE 'CONFIRMED' END AS metric_certainty_level
FROM f"""
)
def reconstructed_snapshots(t: Source) -> DataFrame:
    """Orders of a store and day, days without any filled from the day before."""
    daily = t.orders.groupBy((F.col("o_custkey") % 25).alias("store_id"), F.col("o_orderdate").cast("date").alias("day"))
    snapshots = daily.agg(F.count(F.lit(1)).alias("orders"))
    return reconstruct(add_anomaly_columns(snapshots), ["store_id"], "day")


@query(
    """
WITH t AS (
  SELECT order_key, min(day) FILTER (event = 'payment') AS first_payment, max(day) FILTER (event = 'payment') AS last_payment,
         min(day) FILTER (event = 'cancelled') AS first_cancelled, min(day) FILTER (event = 'delivered') AS first_delivered,
         min(day) FILTER (event = 'shipped') AS first_shipped, min(day) FILTER (event = 'picked_up') AS first_picked_up,
         min(day) FILTER (event = 'bopis') AS first_bopis, min(day) FILTER (event = 'review') AS first_review
  FROM v_order_log GROUP BY order_key),
r AS (SELECT order_key, coalesce(last_payment > first_cancelled, FALSE) AS a, coalesce(first_delivered < first_shipped, FALSE) AS b,
             first_bopis IS NOT NULL AND first_picked_up IS NULL AS c, coalesce(first_review < first_delivered, FALSE) AS d FROM t)
SELECT order_key, a OR b OR c OR d AS anomaly_flag,
       NULLIF(concat_ws(',', CASE WHEN a THEN 'PAYMENT_AFTER_CANCEL' END, CASE WHEN b THEN 'DELIVERY_BEFORE_SHIP' END,
              CASE WHEN c THEN 'BOPIS_NO_PICKUP_EVENT' END, CASE WHEN d THEN 'REVIEW_BEFORE_DELIVERY' END), '') AS anomaly_reason_code,
       CASE WHEN a OR b OR c OR d THEN 'FLAGGED_ANOMALY' ELSE 'CLEAN' END AS data_quality_status,
       CASE WHEN a OR b OR c OR d THEN 'UNRELIABLE' ELSE 'CONFIRMED' END AS metric_certainty_level
FROM r""",
    "order_log",
)
def order_sequences(t: Source) -> DataFrame:
    found = check_sequences(t.v("order_log"), "order_key", "event", "day")
    return found.select("order_key", "anomaly_flag", "anomaly_reason_code", "data_quality_status", "metric_certainty_level")


_SESSIONS = """
v_last AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events WHERE event_type <> 'purchase'),
v_run AS (SELECT *, sum(CASE WHEN ts <= before + INTERVAL 6 HOUR THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts) AS run FROM v_last),
v_sessions AS (SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events FROM v_run GROUP BY user_id, run)"""


def _sessions(t: Source) -> DataFrame:
    return sessions(t.events.where("event_type <> 'purchase'"), "user_id", "ts", "6 hours")


_TEXT = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f') AS {0}"


def _texts(df: DataFrame) -> DataFrame:
    """Session times as texts, which both engines write alike."""
    names = ("session_start", "session_end")
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in names})


@query(
    f"""
WITH {_SESSIONS}
SELECT user_id, n_events, {_TEXT.format("session_start")}, {_TEXT.format("session_end")} FROM v_sessions"""
)
def user_sessions(t: Source) -> DataFrame:
    return _texts(_sessions(t))


@query(
    f"""
WITH {_SESSIONS},
m AS (SELECT e.event_id, e.ts, s.session_start, s.session_end
      FROM (SELECT * FROM events WHERE event_type = 'purchase') e
      ASOF LEFT JOIN v_sessions s ON e.user_id = s.user_id AND e.ts >= s.session_start),
k AS (SELECT event_id, ts, CASE WHEN ts <= session_end + INTERVAL 24 HOUR THEN session_start END AS session_start,
             CASE WHEN ts <= session_end + INTERVAL 24 HOUR THEN session_end END AS session_end FROM m),
b AS (SELECT *, coalesce(ts > session_end, FALSE) AS bridged FROM k)
SELECT event_id, {_TEXT.format("session_start")}, {_TEXT.format("session_end")}, {_quality("bridged", "ATTRIBUTION_SESSION_BRIDGE", "FLAGGED_AMBIGUOUS", "INFERRED")}
FROM b"""
)
def order_sessions(t: Source) -> DataFrame:
    """Purchases with the session they came from, or the one they are bridged to."""
    orders = add_anomaly_columns(t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts"))
    return _texts(bridge_orders(orders, _sessions(t), "user_id", "ts")).drop("user_id", "ts")


_DRIFT = """
v_ranked AS (SELECT courier, delay_days, row_number() OVER (PARTITION BY courier ORDER BY delay_days) AS k,
                    count(*) OVER (PARTITION BY courier) AS n FROM v_deliveries WHERE delay_days IS NOT NULL),
v_med AS (SELECT courier, n, min(delay_days) AS median FROM v_ranked WHERE 2 * k >= n GROUP BY courier, n),
v_mid AS (SELECT min(median) AS overall FROM (SELECT median, row_number() OVER (ORDER BY median) AS k, count(*) OVER () AS n FROM v_med)
          WHERE 2 * k >= n),
v_away AS (SELECT v_med.*, overall, median - overall AS "offset" FROM v_med, v_mid),
v_mad AS (SELECT min(a) AS mad FROM (SELECT abs("offset") AS a, row_number() OVER (ORDER BY abs("offset")) AS k, count(*) OVER () AS n
          FROM v_away) WHERE 2 * k >= n),
v_drift AS (SELECT courier, n, median, overall, mad, "offset", abs("offset") > 5 * mad AND abs("offset") > 3 AS drifts FROM v_away, v_mad)"""


def _drift(t: Source) -> DataFrame:
    return drift_of(t.v("deliveries"), "courier", "delay_days", least=3)


@query(f"WITH {_DRIFT} SELECT * FROM v_drift", "deliveries")
def clock_drift(t: Source) -> DataFrame:
    return _drift(t)


@query(
    f"""
WITH {_DRIFT},
f AS (SELECT l_orderkey, l_linenumber, CASE WHEN drifts THEN "offset" END AS clock_offset, drifts
      FROM v_deliveries LEFT JOIN v_drift USING (courier))
SELECT l_orderkey, l_linenumber, clock_offset, {_quality("drifts", "COURIER_CLOCK_DRIFT", certainty="ESTIMATED")} FROM f""",
    "deliveries",
)
def deliveries_flagged(t: Source) -> DataFrame:
    rows = add_anomaly_columns(t.v("deliveries").drop("delay_days"))
    return flag_drift(rows, stored(_drift(t), "drift"), "courier").drop("courier")


@query(
    """
WITH r AS (SELECT l_returnflag, l_linestatus, l_extendedprice AS v, count(*) OVER w AS n,
                  row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_extendedprice) AS k
           FROM lineitem WINDOW w AS (PARTITION BY l_returnflag, l_linestatus))
SELECT l_returnflag, l_linestatus, n, min(v) AS median FROM r WHERE 2 * k >= n GROUP BY l_returnflag, l_linestatus, n"""
)
def exact_medians(t: Source) -> DataFrame:
    """Medians of a few keys with many values each, without a task that holds them all."""
    return medians(t.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice")


# each picture is listed twice or three times: as it is, and with up to four bits changed
_HASH_SQL = """
v_signs AS (SELECT vec_id, CAST(list_sum(list_transform(embedding[1:63], lambda x, i: CASE WHEN x > 0 THEN CAST(1 AS BIGINT) << (i - 1) ELSE 0 END))
                   + CASE WHEN embedding[64] > 0 THEN -9223372036854775808 ELSE 0 END AS BIGINT) AS h FROM embeddings),
v_images AS (SELECT vec_id * 3 AS listing_id, vec_id % 7 AS seller_id, h AS image_hash FROM v_signs
  UNION ALL SELECT vec_id * 3 + 1, vec_id % 5, xor(h, CAST([0, 1, 257, 65793, 16843009][vec_id % 5 + 1] AS BIGINT)) FROM v_signs
  UNION ALL SELECT vec_id * 3 + 2, vec_id % 7, CASE WHEN vec_id % 11 <> 0 THEN xor(h, CAST(4611686018427387904 AS BIGINT)) END
            FROM v_signs WHERE vec_id % 2 = 0)"""


def _images(t: Source) -> DataFrame:
    bits = F.transform("embedding", lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(0))
    h = F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    signs = t.embeddings.select("vec_id", h.alias("h"))
    # fixed values: no to four bits
    changes = F.array(*[F.lit(m).cast("long") for m in (0, 1, 257, 65793, 16843009)])
    some = F.get(changes, (F.col("vec_id") % 5).cast("int"))
    flipped = F.when(F.col("vec_id") % 11 != 0, F.col("h").bitwiseXOR(F.lit(1 << 62)))
    parts = [
        signs.select((F.col("vec_id") * 3).alias("listing_id"), (F.col("vec_id") % 7).alias("seller_id"), F.col("h").alias("image_hash")),
        signs.select(F.col("vec_id") * 3 + 1, F.col("vec_id") % 5, F.col("h").bitwiseXOR(some)),
        signs.where("vec_id % 2 = 0").select(F.col("vec_id") * 3 + 2, F.col("vec_id") % 7, flipped),
    ]
    return stored(parts[0].union(parts[1]).union(parts[2]), "images")


@query(
    f"""
WITH {_HASH_SQL},
d AS (SELECT DISTINCT image_hash AS h FROM v_images WHERE image_hash IS NOT NULL)
SELECT a.h AS a, b.h AS b, CAST(bit_count(xor(a.h, b.h)) AS INTEGER) AS distance
FROM d a JOIN d b ON a.h < b.h WHERE bit_count(xor(a.h, b.h)) <= 3"""
)
def near_image_hashes(t: Source) -> DataFrame:
    return near_pairs(_images(t), "image_hash")


@query(
    f"""
WITH RECURSIVE {_HASH_SQL},
d AS (SELECT DISTINCT image_hash AS h FROM v_images WHERE image_hash IS NOT NULL),
e AS (SELECT a.h AS a, b.h AS b FROM d a JOIN d b ON bit_count(xor(a.h, b.h)) <= 3),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS image_hash, min(b) AS image FROM r GROUP BY a),
i AS (SELECT v.*, image FROM v_images v LEFT JOIN c USING (image_hash)),
f AS (SELECT image, min(listing_id) AS first_listing, arg_min(seller_id, listing_id) AS first_seller FROM i WHERE image IS NOT NULL GROUP BY image),
g AS (SELECT i.*, first_listing, first_seller, coalesce(first_seller <> seller_id, FALSE) AS reused FROM i LEFT JOIN f USING (image))
SELECT listing_id, seller_id, image_hash, image, first_listing, first_seller,
       {_quality("reused", "IMAGE_HASH_REUSED", certainty="ESTIMATED")} FROM g"""
)
def reused_images(t: Source) -> DataFrame:
    return flag_reused_images(add_anomaly_columns(_images(t)), "listing_id", "seller_id", "image_hash")
