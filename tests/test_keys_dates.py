import datetime as dt
import hashlib

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from assayline.functions import (
    anonymous_key,
    composite_business_key,
    identity_key,
    is_parse_failure,
    parse_date,
    parse_pg_timestamp,
    surrogate_key,
    word_overlap_ratio,
)
from assayline.sources.literals import literal_table


def values(spark, rows, schema, *cols):
    return [tuple(r) for r in literal_table(spark, rows, schema).select(*cols).collect()]


def test_surrogate_key_is_a_stable_contract(spark):
    rows = [(None, None), ("a", None), ("a|b", "c"), ("a", "b|c"), ("~NULL~", "x"), (None, "x")]
    got = values(
        spark, rows, "a string, b string",
        surrogate_key(F.col("a")), surrogate_key(F.col("a"), F.col("b")),
    )
    assert got[0][0] == "fe8392a2dbe46931b4fd160a7c62b0a998a851e8073bffe6474f3f7161474cf2"
    assert got[1][1] == "2a128629f8a2fd5217fa94f9c0f1f59657140da3f83957235784c4b701be1683"
    assert got[2][1] == got[3][1]  # separator collision, kept
    assert got[4][1] == got[5][1]  # sentinel collision, kept


def test_keys_need_a_column():
    for key in (surrogate_key, composite_business_key):
        with pytest.raises(ValueError):
            key()


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.none() | st.text(max_size=6), st.none() | st.integers(-9, 9)), min_size=1, max_size=6))
def test_surrogate_key_equals_sha256_of_the_text(spark, rows):
    got = values(
        spark, rows, "a string, b bigint",
        surrogate_key(F.col("a"), F.col("b")), composite_business_key(F.col("a"), F.col("b")),
    )
    for (key, text), row in zip(got, rows):
        want = "|".join("~NULL~" if v is None else str(v) for v in row)
        assert text == want
        assert key == hashlib.sha256(want.encode()).hexdigest()


def test_identity_key_routes_low_confidence(spark):
    anon = hashlib.sha256(b"__ANON_BUCKET__").hexdigest()
    own = hashlib.sha256(b"me").hexdigest()
    rows = [(0.69, "me"), (0.70, "me"), (None, "me")]
    got = values(
        spark, rows, "c double, n string", identity_key(F.col("c"), F.col("n")), anonymous_key("GUEST")
    )
    assert [g[0] for g in got] == [anon, own, own]
    assert {g[1] for g in got} == {hashlib.sha256(b"__GUEST_BUCKET__").hexdigest()}


D, T = dt.date, dt.datetime
CASES = [
    ("ddmmyyyy", "08/08/2024", D(2024, 8, 8)),
    ("ddmmyyyy", "01/08/2024", D(2024, 8, 1)),
    ("ddmmyyyy", "31/02/2024", None),
    ("ddmmyyyy", "1/8/2024", None),
    ("ddmmyyyy", "2024-08-08", None),
    ("ddmmyyyy", "", None),
    ("iso_date", "2024-08-08", D(2024, 8, 8)),
    ("iso_date", "2024-13-01", None),
    ("ddmonyyyy", "05-Sep-2024", D(2024, 9, 5)),
    ("ddmonyyyy", "05-SEP-2024", D(2024, 9, 5)),
    ("ddmonyyyy", "05-Sept-2024", None),
    ("ddmonyyyy", "5-Sep-2024", None),
    ("slash_datetime", "2024/08/08 14:23", T(2024, 8, 8, 14, 23)),
    ("slash_datetime", "2024/8/8 14:23", None),
    ("iso_timestamp", "2024-08-08T14:23:00", T(2024, 8, 8, 14, 23)),
    ("iso_timestamp", "x", None),
    ("unix_epoch", "1723046400", T(2024, 8, 7, 16)),
    ("unix_epoch", "abc", None),
    ("unix_epoch", "9223372036854775807", None),
    ("unix_epoch", "99999999999999999999", None),
    ("pg_timestamp", "1723046400", T(2024, 8, 7, 16)),
]


@pytest.mark.parametrize("hint", sorted({c[0] for c in CASES}))
def test_parsers(spark, hint):
    cases = [c[1:] for c in CASES if c[0] == hint]
    parsed = parse_date(F.col("raw"), hint)
    shown = parsed if hint in ("ddmmyyyy", "iso_date", "ddmonyyyy") else parsed.cast("timestamp_ntz")
    got = values(
        spark, [(raw,) for raw, _ in cases] + [(None,)], "raw string",
        shown, is_parse_failure(parsed, F.col("raw")),
    )
    want = [(value, value is None) for _, value in cases] + [(None, False)]
    assert got == want


def test_epoch_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Karachi")
        seconds = F.unix_seconds(parse_date(F.col("n"), "unix_epoch"))
        assert values(spark, [(1723046400,)], "n bigint", seconds) == [(1723046400,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_pg_text_format_and_bad_arguments(spark):
    text = parse_pg_timestamp(F.col("raw"), "string").cast("timestamp_ntz")
    got = values(spark, [("2024-08-07 16:00:00",), ("2024",)], "raw string", text)
    assert got == [(T(2024, 8, 7, 16),), (None,)]
    with pytest.raises(ValueError):
        parse_pg_timestamp(F.col("raw"), "iso")
    with pytest.raises(ValueError):
        parse_date(F.col("raw"), "mmddyyyy")


def test_word_overlap(spark):
    rows = [
        ("a a", "a a", 0.5),
        ("", "", 1.0),
        (None, "x", 0.0),
        ("x", None, 0.0),
        ("Foo, Bar", "foo bar", 0.5),
        ("Foo - Bar", "foo bar", 1.0),
        ("Foo—Bar", "BAR foo", 1.0),
    ]
    got = values(
        spark, rows, "a string, b string, want double",
        word_overlap_ratio(F.col("a"), F.col("b")), "want",
    )
    assert all(a == b for a, b in got)
