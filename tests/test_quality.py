import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from assayline.operators.quality import (
    Rule,
    add_anomaly_columns,
    flag,
    flag_all,
    flag_orphan_fk,
    standardise_date,
)
from assayline.registry import CERTAINTIES, QUALITY_COLUMNS, REASON_CODES, STATUSES
from assayline.sources.literals import literal_table

SCHEMA = (
    "id int, anomaly_flag boolean, anomaly_reason_code string, data_quality_status string, "
    "metric_certainty_level string, a boolean, b boolean, c boolean"
)
BOOLS = [True, False, None]


def quality(df):
    return [tuple(r) for r in df.orderBy("id").select(*QUALITY_COLUMNS).collect()]


def test_registry_sizes():
    assert len(REASON_CODES) == len(set(REASON_CODES)) == 40


def test_defaults_reset_and_reject_unknown_words(spark):
    df = literal_table(spark, [(1,), (2,)], "id int")
    flagged = flag(add_anomaly_columns(df), F.col("id") == 1, "OVERSELL")
    assert quality(add_anomaly_columns(flagged)) == [(False, None, "CLEAN", "CONFIRMED")] * 2
    with pytest.raises(ValueError):
        add_anomaly_columns(df, default_status="DIRTY")
    with pytest.raises(ValueError):
        add_anomaly_columns(df, default_certainty="SURE")
    with pytest.raises(ValueError):
        flag(flagged, F.lit(True), "X", status="BAD")
    with pytest.raises(ValueError):
        flag(flagged, F.lit(True), "X", certainty="BAD")


def test_flag_merging(spark):
    df = add_anomaly_columns(literal_table(spark, [(1,)], "id int"))
    df = flag(df, F.lit(None).cast("boolean"), "NEVER")
    df = flag(df, F.lit(True), "A", "EXCLUDED_WITH_REASON", "ESTIMATED")
    df = flag(df, F.lit(True), "B", "FLAGGED_AMBIGUOUS")
    df = flag(df, F.lit(True), "A", "FLAGGED_ANOMALY", "INFERRED")
    assert quality(df) == [(True, "A,B", "EXCLUDED_WITH_REASON", "ESTIMATED")]


def test_condition_sees_the_row_as_it_came_in(spark):
    df = add_anomaly_columns(literal_table(spark, [(1,), (2,)], "id int"))
    df = flag(df, ~F.col("anomaly_flag"), "A")
    assert quality(df) == [(True, "A", "FLAGGED_ANOMALY", "CONFIRMED")] * 2


def _expected(row, rules):
    """The rules one after the other, in plain Python."""
    flagged, reason, status, certainty, *hits = row
    for hit, (code, new_status, new_certainty) in zip(hits, rules):
        if not hit:
            continue
        flagged = True
        held = reason.split(",") if reason is not None else []
        reason = ",".join(dict.fromkeys([*held, code]))
        rank = {s: i for i, s in enumerate(STATUSES)}
        if rank[new_status] > rank.get(status, -1):
            status = new_status
        rank = {s: i for i, s in enumerate(CERTAINTIES)}
        if new_certainty and rank[new_certainty] > rank.get(certainty, -1):
            certainty = new_certainty
    return flagged, reason, status, certainty


row = st.tuples(
    st.booleans(),
    st.sampled_from([None, "A", "B,A", "Z"]),
    st.sampled_from([*STATUSES, None, "ODD"]),
    st.sampled_from([*CERTAINTIES, None]),
    st.sampled_from(BOOLS),
    st.sampled_from(BOOLS),
    st.sampled_from(BOOLS),
)
rule = st.tuples(
    st.sampled_from(["A", "B", "C"]),
    st.sampled_from(STATUSES),
    st.sampled_from([None, *CERTAINTIES]),
)


@settings(max_examples=12, deadline=None)
@given(st.lists(row, min_size=1, max_size=12), st.lists(rule, min_size=3, max_size=3))
def test_flag_all_equals_rules_in_sequence(spark, rows, rules):
    df = literal_table(spark, [(i, *r) for i, r in enumerate(rows)], SCHEMA)
    made = [Rule(F.col(c), *r) for c, r in zip("abc", rules)]
    want = [_expected(r, rules) for r in rows]
    together = flag_all(df, made)
    assert together.columns == df.columns
    assert quality(together) == want
    one_by_one = df
    for r in made:
        one_by_one = flag_all(one_by_one, [r])
    assert quality(one_by_one) == want
    assert quality(flag_all(together, made[:1] + made)) == want or len({r[0] for r in rules}) < 3


def test_orphans_with_and_without_a_source_key(spark):
    df = add_anomaly_columns(
        literal_table(spark, [(1, 5, None), (2, None, None), (3, 5, "k")], "id int, fk int, key string")
    )
    assert [q[0] for q in quality(flag_orphan_fk(df, "key"))] == [True, True, False]
    assert [q[0] for q in quality(flag_orphan_fk(df, "key", "fk"))] == [True, False, False]


def test_standardise_date_keeps_the_text(spark):
    df = add_anomaly_columns(
        literal_table(spark, [(1, "31/02/2024"), (2, None), (3, "01/08/2024")], "id int, d string")
    )
    out = standardise_date(df, "d", "ddmmyyyy").orderBy("id").collect()
    assert [str(r.d) for r in out] == ["None", "None", "2024-08-01"]
    assert [r.d_raw for r in out] == ["31/02/2024", None, "01/08/2024"]
    assert [r.anomaly_reason_code for r in out] == ["DATE_PARSE_FAIL", None, None]


def test_flags_stay_in_generated_code(spark):
    df = add_anomaly_columns(spark.range(10))
    rules = [Rule(F.col("id") > i, f"C{i}", STATUSES[i % 5], CERTAINTIES[i % 4]) for i in range(12)]
    plan = flag_all(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("*(") == len(plan.strip().splitlines())
