"""The four quality columns and the rules that fill them.

A rule says: where ``condition`` holds, add ``reason_code`` and raise the row to
at least ``status`` and ``certainty``. ``flag_all`` applies any number of rules
in a single projection, so a build with twenty rules still has one narrow stage
and no nested rewriting of the same four columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline.functions.dates import is_parse_failure, parse_date
from assayline.registry import CERTAINTIES, STATUSES

FLAG, REASON = "anomaly_flag", "anomaly_reason_code"
STATUS, CERTAINTY = "data_quality_status", "metric_certainty_level"


def _require(value: str, scale: Sequence[str], what: str) -> None:
    if value not in scale:
        raise ValueError(f"{what} {value!r} is not one of {', '.join(scale)}")


@dataclass(frozen=True)
class Rule:
    """One detection rule. ``certainty=None`` leaves the certainty as it is.

    The condition may read any column except the four quality columns of the
    same ``flag_all`` call; a rule about those belongs in a call of its own.
    """

    condition: Column
    reason_code: str
    status: str = "FLAGGED_ANOMALY"
    certainty: str | None = None

    def __post_init__(self) -> None:
        _require(self.status, STATUSES, "status")
        if self.certainty is not None:
            _require(self.certainty, CERTAINTIES, "certainty")

    @property
    def fires(self) -> Column:
        """The condition, with NULL read as "does not hold"."""
        return F.ifnull(self.condition, F.lit(False))


def add_anomaly_columns(
    df: DataFrame, default_status: str = "CLEAN", default_certainty: str = "CONFIRMED"
) -> DataFrame:
    """Append the quality columns in their unflagged state (resets old values)."""
    _require(default_status, STATUSES, "default_status")
    _require(default_certainty, CERTAINTIES, "default_certainty")
    return df.withColumns(
        {
            FLAG: F.lit(False),
            REASON: F.lit(None).cast("string"),
            STATUS: F.lit(default_status),
            CERTAINTY: F.lit(default_certainty),
        }
    )


def severity(value: Column, scale: Sequence[str]) -> Column:
    """1-based place on a scale; 0 for NULL and for words not on it."""
    place = F.array_position(F.array(*map(F.lit, scale)), value)
    return F.ifnull(place, F.lit(0)).cast("int")


def level_at(place: Column, scale: Sequence[str]) -> Column:
    """The word at a 1-based place; NULL outside the scale."""
    return F.get(F.array(*map(F.lit, scale)), place - 1)


def _raised(name: str, scale: Sequence[str], levels: list[tuple[Column, str]]) -> Column:
    """Column ``name`` raised to the worst level among those that fire."""
    if not levels:
        return F.col(name)
    reached = [F.when(fires, F.lit(scale.index(level) + 1)).otherwise(0) for fires, level in levels]
    worst = reached[0] if len(reached) == 1 else F.greatest(*reached)
    current = F.col(name)
    return F.when(worst > severity(current, scale), level_at(worst, scale)).otherwise(current)


def flag_all(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Apply rules in order, as if flagged one after the other.

    Reason codes are appended without repeats, severities only ever rise, and
    a row on which no rule fires is passed through untouched.
    """
    if not rules:
        return df
    names = [f"__hit_{i}" for i in range(len(rules))]
    # a projection of its own: each condition is evaluated once, not per column
    hits = df.withColumns({name: rule.fires for name, rule in zip(names, rules)})
    fires = [F.col(name) for name in names]
    any_fires = reduce(lambda a, b: a | b, fires)
    codes = [F.when(hit, F.lit(rule.reason_code)) for hit, rule in zip(fires, rules)]
    all_codes = F.split(F.concat_ws(",", F.col(REASON), *codes), ",")  # NULLs are skipped
    merged = F.concat_ws(",", F.array_distinct(all_codes))
    certainties = [(hit, rule.certainty) for hit, rule in zip(fires, rules) if rule.certainty]
    return hits.withColumns(
        {
            FLAG: F.col(FLAG) | any_fires,
            REASON: F.when(any_fires, merged).otherwise(F.col(REASON)),
            STATUS: _raised(STATUS, STATUSES, [(h, r.status) for h, r in zip(fires, rules)]),
            CERTAINTY: _raised(CERTAINTY, CERTAINTIES, certainties),
        }
    ).drop(*names)


def flag(
    df: DataFrame,
    condition: Column,
    reason_code: str,
    status: str = "FLAGGED_ANOMALY",
    certainty: str | None = None,
) -> DataFrame:
    """Apply one rule."""
    return flag_all(df, [Rule(condition, reason_code, status, certainty)])


# ---- common rules -----------------------------------------------------------


def date_parse_rule(parsed: str, raw: str) -> Rule:
    """A date that was given but could not be read."""
    failed = is_parse_failure(F.col(parsed), F.col(raw))
    return Rule(failed, "DATE_PARSE_FAIL", certainty="UNRELIABLE")


def orphan_fk_rule(fk: str, source_fk: str | None = None) -> Rule:
    """A left join that found no target.

    With ``source_fk``, a row that had no key to begin with is no orphan.
    """
    missing = F.col(fk).isNull()
    if source_fk is not None:
        missing = missing & F.col(source_fk).isNotNull()
    return Rule(missing, "ORPHAN_FK", certainty="UNRELIABLE")


def negative_amount_rule(amount: str) -> Rule:
    """An amount below zero."""
    return Rule(F.col(amount) < 0, "NEGATIVE_AMOUNT", certainty="UNRELIABLE")


def cancelled_with_revenue_rule(
    status_col: str, amount: str, cancelled: str = "CANCELLED"
) -> Rule:
    """A cancelled row that still carries money."""
    earns = (F.col(status_col) == cancelled) & (F.col(amount) > 0)
    return Rule(earns, "CANCELLED_WITH_REVENUE", certainty="UNRELIABLE")


def flag_date_parse_failure(df: DataFrame, parsed_col: str, raw_col: str) -> DataFrame:
    return flag_all(df, [date_parse_rule(parsed_col, raw_col)])


def flag_orphan_fk(df: DataFrame, fk_col: str, source_fk: str | None = None) -> DataFrame:
    return flag_all(df, [orphan_fk_rule(fk_col, source_fk)])


def standardise_date(df: DataFrame, col: str, format_hint: str) -> DataFrame:
    """Keep the text as ``<col>_raw``, parse it into ``col``, flag failures.

    Expects the quality columns to be there already.
    """
    raw = f"{col}_raw"
    parsed = df.withColumnRenamed(col, raw).withColumn(col, parse_date(F.col(raw), format_hint))
    return flag_date_parse_failure(parsed, col, raw)
