"""Events of an entity in the wrong order, or missing: all rules from one aggregate.

The log is summed up to the first and the last time of each event type per entity,
combined map-side, so an entity with any number of events is one row per task in the
only shuffle, whatever the number of rules.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline.operators.quality import Rule, add_anomaly_columns, flag_all


def first_time(event: str) -> Column:
    return F.col(f"first_{event}")


def last_time(event: str) -> Column:
    return F.col(f"last_{event}")


@dataclass(frozen=True)
class NotBefore:
    """``event`` must not happen before ``reference``; nothing is said where either is missing."""

    code: str
    event: str
    reference: str

    @property
    def fires(self) -> Column:
        return first_time(self.event) < first_time(self.reference)


@dataclass(frozen=True)
class NotAfter:
    """``event`` must not happen any more after ``reference``."""

    code: str
    event: str
    reference: str

    @property
    def fires(self) -> Column:
        return last_time(self.event) > first_time(self.reference)


@dataclass(frozen=True)
class Calls:
    """``reference`` calls for ``event``, at any time."""

    code: str
    event: str
    reference: str

    @property
    def fires(self) -> Column:
        return first_time(self.reference).isNotNull() & first_time(self.event).isNull()


SequenceRule = NotBefore | NotAfter | Calls

#: The registered codes that name an order of events.
ORDER_RULES: tuple[SequenceRule, ...] = (
    NotAfter("PAYMENT_AFTER_CANCEL", "payment", "cancelled"),
    NotBefore("DELIVERY_BEFORE_SHIP", "delivered", "shipped"),
    Calls("BOPIS_NO_PICKUP_EVENT", "picked_up", "bopis"),
    NotBefore("REVIEW_BEFORE_DELIVERY", "review", "delivered"),
)


def event_times(log: DataFrame, entity: str | Sequence[str], event: str, time: str, events: Sequence[str]) -> DataFrame:
    """One row per entity: ``first_<event>`` and ``last_<event>`` of each event type asked for.

    Other types and rows without a time do not count, but their entity is there; rows
    without an entity are left out.
    """
    keys = [entity] if isinstance(entity, str) else list(entity)
    found = []
    for name in events:
        at = F.when(F.col(event) == name, F.col(time))
        found += [F.min(at).alias(f"first_{name}"), F.max(at).alias(f"last_{name}")]
    return log.na.drop(subset=keys).groupBy(*keys).agg(*found)


def check_sequences(
    log: DataFrame,
    entity: str | Sequence[str],
    event: str,
    time: str,
    rules: Sequence[SequenceRule] = ORDER_RULES,
) -> DataFrame:
    """One row per entity with its event times and the quality columns of all rules."""
    names = list(dict.fromkeys(n for r in rules for n in (r.event, r.reference)))
    times = add_anomaly_columns(event_times(log, entity, event, time, names))
    return flag_all(times, [Rule(r.fires, r.code, certainty="UNRELIABLE") for r in rules])
