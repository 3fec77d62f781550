"""Which records are one customer, and how sure that is.

Evidence are sets of columns that two records of one customer share, each with a weight.
Records are grouped by evidence, never paired: each is tied to the first record that
shows the same, and what hangs together is one identity. Values on too many records are
placeholders (a shop's own address, a row of zeros); they are flagged and tie nothing,
which also bounds every group.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline.functions.keys import identity_key
from assayline.operators.components import connected
from assayline.operators.history import row_hash
from assayline.operators.joins import lookup_join
from assayline.operators.quality import Rule, flag_all
from assayline.registry import ANONYMOUS_BELOW
from assayline.sources.scratch import stored

#: Records that may share a value before it counts as a placeholder.
PLACEHOLDER_ABOVE = 50
#: Evidence of at least this weight ties records; lighter evidence only adds confidence.
LINK_WEIGHT = ANONYMOUS_BELOW


@dataclass(frozen=True)
class Evidence:
    """Columns that must all be there, and how sure they make a record's identity (0 to 1)."""

    name: str
    columns: tuple[str, ...]
    weight: float

    def __post_init__(self) -> None:
        if not 0 <= self.weight <= 1:
            raise ValueError(f"weight of {self.name!r} is not within 0 and 1")

    @property
    def value(self) -> Column:
        """A digest of the values; NULL if any is missing or blank."""
        there = [F.length(F.trim(F.col(c).cast("string"))) > 0 for c in self.columns]
        return F.when(reduce(lambda a, b: a & b, there), row_hash(*self.columns))


def _confidence(usable: Sequence[Column], evidence: Sequence[Evidence]) -> Column:
    left = F.lit(1.0)
    for there, e in zip(usable, evidence):
        left = left * F.when(there, F.lit(1.0 - e.weight)).otherwise(F.lit(1.0))
    return F.lit(1.0) - left


def resolve_identities(
    records: DataFrame,
    record_id: str,
    evidence: Sequence[Evidence],
    conflicts: Sequence[str] = (),
    placeholder_above: int = PLACEHOLDER_ABOVE,
    link_weight: float = LINK_WEIGHT,
    anonymous_below: float = ANONYMOUS_BELOW,
) -> DataFrame:
    """``records`` (unique ids, quality columns) with identity_id, identity_confidence, customer_master_key.

    The identity is named by its smallest record id. Confidence is 1 minus the product of
    (1 - weight) over a record's evidence that is no placeholder; below ``anonymous_below``
    the key is the anonymous one, else the key of the identity. Flags: a placeholder value
    (PLACEHOLDER_ID_COLLISION), and an identity with several values in a ``conflicts``
    column (IDENTITY_AMBIGUOUS). A record without evidence is its own identity, confidence 0.
    """
    numbers = {i: e for i, e in enumerate(evidence)}
    each = F.array(*[F.struct(F.lit(i).alias("rule"), e.value.alias("value")) for i, e in numbers.items()])
    shown = records.select(F.col(record_id).alias("record"), F.explode(each).alias("e")).select("record", "e.*")
    shown = stored(shown.where("value IS NOT NULL"), "evidence")
    # one row a value, combined map-side; a value on one record only says that it is usable
    values = shown.groupBy("rule", "value").agg(F.count(F.lit(1)).alias("n"), F.min("record").alias("hub")).where("n > 1")
    met = stored(lookup_join(shown, stored(values, "values"), ["rule", "value"], spread_by=["record"]), "evidence")

    strong = [i for i, e in numbers.items() if e.weight >= link_weight]
    ties = met.where(F.col("rule").isin(strong) & (F.col("n") <= placeholder_above))
    groups = connected(ties, "record", "hub").withColumnsRenamed({"node": record_id, "component": "__identity"})

    usable = F.ifnull(F.col("n") <= placeholder_above, F.lit(True))
    sums = met.groupBy(F.col("record").alias(record_id)).agg(
        *[F.max((F.col("rule") == i) & usable).alias(f"__use_{i}") for i in numbers],
        F.max(~usable).alias("__placeholder"),
    )
    rows = records.join(sums, record_id, "left").join(groups, record_id, "left")
    shows = [F.ifnull(F.col(f"__use_{i}"), F.lit(False)) for i in numbers]
    rows = rows.withColumn("identity_id", F.ifnull("__identity", record_id)).withColumn(
        "identity_confidence", _confidence(shows, evidence)
    )
    rows = rows.withColumn(
        "customer_master_key", identity_key(F.col("identity_confidence"), F.col("identity_id"), below=anonymous_below)
    )
    rules = [Rule(F.col("__placeholder"), "PLACEHOLDER_ID_COLLISION", certainty="UNRELIABLE")]
    if conflicts:
        rows = stored(rows, "identities")
        several = reduce(lambda a, b: a | b, [F.min(c) < F.max(c) for c in conflicts])
        torn = rows.groupBy("identity_id").agg(several.alias("__torn")).where("__torn")
        rows = lookup_join(rows, torn, "identity_id", spread_by=[record_id])
        rules.append(Rule(F.col("__torn"), "IDENTITY_AMBIGUOUS", "FLAGGED_AMBIGUOUS", "UNRELIABLE"))
    added = ["identity_id", "identity_confidence", "customer_master_key"]
    return flag_all(rows, rules).select(*records.columns, *added)
