"""As-of lookup: for each fact the version of its key that was valid at its time.

Versions that fit are broadcast, packed to one sorted array a key, and the facts stay
where they are. Else facts and versions are laid out together by key and time, and each
fact takes the last version in front of it; keys are cut by time, so none is one task.
There is no nested loop over ranges in either way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayline.operators.joins import BROADCAST_BYTES, lookup_sizes, measured_bytes
from assayline.operators.ranged import PART, carried, inside, ranged, with_carried
from assayline.sources.scratch import stored

#: Versions of a key that a fact is compared with one by one; more are laid out by time.
MOST_VERSIONS = 1_000

_FROM, _VERSION, _VERSIONS = "__from", "__version", "__versions"


def as_of_join(
    facts: DataFrame,
    versions: DataFrame,
    keys: str | Sequence[str],
    time: str,
    valid_from: str,
    columns: Sequence[str],
    valid_to: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``facts`` with ``columns`` of the last version whose ``valid_from`` is not after ``time``.

    With ``valid_to`` a version holds only before that moment (NULL: it still holds).
    Every fact stays one row; without a version, without a key or without a time its
    new columns are NULL. Of versions of one key and moment the greatest (by ``valid_to``,
    then ``columns``) counts. Versions without a key or a moment are ignored.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    taken = set(facts.columns) & set(columns)
    if taken:
        raise ValueError(f"facts already have {', '.join(sorted(taken))}")
    end = F.col(valid_to) if valid_to else F.lit(None).cast(facts.schema[time].dataType)
    version = F.struct(end.alias("__until"), *columns)
    slim = versions.na.drop(subset=[*keys, valid_from]).select(*keys, F.col(valid_from).alias(_FROM), version.alias(_VERSION))
    (planned,) = lookup_sizes([slim], broadcast_bytes) if broadcast_bytes > 0 else (1,)
    found = None
    if planned <= broadcast_bytes:
        found = _packed(facts, slim, keys, time, broadcast_bytes)
    if found is None:
        found = _laid_out(facts, slim, keys, time)
    holds = F.col("__found.__until").isNull() | (F.col(time) < F.col("__found.__until"))
    new = [F.when(holds, F.col(f"__found.{c}")).alias(c) for c in columns]
    return found.select(*facts.columns, *new)


def _packed(facts: DataFrame, slim: DataFrame, keys: list[str], time: str, limit: int) -> DataFrame | None:
    """Broadcast of one sorted array a key; None if it does not fit or a key has too many versions."""
    pairs = F.struct(F.col(_FROM), F.col(_VERSION))
    packed = stored(slim.groupBy(*keys).agg(F.array_sort(F.collect_list(pairs)).alias(_VERSIONS)), "versions")
    most = packed.agg(F.max(F.size(_VERSIONS))).first()[0] or 0
    if most > MOST_VERSIONS or measured_bytes(packed)[0] > limit:
        return None
    rows = facts.join(F.broadcast(packed), keys, "left")
    valid = F.filter(_VERSIONS, lambda v: v[_FROM] <= F.col(time))
    return rows.withColumn("__found", F.try_element_at(valid, F.lit(-1))[_VERSION])


def _laid_out(facts: DataFrame, slim: DataFrame, keys: list[str], time: str) -> DataFrame:
    """Facts and versions in one order of key and time; cut anywhere, the version of before is carried over."""
    slim = slim.groupBy(*keys, _FROM).agg(F.max(_VERSION).alias(_VERSION))
    usable = F.col(time).isNotNull()
    for key in keys:
        usable = usable & F.col(key).isNotNull()
    fact = F.struct(*facts.columns)
    order = ["__at", "__kind", "__tie"]
    both = facts.where(usable).select(
        *keys,
        F.col(time).alias("__at"),
        F.lit(1).alias("__kind"),
        F.xxhash64(*facts.columns).alias("__tie"),
        fact.alias("__fact"),
    )
    both = both.unionByName(
        slim.select(
            *keys,
            F.col(_FROM).cast(facts.schema[time].dataType).alias("__at"),
            F.lit(0).alias("__kind"),
            F.lit(0).cast("long").alias("__tie"),
            _VERSION,
        ),
        allowMissingColumns=True,
    )
    placed = ranged(both, keys, order, "asof")
    latest = F.max(F.when(F.col(_VERSION).isNotNull(), F.struct("__at", _VERSION)))
    before = carried(placed, keys, latest, F.max, "__before")
    here = F.last(_VERSION, ignorenulls=True).over(inside(keys, order))
    rows = with_carried(placed, before, keys).withColumn("__found", F.ifnull(here, F.col("__before")[_VERSION]))
    found = rows.where("__kind = 1").select("__fact.*", "__found")
    rest = facts.where(~F.ifnull(usable, F.lit(False)))
    return found.unionByName(rest, allowMissingColumns=True)


def version_valid(time: Column, valid_from: Column, valid_to: Column) -> Column:
    """Whether a moment lies in a version's half-open interval; no end: it still holds."""
    return (valid_from <= time) & (valid_to.isNull() | (time < valid_to))
