"""Joins that stay even when one key holds a large share of the rows.

A lookup is broadcast when its size is known to fit: from the caller, or from the
optimizer's estimate where that is far from the limit, else by measuring it once.
Beyond that both sides are shuffled on (key, slice): every key with more
rows than a slice is spread over several slices and its lookup rows are repeated
once per slice. NULL keys never match, so they are spread without any repeats.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

from assayline.sources.scratch import stored

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_ROWS = 1_000_000  # least rows of a slice; a lighter key is not worth slicing
MOST_SLICES = 250_000  # a slice has at least this fraction of all rows, so there are no more hot keys than this

_SLICE, _SLICES, _ROWS = "__slice", "__slices", "__rows"
_ROW_OVERHEAD = 48  # per-row cost of a broadcast hash table, beside the values


def _value_bytes(column: Column, kind: DataType) -> Column:
    """In-memory size of a value; every element of an array, map or struct counts."""
    none = F.lit(0).cast("long")
    if isinstance(kind, (StringType, BinaryType)):
        size = F.octet_length(column).cast("long") + 16
    elif isinstance(kind, ArrayType):
        size = F.aggregate(column, none, lambda n, x: n + _value_bytes(x, kind.elementType)) + 16
    elif isinstance(kind, MapType):
        size = _value_bytes(F.map_keys(column), ArrayType(kind.keyType)) + _value_bytes(
            F.map_values(column), ArrayType(kind.valueType)
        )
    elif isinstance(kind, StructType):
        size = reduce(
            lambda a, b: a + b, [_value_bytes(column.getField(f.name), f.dataType) for f in kind.fields], F.lit(16)
        )
    else:
        size = F.lit(16)
    return F.ifnull(size.cast("long"), none + 16)


def _row_bytes(df: DataFrame) -> Column:
    widths = [_value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    return reduce(lambda a, b: a + b, widths, F.lit(_ROW_OVERHEAD)).cast("long")


def measured_bytes(*frames: DataFrame) -> list[int]:
    """In-memory size of each frame, measured in one job (one number each).

    This evaluates the frames: for stored tables and cheap projections of them.
    """
    parts = [
        df.agg(F.ifnull(F.sum(_row_bytes(df)), F.lit(0)).alias("b")).select(
            F.lit(i).alias("i"), "b"
        )
        for i, df in enumerate(frames)
    ]
    return [row["b"] for row in sorted(reduce(DataFrame.unionAll, parts).collect())]


def _planned_bytes(df: DataFrame) -> int | None:
    """The optimizer's estimate from file sizes and column widths; None where rows are made by exploding."""
    plan = df._jdf.queryExecution().optimizedPlan()
    return None if "Generate " in plan.toString() else int(str(plan.stats().sizeInBytes()))


def lookup_sizes(frames: Sequence[DataFrame], limit: int) -> list[int]:
    """Size of each frame against ``limit``, without evaluating those whose estimate is far from it.

    Estimates count a text as 20 bytes and files as they are compressed, so a frame
    counts as small from an eighth of the limit down, and as large from its 16-fold
    up. What lies between is measured, all of it in one job.
    """
    sizes: list[int | None] = []
    for df in frames:
        planned = _planned_bytes(df)
        if planned is not None and planned * 8 <= limit:
            sizes.append(planned * 8)
        else:
            sizes.append(planned if planned is not None and planned > 16 * limit else None)
    unknown = [df for df, size in zip(frames, sizes) if size is None]
    measured = iter(measured_bytes(*unknown) if unknown else [])
    return [next(measured) if size is None else size for size in sizes]


@dataclass(frozen=True)
class HotKeys:
    """Keys heavier than a slice with their slice counts (None: there are none), and slices for NULL keys."""

    keys: DataFrame | None
    null_slices: int


def hot_keys(facts: DataFrame, keys: Sequence[str], slice_rows: int = HOT_ROWS) -> HotKeys:
    """Every key with more rows than a slice.

    A slice has ``slice_rows`` rows, or 1/250,000 of all rows if that is more: so the
    list is short by arithmetic, and no heavy key is missing from it. Counts are
    combined map-side before the shuffle; the list is written, not collected.
    """
    keyless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    rows, seen = F.col(_ROWS), Observation()
    counts = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias(_ROWS)).observe(
        seen,
        F.ifnull(F.sum(_ROWS), F.lit(0)).alias("all"),
        F.ifnull(F.sum(F.when(keyless, rows)), F.lit(0)).alias("none"),
    )
    heavy = stored(counts.where((rows > slice_rows) & ~keyless), "hot")
    total = seen.get
    slice_rows = max(slice_rows, -(-total["all"] // MOST_SLICES))
    heavy = heavy.where(rows > slice_rows).select(*keys, F.ceil(rows / slice_rows).cast("long").alias(_SLICES))
    return HotKeys(heavy if heavy.head(1) else None, max(1, -(-total["none"] // slice_rows)))


def _slice_count(df: DataFrame, keys: Sequence[str], hot: HotKeys) -> DataFrame:
    """Add the number of slices of each row's key (1 when it is not hot)."""
    if hot.keys is None:
        return df.withColumn(_SLICES, F.lit(1).cast("long"))
    # at most MOST_SLICES rows
    return df.join(F.broadcast(hot.keys), list(keys), "left").fillna(1, subset=[_SLICES])


def sliced_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str,
    spread_by: Sequence[str] | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Shuffle join on (keys, slice); see the module text.

    Slices come from a hash of the row (``spread_by``, or all its columns), never
    from a random number, so a task that is run again makes the same rows. Give
    ``spread_by`` a column that tells rows apart, such as an id: rows alike in
    all of those columns stay in one slice. ``hot`` saves counting the keys where
    the same facts are joined on them again.
    """
    keys = list(keys)
    hot = hot or hot_keys(facts, keys)
    spread = F.abs(F.xxhash64(*(spread_by or facts.columns)) % F.lit(2**31))
    keyless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    left = (
        _slice_count(facts, keys, hot)
        .withColumn(_SLICE, F.pmod(spread, F.when(keyless, F.lit(hot.null_slices)).otherwise(F.col(_SLICES))))
        .drop(_SLICES)
    )
    right = (
        _slice_count(lookup.na.drop(subset=keys), keys, hot)
        .withColumn(_SLICE, F.explode(F.sequence(F.lit(0).cast("long"), F.col(_SLICES) - 1)))
        .drop(_SLICES)
    )
    return left.join(right, [*keys, _SLICE], how).drop(_SLICE)


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: str | Sequence[str],
    how: str = "left",
    spread_by: Sequence[str] | None = None,
    lookup_bytes: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Join facts to a lookup on same-named keys (inner, left or left_anti).

    ``lookup_bytes`` saves the measuring job where the caller has the size, ``hot``
    the counting of keys where the same facts were joined on them before.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if how not in ("inner", "left", "left_anti"):
        raise ValueError(f"how must be inner, left or left_anti, not {how!r}")
    if lookup_bytes is None:
        (lookup_bytes,) = lookup_sizes([lookup], broadcast_bytes)
    if lookup_bytes <= broadcast_bytes:
        return facts.join(F.broadcast(lookup), keys, how)
    return sliced_join(facts, lookup, keys, how, spread_by, hot)


def resolve_fks(
    df: DataFrame,
    targets: Sequence[tuple[DataFrame, str, str, str]],
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Bring in several surrogate keys: (dimension, source key, dimension key, surrogate).

    What has to be measured is measured in one job. Keys may be named
    differently on the two sides; the dimension's own key is not kept.
    """
    slim = [
        dim.select(F.col(dim_key).alias(source_key), surrogate)
        for dim, source_key, dim_key, surrogate in targets
    ]
    sizes = lookup_sizes(slim, broadcast_bytes)
    for (_, source_key, _, _), lookup, size in zip(targets, slim, sizes):
        df = lookup_join(df, lookup, source_key, "left", None, size, broadcast_bytes)
    return df


def resolve_fk(
    df: DataFrame, dim: DataFrame, source_key: str, surrogate: str, dim_key: str | None = None
) -> DataFrame:
    """Left join to one dimension, bringing in its surrogate key."""
    return resolve_fks(df, [(dim, source_key, dim_key or source_key, surrogate)])
