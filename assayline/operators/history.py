"""Slowly changing dimensions: every version of a row with the days from and to which it was valid.

A history grows by one snapshot at a time. Intervals are half open: a version holds from
``valid_from`` up to, not including, ``valid_to``; the open version of a key has none.
Merging a snapshot touches open versions only, so versions closed earlier are never
shuffled, and in a table laid out by ``valid_to`` their files stay as they are.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayline.functions.keys import surrogate_key
from assayline.operators.aggregates import unique_rows
from assayline.sources.scratch import stored
from assayline.sources.tables import Medallion

VALID_FROM, VALID_TO, CURRENT, HASH, VERSION_KEY = "valid_from", "valid_to", "is_current", "row_hash", "version_key"
_OPEN = "9999-12-31"
_LAYOUT = "closed_on"  # folder of a stored version: "open", or "on-" and the day it was closed


def row_hash(*cols: Column | str) -> Column:
    """SHA-256 of values with their lengths, so that no two different rows write alike; NULL is not the empty text."""
    parts = []
    for c in cols:
        text = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts.append(F.ifnull(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat_ws("|", *parts), 256)


def merge_history(
    history: DataFrame | None,
    snapshot: DataFrame,
    keys: Sequence[str],
    as_of: str | dt.date,
    tracked: Sequence[str] | None = None,
    close_missing: bool = True,
) -> DataFrame:
    """The history after the snapshot of day ``as_of``: all versions, past ones untouched.

    A key new in the snapshot opens a version; one whose ``tracked`` columns (all but the
    keys, if not given) changed closes its version on ``as_of`` and opens another; other
    columns are overwritten in the open version. A key missing from the snapshot is closed
    unless ``close_missing`` is off, and opens anew when it comes back.

    Merging the latest snapshot again, the same or a corrected one, gives what a first
    merge would have given (but for columns that are not tracked, in versions that only
    the correction closes: what was overwritten is not known any more). A snapshot older than the newest version fails the job, as do
    repeated keys in the snapshot or among open versions.
    """
    changed = changed_versions(history, snapshot, keys, as_of, tracked, close_missing)
    return changed if history is None else history.where(F.col(VALID_TO) < _day(as_of)).unionByName(changed)


def _day(as_of: str | dt.date) -> Column:
    return F.lit(str(as_of)).cast("date")


def changed_versions(
    history: DataFrame | None,
    snapshot: DataFrame,
    keys: Sequence[str],
    as_of: str | dt.date,
    tracked: Sequence[str] | None = None,
    close_missing: bool = True,
) -> DataFrame:
    """The versions that are open after ``merge_history`` or closed by it: one full join by key."""
    keys, day = list(keys), _day(as_of)
    values = [c for c in snapshot.columns if c not in keys]
    tracked = list(tracked) if tracked is not None else values
    new = unique_rows(snapshot, *keys).select(
        row_hash(*keys).alias("__key"),
        F.struct(*[F.col(c) for c in snapshot.columns], row_hash(*tracked).alias(HASH)).alias("__new"),
    )
    if history is None:
        rows = new.select(F.col("__new").alias("__row"), day.alias(VALID_FROM), F.lit(None).cast("date").alias(VALID_TO))
        return _versions(rows, keys, values)
    late = F.concat(F.lit(f"snapshot of {as_of} is older than a version of "), F.col(VALID_FROM).cast("string"))
    # as it was before this day: what a first run closed is open again, what it opened is gone
    began = F.when(F.col(VALID_FROM) > day, F.raise_error(late).cast("boolean")).otherwise(F.col(VALID_FROM) < day)
    old = unique_rows(history.where(F.ifnull(F.col(VALID_TO) >= day, F.lit(True))).where(began).select(*snapshot.columns, HASH, VALID_FROM), *keys).select(
        row_hash(*keys).alias("__key"),
        F.struct(*snapshot.columns, HASH).alias("__old"),
        F.col(VALID_FROM).alias("__since"),
    )
    both = old.join(new, "__key", "full")
    there, here = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    same = there & here & (F.col(f"__old.{HASH}") == F.col(f"__new.{HASH}"))
    never = F.lit(None).cast("date")

    def version(row: str, since: Column, until: Column) -> Column:
        return F.struct(F.col(row).alias("__row"), since.alias(VALID_FROM), until.alias(VALID_TO))

    goes = there & ~here & F.lit(not close_missing)
    since = F.col("__since")
    made = F.array(
        F.when(same, version("__new", since, never)),
        F.when(there & ~same, version("__old", since, F.when(goes, never).otherwise(day))),
        F.when(here & ~same, version("__new", day, never)),
    )
    rows = both.select(F.explode(F.filter(made, lambda v: v.isNotNull())).alias("v")).select("v.*")
    return _versions(rows, keys, values)


def _versions(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    key = surrogate_key(*[F.col(f"__row.{k}") for k in keys], F.col(VALID_FROM))
    return rows.select(
        key.alias(VERSION_KEY),
        *[F.col(f"__row.{c}").alias(c) for c in [*keys, *values, HASH]],
        VALID_FROM,
        VALID_TO,
        F.col(VALID_TO).isNull().alias(CURRENT),
    )


def check_history(history: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """One row: keys with several open versions, versions that overlap the one before, intervals without a day."""
    before = F.lag(F.ifnull(F.col(VALID_TO), F.lit(_OPEN).cast("date"))).over(Window.partitionBy(*keys).orderBy(VALID_FROM, VALID_TO))
    rows = history.select(*keys, VALID_FROM, VALID_TO).withColumn("__before", before)
    # window and aggregate share one partitioning by key
    by_key = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(VALID_TO).isNull()).alias("open"),
        F.count_if(F.col("__before") > F.col(VALID_FROM)).alias("overlapping"),
        F.count_if(F.col(VALID_TO) <= F.col(VALID_FROM)).alias("empty"),
    )
    none = F.lit(0).cast("long")
    return by_key.agg(
        F.ifnull(F.sum("n"), none).alias("versions"),
        F.ifnull(F.sum("open"), none).alias("open_versions"),
        F.count_if(F.col("open") > 1).alias("several_open"),
        F.ifnull(F.sum("overlapping"), none).alias("overlaps"),
        F.ifnull(F.sum("empty"), none).alias("empty_intervals"),
    ).select(F.lit(table).alias("history"), "*")


def refresh_history(
    layers: Medallion,
    table: str,
    snapshot: DataFrame,
    keys: Sequence[str],
    as_of: str | dt.date,
    tracked: Sequence[str] | None = None,
    close_missing: bool = True,
    layer: str = "gold",
) -> None:
    """Merge a snapshot into a stored history, laid out by the day its versions were closed.

    Only the open versions and those closed on ``as_of`` are written; files of earlier
    days are neither read nor written. A rerun of the same day replaces them.
    """
    spark, path = layers.spark, layers.path(layer, table)
    folder = spark._jvm.org.apache.hadoop.fs.Path
    files = folder(path).getFileSystem(spark._jsc.hadoopConfiguration())
    history, closed = None, f"on-{as_of}"
    if files.exists(folder(path)):
        # "on-..." sorts before "open": only folders that this day can touch, or that show it is late
        history = spark.read.parquet(path).where(F.col(_LAYOUT) >= closed).drop(_LAYOUT)
    changed = stored(changed_versions(history, snapshot, keys, as_of, tracked, close_missing), "history")
    (
        changed.withColumn(_LAYOUT, F.when(F.col(CURRENT), "open").otherwise(closed))
        .hint("rebalance", _LAYOUT)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(_LAYOUT)
        .parquet(path)
    )
    # a folder without rows is not written, so what an earlier run of this day left there goes
    for name, rows in (("open", changed.where(F.col(CURRENT))), (closed, changed.where(~F.col(CURRENT)))):
        if not rows.head(1):
            files.delete(folder(f"{path}/{_LAYOUT}={name}"), True)


def read_history(layers: Medallion, table: str, layer: str = "gold", only_open: bool = False) -> DataFrame:
    """All versions of a stored history, or its open ones (one folder)."""
    rows = layers.spark.read.parquet(layers.path(layer, table))
    return (rows.where(F.col(_LAYOUT) == "open") if only_open else rows).drop(_LAYOUT)
