"""Deterministic keys over natural-key columns.

The byte layout (separator, NULL word, SHA-256 hex) is a stable contract: keys
written by one run must join to keys written by any other. Two consequences
are kept on purpose: a literal ``~NULL~`` equals a NULL, and a separator inside
a value can make ``('a|b', 'c')`` equal ``('a', 'b|c')``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayline.registry import (
    ANONYMOUS_BELOW,
    ANONYMOUS_PREFIX,
    KEY_NULL,
    KEY_SEPARATOR,
)


def composite_business_key(*cols: Column) -> Column:
    """Readable natural key for audit columns; join on ``surrogate_key``."""
    if not cols:
        raise ValueError("composite_business_key needs at least one column")
    parts = (F.ifnull(c.cast("string"), F.lit(KEY_NULL)) for c in cols)
    return F.concat_ws(KEY_SEPARATOR, *parts)


def surrogate_key(*cols: Column) -> Column:
    """64-character hex SHA-256 of the natural key, NULL-safe."""
    if not cols:
        raise ValueError("surrogate_key needs at least one column")
    return F.sha2(composite_business_key(*cols), 256)


def anonymous_key(prefix: str = ANONYMOUS_PREFIX) -> Column:
    """One constant key that all rows of an anonymous bucket share."""
    return F.sha2(F.lit(f"__{prefix}_BUCKET__"), 256)


def identity_key(
    confidence: Column,
    *cols: Column,
    below: float = ANONYMOUS_BELOW,
    prefix: str = ANONYMOUS_PREFIX,
) -> Column:
    """Anonymous key under the confidence limit, else the surrogate key.

    A NULL confidence is not under the limit, so it keeps its own key.
    """
    return F.when(confidence < below, anonymous_key(prefix)).otherwise(surrogate_key(*cols))
