"""Text to date / timestamp, one parser per source format.

Every parser turns bad input into NULL under ANSI mode (``try_*`` functions),
so one bad row never fails a job; ``is_parse_failure`` then tells a bad value
from a missing one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayline.registry import DATE_PATTERNS, PG_TEXT_PATTERN, TIMESTAMP_PATTERNS

# Largest whole second whose microsecond count fits a 64-bit timestamp.
_MAX_EPOCH_SECOND = (2**63 - 1) // 1_000_000


def parse_ddmmyyyy(col: Column) -> Column:
    """``08/01/2024`` is 8 January 2024: day first, two digits each."""
    return F.try_to_date(col, DATE_PATTERNS["ddmmyyyy"])


def parse_iso_date(col: Column) -> Column:
    """``2024-08-08``."""
    return F.try_to_date(col, DATE_PATTERNS["iso_date"])


def parse_ddmonyyyy(col: Column) -> Column:
    """``05-Sep-2024``; the month name may be in any case."""
    return F.try_to_date(col, DATE_PATTERNS["ddmonyyyy"])


def parse_iso_timestamp(col: Column) -> Column:
    """ISO 8601 such as ``2024-08-08T14:23:00``; lenient about trailing parts."""
    return F.try_to_timestamp(col)


def parse_slash_datetime(col: Column) -> Column:
    """``2024/08/08 14:23``."""
    return F.try_to_timestamp(col, F.lit(TIMESTAMP_PATTERNS["slash_datetime"]))


def parse_unix_epoch(col: Column) -> Column:
    """Whole seconds since 1970-01-01 UTC, independent of the session zone.

    Seconds beyond the timestamp range are bad input too, hence NULL.
    """
    seconds = col.try_cast("bigint")
    in_range = seconds.between(-_MAX_EPOCH_SECOND, _MAX_EPOCH_SECOND)
    return F.timestamp_seconds(F.when(in_range, seconds))


def parse_pg_timestamp(col: Column, pg_format: str = "epoch") -> Column:
    """Payment-gateway time: ``epoch`` seconds, or ``string`` date-time text."""
    if pg_format == "epoch":
        return parse_unix_epoch(col)
    if pg_format == "string":
        return F.try_to_timestamp(col, F.lit(PG_TEXT_PATTERN))
    raise ValueError(f"pg_format must be 'epoch' or 'string', not {pg_format!r}")


PARSERS = {
    "ddmmyyyy": parse_ddmmyyyy,
    "iso_date": parse_iso_date,
    "iso_timestamp": parse_iso_timestamp,
    "ddmonyyyy": parse_ddmonyyyy,
    "slash_datetime": parse_slash_datetime,
    "unix_epoch": parse_unix_epoch,
    "pg_timestamp": parse_pg_timestamp,
}


def parse_date(col: Column, format_hint: str) -> Column:
    """Parse with the parser named by ``format_hint`` (a key of ``PARSERS``)."""
    parser = PARSERS.get(format_hint)
    if parser is None:
        raise ValueError(f"no date format {format_hint!r}; choose from {', '.join(PARSERS)}")
    return parser(col)


def is_parse_failure(parsed: Column, raw: Column) -> Column:
    """True where a value was given but could not be parsed."""
    return parsed.isNull() & raw.isNotNull()
