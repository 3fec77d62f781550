"""Column functions: keys, dates and words."""

from assayline.functions.dates import (
    is_parse_failure,
    parse_date,
    parse_ddmmyyyy,
    parse_ddmonyyyy,
    parse_iso_date,
    parse_iso_timestamp,
    parse_pg_timestamp,
    parse_slash_datetime,
    parse_unix_epoch,
)
from assayline.functions.keys import (
    anonymous_key,
    composite_business_key,
    identity_key,
    surrogate_key,
)
from assayline.functions.words import sorted_words, title_similarity, word_overlap_ratio

__all__ = [
    "anonymous_key",
    "composite_business_key",
    "identity_key",
    "is_parse_failure",
    "parse_date",
    "parse_ddmmyyyy",
    "parse_ddmonyyyy",
    "parse_iso_date",
    "parse_iso_timestamp",
    "parse_pg_timestamp",
    "parse_slash_datetime",
    "parse_unix_epoch",
    "sorted_words",
    "surrogate_key",
    "title_similarity",
    "word_overlap_ratio",
]
