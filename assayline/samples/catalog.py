"""All example queries and their checking SQL."""

from assayline.samples import checks, events, fields, flags, history, products  # noqa: F401  (registers queries)
from assayline.samples.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
