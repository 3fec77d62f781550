"""All queries of this subpackage and the SQL of those that SQL can express."""

from assayline.llm import (
    conversations,
    decontamination,
    html_text,
    ngram_join,
    pii,
    quality,
    ranked_search,
    secret_scan,
    sharding,
    substrings,
    suffixes,
    tokens,
    warc,
)

MODULES = [
    conversations, decontamination, html_text, ngram_join, pii, quality, ranked_search, secret_scan, sharding,
    substrings, suffixes, tokens, warc,
]
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
