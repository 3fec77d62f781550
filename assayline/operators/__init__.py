"""DataFrame operators: quality flags, joins, aggregates and matching."""
