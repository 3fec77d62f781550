"""Table builds and quality suites put together from the operators."""
