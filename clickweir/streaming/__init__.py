"""Continuous forms: queries, keyed results, stop conditions, the chained jobs."""
