"""Whole jobs put together from operators: the batch chain, SQL jobs, the exporter."""
