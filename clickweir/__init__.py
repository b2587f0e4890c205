"""Clickstream analytics on Spark: lenient JSON events in, windowed cookie behaviour out."""
