"""Spark operators for sensor series, run-to-failure panels, arrivals and feature tables."""
