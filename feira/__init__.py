"""Marketplace analytics on Spark: orders, catalogue, promotions, reviews and click events."""
