"""Spark DataFrame library for layered ingestion, customer and order marts,
demand forecasting, recommendation, review analysis and feature tables."""
