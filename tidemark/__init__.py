"""Tidemark: subscription ingestion, star-schema reporting and forecasting on Spark DataFrames."""
