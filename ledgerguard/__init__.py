"""Ledger ingest, data quality, routing and reporting on Spark DataFrames."""
