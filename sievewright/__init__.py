"""Data-quality ETL for sales-like tables and streams, written on the Spark DataFrame API."""
