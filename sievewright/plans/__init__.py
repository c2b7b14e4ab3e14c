"""Composite pipelines: sales (batch and micro-batch) and financials."""
