"""Structured Streaming jobs: raw landing, detectors, the full micro-batch pipeline."""
