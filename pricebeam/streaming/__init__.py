"""Incremental jobs on Structured Streaming. Each run drains what is new and stops."""
