"""Structured Streaming: counts, gauges and replay."""
