"""Structured Streaming: change events to epoch-partitioned deltas."""
