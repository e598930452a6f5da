"""Structured Streaming: landed pages folded into the event store."""
