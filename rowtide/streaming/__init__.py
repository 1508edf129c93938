"""Structured Streaming: fan-out to many tables and the temporal join."""
