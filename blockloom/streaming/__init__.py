"""Streamed tables: bounded replays of the event log, and Structured Streaming."""
