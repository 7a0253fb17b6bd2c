"""Structured Streaming runners: checkpointed, replay-safe, with dead letters."""
