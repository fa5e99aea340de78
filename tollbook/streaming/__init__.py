"""Streaming jobs built from the same operators as the batch jobs."""
