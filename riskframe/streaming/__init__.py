"""Structured Streaming jobs over the same projections as the batch operators."""
