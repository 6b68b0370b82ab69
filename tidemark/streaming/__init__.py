"""Structured Streaming jobs around the operators."""
