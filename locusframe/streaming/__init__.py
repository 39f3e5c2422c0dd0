"""Structured Streaming jobs over task observations."""
