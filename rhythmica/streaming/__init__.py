"""Structured Streaming jobs: validate and score, watch accuracy, keep lag features."""
