"""Structured Streaming jobs over the ball messages."""
