"""Incremental (Structured Streaming) form of the lake load."""
