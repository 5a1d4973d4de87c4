"""Structured Streaming over arriving publications."""
