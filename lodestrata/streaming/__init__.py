"""Structured Streaming over arriving archives."""
