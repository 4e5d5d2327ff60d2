"""Structured Streaming variants of the scoring path."""
