"""Structured Streaming variants of the operators."""
