"""Structured Streaming consumers."""
