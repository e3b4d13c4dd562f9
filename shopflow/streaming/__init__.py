"""Structured Streaming stages."""
