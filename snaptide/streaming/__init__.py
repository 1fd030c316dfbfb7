"""Structured Streaming runners."""
