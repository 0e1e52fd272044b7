"""Micro-batch loading with Structured Streaming."""
