"""Structured Streaming: window metrics, dead letters, scoring."""
