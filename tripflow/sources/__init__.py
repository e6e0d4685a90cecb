"""Readers and writers: raw files, the event log, wire messages, the lake, serving tables."""
