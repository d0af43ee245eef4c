"""Structured Streaming forms of link discovery, task monitor and rate audit."""
