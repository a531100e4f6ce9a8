"""Structured Streaming forms of capture, joins and monitors."""
