"""Structured Streaming forms of the topic audits."""
