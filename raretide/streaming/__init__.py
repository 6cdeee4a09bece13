"""Structured Streaming operators: request validation, scoring decisions, alert volume, de-duplication."""
